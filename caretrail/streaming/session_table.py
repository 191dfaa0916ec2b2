"""A session table kept current from a stream of contacts, equal to the batch :func:`session_table` at any time.

Every micro-batch is first reduced to its own sessions by the batch operator, which spreads hot keys over pieces, so
nothing of a key but its sessions ever meets in one task, and no open session is held in a task's state. The sessions
of the batch are then merged with those of the table: intervals of one key that are no more than the gap apart become
one, whatever order their contacts came in. Contacts may be any time late.

The table lies in numbered versions below one folder: version n holds the buckets (by a hash of the key) that batch n
touched, and a bucket's state is its newest version that was written completely. A batch that is run again, after a
lost driver say, starts from the versions before its own and writes the same result over what it left. A bucket is
rewritten whole; two versions of each are kept, so a reader may still finish on the older one.

NULL keys and NULL times count as in the batch operator: contacts without a key are one session, contacts without a
time one session of their key.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from caretrail.functions.timeutil import whole_days
from caretrail.operators.sessions import sessionize
from caretrail.streaming.sessions import stream_checkpoint

KEPT_VERSIONS = 2


class SessionTable:
    def __init__(self, spark: SparkSession, path: str, key: str, ts: str, gap: int, *, firsts: Mapping[str, str] | None = None,
                 tiebreak: Sequence[str] = (), tiebreak_unique: bool = False, first_ts_name: str = "first_contact_date",
                 count_name: str = "num_contacts", buckets: int = 64) -> None:
        self.spark, self.path, self.key, self.ts, self.gap = spark, path, key, ts, gap
        self.firsts, self.tiebreak, self.tiebreak_unique = dict(firsts or {}), list(tiebreak), tiebreak_unique
        self.first_ts_name, self.count_name, self.buckets = first_ts_name, count_name, buckets
        self.columns = list(dict.fromkeys(self.firsts.values()))

    # ---- versions ------------------------------------------------------------------------------

    def _fs(self):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return at, at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, path) -> list[str]:
        _, fs = self._fs()
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def versions(self, before: int | None = None) -> dict[int, list[int]]:
        """bucket -> its complete versions, newest first."""
        at, _ = self._fs()
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path
        out: dict[int, list[int]] = {}
        for n in sorted((int(x[2:]) for x in self._names(at) if x.startswith("v=")), reverse=True):
            if before is not None and n >= before:
                continue
            names = self._names(jpath(f"{self.path}/v={n}"))
            if "_SUCCESS" in names:
                for x in names:
                    if x.startswith("bucket="):
                        out.setdefault(int(x[7:]), []).append(n)
        return out

    def _stored(self, versions: dict[int, list[int]], buckets: Sequence[int] | None = None) -> DataFrame | None:
        paths = [f"{self.path}/v={v[0]}/bucket={b}" for b, v in sorted(versions.items()) if buckets is None or b in buckets]
        return self.spark.read.parquet(*paths) if paths else None

    # ---- sessions ------------------------------------------------------------------------------

    def _sessions(self, contacts: DataFrame) -> DataFrame:
        """The batch's own sessions: key, low and high time, contacts, first row."""
        rows = contacts.select(*dict.fromkeys([self.key, self.ts, *self.tiebreak, *self.columns]))
        numbered = sessionize(rows, self.key, self.ts, (self.gap,), tiebreak=self.tiebreak, tiebreak_unique=self.tiebreak_unique,
                              count_name="_num", number_fmt="_session", label_fmt=None, lag_name=None, diff_name=None)
        first = F.struct(F.col(self.ts).alias("t"), *[F.col(c).alias(f"b{i}") for i, c in enumerate(self.tiebreak)],
                         *[F.col(c).alias(f"v{i}") for i, c in enumerate(self.columns)])
        return numbered.groupBy(self.key, "_session").agg(F.min(self.ts).alias("low"), F.max(self.ts).alias("high"),
                                                         F.count(F.lit(1)).alias("n"), F.min(first).alias("first")).drop("_session")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int")

    def _merged(self, parts: DataFrame) -> DataFrame:
        """Sessions out of intervals: an interval starts a session when it lies more than the gap after all before it."""
        w = Window.partitionBy(self.key).orderBy("low", "high")
        before = F.max("high").over(w.rowsBetween(Window.unboundedPreceding, -1))
        opens = F.when(F.col("low").isNull() | F.col(self.key).isNull(), 0).when(F.col("_before").isNull() | (whole_days("_before", "low") > F.lit(self.gap)), 1).otherwise(0)
        rows = parts.withColumn("_before", before).withColumn("_opens", opens).withColumn(
            "_s", F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        return rows.groupBy(self.key, "_s").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"),
                                               F.min("first").alias("first")).drop("_s")

    def merge(self, contacts: DataFrame, version: int) -> None:
        """Merge a batch of contacts; running it again with the same version gives the same table."""
        self.spark = contacts.sparkSession
        new = self._sessions(contacts).withColumn("_bucket", self._bucket()).persist()
        try:
            touched = [r[0] for r in new.select("_bucket").distinct().collect()]  # at most `buckets` numbers
            if not touched:
                return
            old = self._stored(self.versions(before=version), touched)
            parts = new.drop("_bucket")
            parts = parts if old is None else parts.unionByName(old.select(*parts.columns))
            out = self._merged(parts).withColumn("bucket", self._bucket())
            out.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/v={version}")
        finally:
            new.unpersist()
        self._forget()

    def _forget(self) -> None:
        """Delete what two newer versions of a bucket have replaced."""
        _, fs = self._fs()
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path
        for bucket, held in self.versions().items():
            for n in held[KEPT_VERSIONS:]:
                fs.delete(jpath(f"{self.path}/v={n}/bucket={bucket}"), True)

    def read(self) -> DataFrame | None:
        """The table as it stands, with the columns of :func:`caretrail.operators.sessions.session_table`; None before the
        first batch."""
        rows = self._stored(self.versions())
        if rows is None:
            return None
        gap = F.expr(f"INTERVAL '{self.gap} 23:59:59.999999' DAY TO SECOND")
        return rows.select(self.key, F.col("low").alias("session_start"), (F.col("high") + gap).alias("session_end"), F.col("low").alias(self.first_ts_name),
                           F.col("n").alias(self.count_name), *[F.col(f"first.v{self.columns.index(c)}").alias(n) for n, c in self.firsts.items()])


def start_session_table(spark: SparkSession, source: str, schema: StructType, table: SessionTable, *, name: str,
                        checkpoint_location: str | None = None, max_files_per_trigger: int | None = None,
                        available_now: bool = False) -> StreamingQuery:
    """Merge new Parquet files from ``source`` into ``table``, one version a micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    writer = (reader.parquet(source).writeStream.queryName(name).foreachBatch(table.merge)
              .option("checkpointLocation", checkpoint_location or stream_checkpoint(spark, os.path.join("tables", name))))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
