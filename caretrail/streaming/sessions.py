"""Session rollups (U14) kept up to date as contacts arrive, with Structured Streaming.

``session_window`` closes a session after ``gap`` of inactivity and merges an event that arrives
strictly before the session's end. The reports start a new session when more than N whole days
passed, i.e. after at least N+1 days; a gap of ``N+1 days - 1 microsecond`` gives the same sessions
(checked against :func:`caretrail.operators.sessions.sessionize` on orders at 15/30/60 days).
Differences, by construction of ``session_window``: rows with a NULL time are dropped, the rollups come
per (key, session) rather than copied onto every contact, and contacts with a NULL key form sessions of
their own (the batch operator puts all of them in one group, as a window over NULL labels does).

One key's open sessions are one task's state. In batch use
:func:`caretrail.operators.sessions.session_table`, which has no such limit.

Caveat (Spark's optimizer, batch and stream): do not filter the result on ``session_start`` /
``session_end`` in the same plan; such a predicate is pushed below the session merge and splits
sessions. Materialize (or write) first, then filter.

State is kept per key and open session by Spark's state store; the watermark bounds how long a
session stays open for late contacts. The stream's checkpoint goes below the configured
``spark.checkpoint.dir`` itself, which outlives the application, so a restarted stream goes on where it
stopped; without that setting a location must be given. Later contacts than the watermark allows are
dropped by Spark.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType, TimestampNTZType


def session_gap(days: int) -> str:
    """``session_window`` gap equivalent to 'a new session after more than ``days`` whole days'."""
    return f"{days} days 23 hours 59 minutes 59 seconds 999999 microseconds"


def session_rollups(df: DataFrame, key: str, ts: str, gap_days: int, *,
                    firsts: Mapping[str, str] | None = None, tiebreak: Sequence[str] = (),
                    first_ts_name: str = "first_contact_date", count_name: str = "num_contacts") -> DataFrame:
    """One row per (key, session): start, end, earliest time, row count and first-row values.

    Works on batch and streaming DataFrames (for a stream, set a watermark on ``ts`` first).
    """
    firsts = dict(firsts or {})
    cols = list(dict.fromkeys(firsts.values()))
    aggs = [F.min(ts).alias(first_ts_name), F.count(F.lit(1)).alias(count_name)]
    if cols:
        first = F.struct(F.col(ts).alias("t"), *[F.col(c).alias(f"b{i}") for i, c in enumerate(tiebreak)],
                         *[F.col(c).alias(f"v{i}") for i, c in enumerate(cols)])
        aggs.append(F.min(first).alias("_first"))
    out = df.groupBy(F.col(key), F.session_window(F.col(ts), session_gap(gap_days)).alias("session")).agg(*aggs)
    return out.select(key, F.col("session.start").alias("session_start"), F.col("session.end").alias("session_end"),
                      first_ts_name, count_name,
                      *[F.col("_first")[f"v{cols.index(c)}"].alias(n) for n, c in firsts.items()])


def stream_checkpoint(spark: SparkSession, name: str) -> str:
    """A folder for stream ``name`` that is the same after a restart."""
    from caretrail.session import stable_root
    root = stable_root(spark)
    if not root:
        raise ValueError("give checkpoint_location, or set spark.checkpoint.dir to a shared folder")
    return os.path.join(root, "streams", name)


def start_session_rollups(spark: SparkSession, source: str, schema: StructType, key: str, ts: str, gap_days: int, *,
                          watermark: str, name: str, sink: str, firsts: Mapping[str, str] | None = None,
                          tiebreak: Sequence[str] = (), output_mode: str = "append",
                          checkpoint_location: str | None = None, max_files_per_trigger: int | None = None,
                          available_now: bool = False) -> StreamingQuery:
    """Read new parquet files from ``source`` and append closed sessions to ``sink`` (parquet)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source)
    if isinstance(schema[ts].dataType, TimestampNTZType):
        # Watermarks need a zoned timestamp; the UTC session reads the wall time unchanged.
        stream = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    stream = stream.withWatermark(ts, watermark)
    out = session_rollups(stream, key, ts, gap_days, firsts=firsts, tiebreak=tiebreak)
    writer = (out.writeStream.queryName(name).outputMode(output_mode)
                 .option("checkpointLocation", checkpoint_location or stream_checkpoint(spark, name)))
    writer = writer.format("parquet").option("path", sink)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
