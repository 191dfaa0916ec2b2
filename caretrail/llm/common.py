"""Shared helpers: table access, stage tables in the shared folder, hash folds, bounded label samples."""

from __future__ import annotations

import os
import posixpath
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: bytes of text that an Arrow batch of whole documents is cut into before numpy work
SLICE_BYTES = 1 << 20


#: bytes of an Arrow batch between the JVM and a Python worker (Spark counts rows only, unless told otherwise)
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by size, so that a batch of long texts is no larger than one of short texts. A lower bound
    that the submitter set stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    try:
        now = int(spark.conf.get(key).rstrip("b"))
    except ValueError:  # a size with a unit, set by the submitter
        return
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def ship(spark: SparkSession) -> None:
    """Send this package's sources to the executors, once a session, unless they come with the job."""
    bound_batches(spark)
    sc = spark.sparkContext
    if getattr(sc, "_caretrail_shipped", False):
        return
    import caretrail

    top = os.path.dirname(os.path.abspath(caretrail.__file__))
    if os.path.isdir(top):
        out = os.path.join(tempfile.mkdtemp(prefix="caretrail-src-"), "caretrail_src.zip")
        with zipfile.ZipFile(out, "w") as z:
            for folder, _, names in os.walk(top):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.join("caretrail", os.path.relpath(full, top)))
        sc.addPyFile(out)
    sc._caretrail_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``). Only a local session without the
    setting gets a folder of its own; anywhere else its absence is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    global _OWN
    _OWN = globals().get("_OWN") or "file://" + tempfile.mkdtemp(prefix="caretrail-llm-")
    return _OWN


class Stages:
    """Tables of one operator run, written as Parquet below the shared folder. They cut the lineage
    (a lost executor costs at most one stage) and are read back with column pruning."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        bound_batches(spark)
        self.spark = spark
        self.root = posixpath.join(shared_root(spark), f"caretrail-{label}-{uuid.uuid4().hex[:12]}")

    def path(self, name: str) -> str:
        return posixpath.join(self.root, name)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables that no later step reads."""
        jvm = self.spark._jvm
        for name in names:
            p = jvm.org.apache.hadoop.fs.Path(self.path(name))
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def fold(id_col: str, k: int):
    """crc32 of the id's decimal text, modulo k (null ids fall in no fold)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % k


def text_arrays(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(utf-8 bytes, offsets) of a string column; a null text has length 0."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs [a, b) of documents of at most `limit` bytes together; a longer document stands alone."""
    n = len(offsets) - 1
    a = 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def batches_of(rows: int, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def label_sample(labels: DataFrame, id_col: str, label_col: str, per_class: int, k: int, held: int) -> DataFrame:
    """A bounded training sample: at most `per_class` ids for each label value, the ones whose hash
    comes first, out of those whose fold is not `held`. Rows with a null id or label don't count;
    an id with several labels counts once, by the larger. The bound makes the result safe to broadcast."""
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (fold(id_col, k) != held))
             .groupBy(F.col(id_col).alias("doc_id")).agg(F.max(label_col).alias("label")))
    parts = []
    for value in (0, 1):
        parts.append(known.where(F.col("label") == value)
                     .orderBy(F.xxhash64(F.col("doc_id"), F.lit(17)), "doc_id").limit(per_class))
    return parts[0].unionByName(parts[1])

