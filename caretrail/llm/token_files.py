"""Token-id files: one concatenated id array a shard, with Elias-Fano coded document boundaries.

Documents are range-partitioned by id and sorted, so shard k holds the ids after shard k - 1's. Each task
tokenizes its documents in order and streams a shard to the shared folder:

* ``shard-NNNNN.ids``: the ids of all its documents one after another, 16 bits each (32 for a larger
  vocabulary), each document ended by ``END_ID``;
* ``shard-NNNNN.idx``: magic, id width, then three Elias-Fano sequences: document boundaries (n + 1), the
  documents' ids as offsets from the smallest, and the places of null doc_ids.

A boundary costs about 2 + log2(mean length) bits rather than 64, and ``select`` returns any document's
offset without a table. Files are written under a name of the attempt and renamed when complete, so a lost
executor or a second attempt leaves nothing half-written. What the driver holds is one row a shard.

Defined results: a null or empty text has the end id alone. Null doc_ids come first. Repeated doc_ids are
ordered by text and kept. Extra columns are not read. An empty table writes no shard and reads as no rows.
Paths go through pyarrow's file systems (file, hdfs, s3, gs), as executors write outside Spark's writers.
"""

from __future__ import annotations

import posixpath
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caretrail.llm.common import Stages, table, text_arrays
from caretrail.llm.elias_fano import EliasFano
from caretrail.llm.tokens import tokenizer

END_ID = 2
MAGIC = b"EFTOKENS"
HEAD = "<8sHxxxxxxqQQ"
READ_IDS = 1 << 20


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _writer(root: str, tokenizer_path: str, wide: bool) -> Callable:
    kind = np.dtype("<u4" if wide else "<u2")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, ctx = tokenizer(tokenizer_path), TaskContext.get()
        shard, n_ids, lens, ids, nulls = ctx.partitionId(), 0, [], [], 0
        store, folder = _file_system(root)
        name = posixpath.join(folder, f"shard-{shard:05d}")
        temp = f"{name}.attempt-{ctx.taskAttemptId()}"
        out = None
        for batch in it:
            if not batch.num_rows:
                continue
            if out is None:
                store.create_dir(folder, recursive=True)
                out = store.open_output_stream(f"{temp}.ids")
            nulls += batch.column(0).null_count
            ids.append(batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)[batch.column(0).null_count:])
            raw, offsets = text_arrays(batch.column(1))
            for a, b, got, bounds in tok.encode(raw, offsets):
                flat = np.empty(len(got) + b - a, kind)
                ends = bounds[1:] + np.arange(b - a)
                body = np.ones(len(flat), bool)
                body[ends] = False
                flat[body], flat[ends] = got, END_ID
                out.write(flat.tobytes())
                lens.append(np.diff(bounds) + 1)
                n_ids += len(flat)
        if out is None:
            return
        out.close()
        lens, ids = np.concatenate(lens), np.concatenate(ids)
        low = int(ids.min()) if len(ids) else 0
        with store.open_output_stream(f"{temp}.idx") as f:
            f.write(struct.pack(HEAD, MAGIC, kind.itemsize, low, len(lens), nulls))
            f.write(EliasFano.encode(np.concatenate(([0], np.cumsum(lens)))).to_bytes())
            f.write(EliasFano.encode((ids - low).astype(np.uint64)).to_bytes())
        for end in (".ids", ".idx"):
            store.move(temp + end, name + end)
        yield pa.RecordBatch.from_pylist([{"shard": shard, "path": posixpath.join(root, f"shard-{shard:05d}"), "n_docs": len(lens), "n_ids": n_ids}],
                                         schema=pa.schema([("shard", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))
    return run


class Shard:
    """A shard's index, with random access to any document's ids."""

    def __init__(self, path: str) -> None:
        self.store, self.path = _file_system(path)
        with self.store.open_input_stream(f"{self.path}.idx") as f:
            data = f.read()
        magic, self.width, self.low, self.n_docs, self.nulls = struct.unpack_from(HEAD, data)
        if magic != MAGIC:
            raise ValueError(f"{path} is not a token file")
        self.bounds, at = EliasFano.from_bytes(data, struct.calcsize(HEAD))
        self.ids, _ = EliasFano.from_bytes(data, at)

    def doc_ids(self, a: int, b: int) -> list[int | None]:
        known = self.ids.slice(max(0, a - self.nulls), max(0, b - self.nulls)) + self.low
        return [None] * max(0, min(b, self.nulls) - a) + known.tolist()

    def tokens(self, a: int, b: int, file: pa.NativeFile | None = None) -> np.ndarray:
        """The ids of documents a to b - 1."""
        lo, hi = self.bounds[a], self.bounds[b]
        if file is None:
            with self.store.open_input_file(f"{self.path}.ids") as f:
                return self.tokens(a, b, f)
        return np.frombuffer(file.read_at((hi - lo) * self.width, lo * self.width), f"<u{self.width}")


def _reader(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
            shard = Shard(path)
            with shard.store.open_input_file(f"{shard.path}.ids") as f:
                step = max(1, READ_IDS * shard.n_docs // max(1, shard.bounds[shard.n_docs]))
                for a in range(0, shard.n_docs, step):
                    b = min(a + step, shard.n_docs)
                    bounds = shard.bounds.slice(a, b + 1)
                    got = shard.tokens(a, b, f).astype("<u4")
                    at = bounds - bounds[0]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard.doc_ids(a, b), pa.int64()), pa.array(bounds[:-1] + base), pa.array(np.diff(bounds)),
                         pa.array([zlib.crc32(got[at[i]:at[i + 1]]) for i in range(b - a)], pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def write_token_files(docs: DataFrame, root: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the shards below `root`; the result is a lazy manifest (shard, path, n_docs, n_ids): run it once."""
    wide = tokenizer(tokenizer_path).tokenizer.get_vocab_size() > 65536
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(_writer(root, tokenizer_path, wide), "shard bigint, path string, n_docs bigint, n_ids bigint")


def read_token_files(spark: SparkSession, manifest: list) -> DataFrame:
    """One row a document, read back from the files: doc_id, start, n_tokens, ids_crc32."""
    rows, base = [], 0
    for r in sorted(manifest, key=lambda r: r["shard"]):
        rows.append((r["path"], base))
        base += r["n_ids"]
    shards = spark.createDataFrame(rows, "path string, base bigint")
    return shards.repartition(max(1, len(rows))).mapInArrow(_reader, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = Stages(spark, "tokens")
    manifest = stages.keep(write_token_files(table(spark, sf_dir, "documents"), stages.path("files"), public_tokenizers.path("word_bpe_49k.json")), "manifest")
    return read_token_files(spark, manifest.collect())  # one row a shard
