"""Prefix trie of conversations: which openings conversations share, and what storing them once would save.

A conversation is a path of turns; every distinct sequence of first turns is a node of the trie. The paths are sorted in
ranges (shards) of (path, conv_id) between splitters, which are paths of some of the conversations. Nodes that have
members on both sides of a splitter lie on that splitter's path, so the trie of the splitter paths, the skeleton,
holds every node that two shards share. It is broadcast. A shard walks its sorted paths once, with a stack as deep as
a path, and finishes all nodes outside the skeleton; for skeleton nodes it emits partial sums, which are then added up
over the shards. Copies of one conversation are split by conv_id like anything else.

A turn is 20 bytes of a path: 16 of the SHA-256 of its role and text, 4 with its number of words. A conversation
travels as one row of 20 bytes a turn. Texts are shuffled once, to order turns.

Bounds: the splitters are chosen from a bounded sample (`SAMPLE_BYTES` of paths; they decide how rows are spread, never
a result) and hold at most `TRIE_BYTES` together, so broadcast trie and skeleton are bounded whatever the input. The
hash over a skeleton node's ending members is streamed by one task from blocks of joined ids, since SHA-256 has no
partial form.

Defined results: rows with a null conv_id take no part; null turns come first; rows with equal turns are ordered by
role, then text; repeated rows are turns of their own; a null role or text is empty; extra columns are not read; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caretrail.llm.common import Stages, table

WORD = r"[^\x20\x09-\x0D]+"
STEP = 20
#: bytes of splitter paths, broadcast
TRIE_BYTES = 8 << 20
#: bytes of paths that splitters are chosen from; a longer path than LONGEST is no splitter
SAMPLE_BYTES, LONGEST = 16 << 20, STEP * 2048
#: bytes of paths a shard should have at most
SHARD_BYTES = 16 << 20
#: characters of joined ids in one block
ENDS = 1 << 16
NONE = hashlib.sha256(b"").hexdigest()


def paths(turns: DataFrame) -> DataFrame:
    """conv_id, path: the turns of every conversation in order, 20 bytes each."""
    rows = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).where("conv_id IS NOT NULL")
    said = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")
    words = F.lpad(F.hex(F.regexp_count("text", F.lit(WORD)).cast("bigint")), 8, "0")
    rows = rows.withColumn("step", F.concat(F.substring(F.sha2(said, 256), 1, 32), words))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.select("conv_id", F.row_number().over(order).alias("pos"), "step")
    steps = F.transform(F.array_sort(F.collect_list(F.struct("pos", "step"))), lambda x: x["step"])
    return rows.groupBy("conv_id").agg(F.unhex(F.array_join(steps, "")).alias("path"))


def rebuilt(convs: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Each conversation c with its first h turns taken from conversation c - c % every; h = crc32(c) % most."""
    heads = convs.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("_base"), F.substring("path", 1, STEP * (most - 1)).alias("_head"))
    both = convs.join(heads, F.col("conv_id") - F.col("conv_id") % every == F.col("_base"), "left")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most * STEP).cast("int")
    head = F.substring(F.coalesce("_head", F.lit(b"")), F.lit(1), h)
    return both.select("conv_id", F.concat(head, F.substring("path", h + 1, F.greatest(F.octet_length("path") - h, F.lit(0)))).alias("path"))


def splitters(convs: DataFrame, shards: int) -> list[tuple[bytes, int]]:
    """Up to shards - 1 (path, conv_id) that cut the conversations into ranges of about equally many turns."""
    n, size = convs.agg(F.count("*"), F.sum(F.octet_length("path"))).first()
    if not n:
        return []
    shards = min(n, max(shards, size // SHARD_BYTES))
    rate = min(1.0, 30 * shards / n, SAMPLE_BYTES / max(size, 1))
    chosen = convs.where((F.octet_length("path") <= LONGEST) & (F.shiftrightunsigned(F.xxhash64("conv_id", F.lit(11)), 1) <= min(int(rate * (1 << 63)), (1 << 63) - 1)))
    sample = sorted((bytes(r["path"]), r["conv_id"]) for r in chosen.collect())
    weight = sum(len(p) + STEP for p, _ in sample)
    out, run = [], 0
    for s in sample:
        if run * shards >= (len(out) + 1) * weight and len(out) < shards - 1:
            out.append(s)
        run += len(s[0]) + STEP
    held = sum(len(p) for p, _ in out)
    thin = -(-held // TRIE_BYTES) if held else 1
    while thin > 1 and sum(len(p) for p, _ in out[::thin]) > TRIE_BYTES:
        thin += 1
    return out[::thin]


class Skeleton:
    """The trie of the splitter paths. Node 0 is the root."""

    def __init__(self, cuts: list[tuple[bytes, int]]) -> None:
        self.child: dict[tuple[int, bytes], int] = {}
        self.up, self.own, self.kids, self.words = [-1], [0], [0], [0]
        for path, _ in cuts:
            at = 0
            for i in range(0, len(path), STEP):
                step = path[i:i + STEP]
                to = self.child.get((at, step))
                if to is None:
                    to = self.child[at, step] = len(self.up)
                    self.up.append(at)
                    self.own.append(int.from_bytes(step[16:], "big"))
                    self.kids.append(0)
                    self.kids[at] += 1
                at = to
        self.words = list(self.own)  # words of all skeleton nodes below, the node included
        for v in range(len(self.up) - 1, 0, -1):  # children come after their parents
            self.words[self.up[v]] += self.words[v]

    def line(self, v: int) -> list[int]:
        """The node and all above it."""
        out = []
        while v >= 0:
            out.append(v)
            v = self.up[v]
        return out


NODES = pa.schema([("skel", pa.int32()), ("up", pa.int32()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
                   ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
                   ("ends_sha256", pa.string()), ("shard", pa.int32()), ("seq", pa.int64()), ("ends", pa.string()),
                   ("still", pa.int64()), ("words", pa.int64()), ("line", pa.list_(pa.int32()))])
NODE_COLUMNS = ("skel int, up int, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
                "saved_tokens bigint, ends_sha256 string, shard int, seq bigint, ends string, still bigint, words bigint, line array<int>")


class _Frame:
    __slots__ = ("skel", "words", "low", "n", "kids", "leaves", "saved", "sha", "ends", "seq", "waiting")

    def __init__(self, skel: int, words: int) -> None:
        self.skel, self.words = skel, words
        self.low, self.n, self.kids, self.leaves, self.saved = None, 0, 0, 0, 0
        self.sha, self.ends, self.seq, self.waiting = None, [], 0, []


class _Shard:
    """One walk over the sorted paths of a shard. `out` gathers rows of NODES."""

    def __init__(self, number: int, skeleton: Skeleton, out: list[tuple]) -> None:
        self.number, self.skeleton, self.out = number, skeleton, out
        self.stack, self.last = [_Frame(0, 0)], b""

    def add(self, path: bytes, conv: int) -> None:
        last, stack = self.last, self.stack
        same, most = 0, min(len(path), len(last))
        if path[:most] == last[:most]:
            same = most
        else:
            while path[same:same + STEP] == last[same:same + STEP]:
                same += STEP
        while len(stack) > same // STEP + 1:
            self.close()
        for i in range(same, len(path), STEP):
            step, above = path[i:i + STEP], stack[-1].skel
            stack.append(_Frame(self.skeleton.child.get((above, step), -1) if above >= 0 else -1, int.from_bytes(step[16:], "big")))
        self.last = path
        top = stack[-1]
        top.n += 1
        top.low = conv if top.low is None else min(top.low, conv)
        if top.skel >= 0:
            top.ends.append(str(conv))
            if len(top.ends) * 8 >= ENDS:
                self.block(top)
        elif top.sha is None:
            top.sha = hashlib.sha256(str(conv).encode())
        else:
            top.sha.update(b",%d" % conv)

    def block(self, f: _Frame) -> None:
        self.out.append((f.skel, None, None, None, None, 0, 0, 0, 0, None, self.number, f.seq, ",".join(f.ends), None, None, None))
        f.seq, f.ends = f.seq + 1, []

    def close(self) -> None:
        f, depth = self.stack.pop(), len(self.stack)
        above = self.stack[-1] if self.stack else None
        if f.skel >= 0:
            if f.ends:
                self.block(f)
            s = self.skeleton
            f.saved += f.n * f.words  # less the words of each node once, when all shards are added up
            if f.n:
                self.out.append((f.skel, s.up[f.skel] if f.skel else None, f.low, depth, None, f.n, f.kids, f.leaves, f.saved, None,
                                 self.number, None, None, s.kids[f.skel], s.words[f.skel], None if s.kids[f.skel] else s.line(f.skel)))
        else:
            f.leaves = f.leaves or 1
            f.saved += (f.n - 1) * f.words
            for row in f.waiting:
                self.out.append((*row[:4], f.low, *row[5:]))
            row = (None, None, f.low, depth, None, f.n, f.kids, f.leaves, f.saved, f.sha.hexdigest() if f.sha else NONE,
                   self.number, None, None, None, None, None)
            if above.skel >= 0:
                self.out.append((None, above.skel, *row[2:]))
            else:
                above.waiting.append(row)
            above.kids += 1
        if above is not None:
            above.n += f.n
            above.leaves += f.leaves
            above.saved += f.saved
            if f.low is not None:
                above.low = f.low if above.low is None else min(above.low, f.low)

    def end(self) -> None:
        while self.stack:
            self.close()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), NODES)], schema=NODES)


def _sharded(cuts: list[tuple[bytes, int]]):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ids, p = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            shards = pa.array([bisect_right(cuts, (x, c)) for x, c in zip(p, ids)], pa.int32())
            yield pa.RecordBatch.from_arrays([shards, batch.column(0), batch.column(1)], ["shard", "conv_id", "path"])
    return run


def _walked(cuts: list[tuple[bytes, int]]):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        skeleton, now, out = Skeleton(cuts), None, []
        for batch in it:
            for shard, conv, path in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now.number != shard:
                    if now is not None:
                        now.end()
                    now = _Shard(shard, skeleton, out)
                now.add(path, conv)
                while len(out) >= 4096:
                    yield _batch(out[:4096])
                    del out[:4096]
        if now is not None:
            now.end()
        for i in range(0, len(out), 4096):
            yield _batch(out[i:i + 4096])
    return run


def _hashed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the blocks of each skeleton node, in order."""
    names = ["skel", "ends_sha256"]
    at, sha = None, None
    for batch in it:
        for skel, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if skel == at:
                sha.update(b"," + ends.encode())
                continue
            if at is not None:
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([sha.hexdigest()])], names)
            at, sha = skel, hashlib.sha256(ends.encode())
    if at is not None:
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([sha.hexdigest()])], names)


RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie(convs: DataFrame, shards: int | None = None) -> DataFrame:
    """The nodes of the trie of `convs` (conv_id, path), one row each."""
    spark = convs.sparkSession
    stages = Stages(spark, "trie")
    convs = stages.keep(convs, "paths")
    cuts = splitters(convs, shards or int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = convs.mapInArrow(_sharded(cuts), "shard int, conv_id bigint, path binary").repartition("shard").sortWithinPartitions("shard", "path", "conv_id")
    nodes = stages.keep(dealt.mapInArrow(_walked(cuts), NODE_COLUMNS), "nodes")

    blocks = nodes.where("ends IS NOT NULL").select("skel", "shard", "seq", "ends").repartition("skel").sortWithinPartitions("skel", "shard", "seq")
    hashes = blocks.select("skel", "ends").mapInArrow(_hashed, "skel int, ends_sha256 string")
    added = stages.keep(nodes.where("skel IS NOT NULL").groupBy("skel").agg(
        F.max("up").alias("up"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
        (F.sum("n_children") + F.max("still")).alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
        (F.sum("saved_tokens") - F.max("words")).alias("saved_tokens"), F.max("line").alias("line")), "skeleton")
    # a skeleton node without children is a leaf of itself and of all above it
    leaf = added.where("n_children = 0").select(F.explode("line").alias("skel")).groupBy("skel").agg(F.count("*").alias("more"))
    names = F.broadcast(added.select(F.col("skel").alias("up"), F.col("conv_id").alias("_parent")))
    skeleton = (added.drop("line").join(leaf, "skel", "left").join(hashes, "skel", "left").join(names, "up", "left")
                .withColumn("n_leaves", F.col("n_leaves") + F.coalesce("more", F.lit(0)))
                .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NONE))).withColumn("parent_conv_id", F.col("_parent")))
    local = (nodes.where("skel IS NULL").join(names, "up", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_parent")))
    return skeleton.select(*RESULT).unionByName(local.select(*RESULT))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = Stages(spark, "conversations").keep(paths(table(spark, sf_dir, "conversations")), "paths")
    return trie(rebuilt(convs))


#: CRC-32 is no function of the SQL engine: it is folded over the digits with a table made by its polynomial
ORACLE = r"""
WITH RECURSIVE crc_bits(i, k, v) AS (
  SELECT i::UBIGINT, 0, i::UBIGINT FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::UBIGINT) ELSE v // 2 END FROM crc_bits WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY i) AS tab FROM crc_bits WHERE k = 8),
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS base,
         xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c : ascii(c)::UBIGINT)),
                         lambda a, b : xor(a // 256, tab[(xor(a % 256, b) + 1)::BIGINT])), 4294967295::UBIGINT) % 4 AS h
  FROM turns, crc_table),
built AS (
  SELECT i.conv_id, t.pos, t.role, t.text FROM ids i JOIN turns t ON t.conv_id = i.base AND t.pos <= i.h
  UNION ALL SELECT i.conv_id, i.h + t.pos, t.role, t.text FROM ids i JOIN turns t ON t.conv_id = i.conv_id AND t.pos > i.h),
path AS (
  SELECT i.conv_id, coalesce(list(sha256(length(role)::VARCHAR || ':' || role || text) ORDER BY pos) FILTER (pos IS NOT NULL), []) AS steps,
         coalesce(list(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) ORDER BY pos) FILTER (pos IS NOT NULL), []) AS words
  FROM ids i LEFT JOIN built USING (conv_id) GROUP BY i.conv_id),
member AS (SELECT conv_id, len(steps) AS n, d AS depth, array_to_string(steps[1:d], ',') AS node, array_to_string(steps[1:d-1], ',') AS up,
                  CASE WHEN d > 0 THEN words[d] ELSE 0 END AS words
           FROM path, range(len(steps) + 1) r(d)),
node AS (SELECT node, any_value(up) AS up, min(conv_id) AS conv_id, depth, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved,
                sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
         FROM member GROUP BY node, depth),
kids AS (SELECT up, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY up),
tops AS (SELECT node, d, array_to_string(string_split(node, ',')[1:d], ',') AS top, saved, n_children IS NULL AS leaf
         FROM node LEFT JOIN kids ON kids.up = node.node, range(depth + 1) r(d)),
sums AS (SELECT top, sum(leaf::INT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM tops GROUP BY top)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM node n LEFT JOIN node p ON n.depth > 0 AND p.node = n.up AND p.depth = n.depth - 1 LEFT JOIN kids k ON k.up = n.node JOIN sums s ON s.top = n.node
"""
