"""Near duplicates: universal hash minima with banding, signature check, exact check, components.

Documents with 100 * |A and B| >= 75 * |A or B| over their distinct 5-word shingles are linked, and
``component_id`` is the smallest doc_id reachable over links.

1. One pass over the texts (numpy on Arrow batches): set size, a 128-bit digest of the set, the minima
   of ``HASHES`` universal hashes (one bit of each is kept for the signature check), the band keys, and a
   parity sketch: ``PARITY`` bits, each flipped once by every shingle that hashes to it.
2. Documents with one digest have one set: they form a class, and its smallest id stands for it. Only
   such representatives go on, so copies never meet in a bucket.
3. Band keys group representatives. A bucket offers each member one partner, its smallest member
   (pivot): as many pairs as members. Each member's best pivot by signature is checked on full sets.
4. Components of these links. A bucket whose members are still in different components can hide a link
   between two members other than the pivot: its rows outside the bucket's largest component are paired
   with the rest of it, every one with every other. A bucket with more than ``HOT`` such pairs a member is
   dealt in blocks of about ``BLOCK`` rows on either side, and each pair of blocks is a join key of its own, so
   no task gets a whole bucket. The comparisons are as many as the pairs; only near pairs become rows.
5. Candidates pass the signature check (sizes, and at most ``FAR`` of 256 signature bits different,
   as part of the join), then the exact check on full sets, then large-star/small-star joins everything.
   The join also compares parity sketches. Shared shingles cancel out and each other one flips one bit at
   most, so sketches that differ in more bits than a link leaves shingles unshared prove that there is no
   link. This loses nothing; it is sharp while the sets differ in fewer shingles than the sketch has bits.

A pair at the threshold itself shares none of the 50 bands of 6 rows with probability 6e-5 (0.8: 3e-7);
its signatures differ in 32 bits with standard deviation 5.3, so FAR lies five deviations above. Blocks lose
nothing: a pair that shares a bucket, whatever its size, meets there. Nothing is capped.

Defined results: a null or empty text (or one of white space only) has n_shingles 0 and is alone, even
beside others of its kind. Fewer than five words: one shingle, the whole sequence. Repeated rows with one
doc_id give one row per input row, with one component (an id with several texts links whatever any of them links). A row with a null doc_id is alone: component
null, kept true. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caretrail.llm.common import Stages, table, text_arrays
from caretrail.llm.components import components
from caretrail.llm.hashing import U, distinct, mix, shingles, word_hashes

HASHES, ROWS, BANDS = 256, 6, 50
HOT, BLOCK = 512, 1024
BLOOM_BITS = 1 << 25
FAR = 58
BITS = ("s0", "s1", "s2", "s3")
PARITY = 512
ODD = tuple(f"x{i}" for i in range(PARITY // 64))
NUM, DEN = 75, 100


def _numbers(n: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed))


A = _numbers(HASHES, 11) | U(1)
B = _numbers(HASHES, 12)


def _rows_of(count: int, rows: int, seed: int) -> np.ndarray:
    """Which signature positions each band reads: without repeats in a band, spread evenly."""
    rng = np.random.RandomState(seed)
    flat = np.concatenate([rng.permutation(HASHES) for _ in range(-(-count * rows // HASHES) + 1)])
    out, at = [], 0
    while len(out) < count:
        pick = np.unique(flat[at:at + rows])
        at += rows
        if at + rows > len(flat):
            flat, at = np.concatenate([rng.permutation(HASHES) for _ in range(4)]), 0
        if len(pick) == rows:
            out.append(pick)
    return np.array(out)


BAND_ROWS = _rows_of(BANDS, ROWS, 5)


def minima(s: np.ndarray) -> np.ndarray:
    """For each universal hash (a x + b mod 2^64, high bits count) its minimum over the set."""
    out = np.full(HASHES, np.iinfo(np.uint64).max, U)
    for i in range(0, len(s), 2048):
        part = s[i:i + 2048]
        for j in range(0, HASHES, 32):
            h = A[j:j + 32, None] * part
            h += B[j:j + 32, None]
            np.minimum(out[j:j + 32], h.min(axis=1), out=out[j:j + 32])
    return out


def _fold_rows(values: np.ndarray, rows: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band: the chosen signature values mixed in order."""
    key = mix(seed)
    for j in range(rows.shape[1]):
        key = mix(key * U(0x9FB21C651E98DF25) + values[rows[:, j]])
    return key


def parity(s: np.ndarray) -> np.ndarray:
    """The parity sketch of a set of shingle hashes, as words."""
    at = (mix(s + U(0x632BE59BD9B4E019)) & U(PARITY - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=PARITY) & 1).astype(np.uint8)).view(np.int64)


def signatures(text: pa.Array) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
    """(set size, digest 1, digest 2, signature and sketch words, band keys) for each text, in order."""
    raw, offsets = text_arrays(text)
    seeds = _numbers(BANDS, 77)
    with np.errstate(over="ignore"):
        for a, b, h, bounds in word_hashes(raw, offsets):
            for i in range(b - a):
                s = distinct(shingles(h[bounds[i]:bounds[i + 1]]))
                if not len(s):
                    yield 0, 0, 0, np.zeros(len(BITS + ODD), np.int64), np.zeros(0, np.int64)
                    continue
                low = minima(s) >> U(24)
                d1 = mix(s).sum(dtype=U)
                d2 = mix(s * U(0xC2B2AE3D27D4EB4F) + U(99)).sum(dtype=U)
                keys = _fold_rows(low, BAND_ROWS, seeds)
                words = np.packbits((mix(low) & U(1)).astype(np.uint8)).view(np.int64)
                yield len(s), int(d1.view(np.int64)), int(d2.view(np.int64)), np.concatenate((words, parity(s))), keys.view(np.int64)


SIG_SCHEMA = "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, " + "".join(f"{c} bigint, " for c in BITS + ODD) + "bands array<bigint>"


def _sign(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in it:
        for i in range(0, whole.num_rows, 512):
            batch = whole.slice(i, 512)
            got = list(signatures(batch.column(1)))
            if not got:
                continue
            n, d1, d2, words, bands = zip(*got)
            bounds = np.concatenate(([0], np.cumsum([len(x) for x in bands]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                 *(pa.array(w) for w in np.array(words).T), pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(bands)))],
                ["doc_id", "n_shingles", "d1", "d2", *BITS, *ODD, "bands"])


def _places(column: str) -> list:
    """Two positions of an id in the Bloom filter."""
    return [F.pmod(F.xxhash64(column, F.lit(seed)), F.lit(BLOOM_BITS)) for seed in (1, 2)]


def _bloom(nodes: DataFrame) -> np.ndarray:
    """A Bloom filter of ids, of fixed size (4 MB), gathered as its words that are not 0."""
    at = nodes.select(F.explode(F.array(*_places("node"))).alias("p"))
    words = at.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(BLOOM_BITS // 64, np.int64)
    out[words.column("w").to_numpy()] = words.column("bits").to_numpy()
    return out.view(U)


def _sets(bloom: np.ndarray) -> Callable:
    """(doc_id, sorted distinct shingle hashes as bytes) of the documents that the filter lets through."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in it:
            hit = np.ones(whole.num_rows, bool)
            for name in ("p1", "p2"):
                p = whole.column(name).to_numpy()
                hit &= (bloom[p >> 6] >> (p & 63).astype(U)) & U(1) == U(1)
            picked = np.flatnonzero(hit)
            for i in range(0, len(picked), 256):
                batch = whole.take(pa.array(picked[i:i + 256]))
                raw, offsets = text_arrays(batch.column("text"))
                out = []
                for a, b, h, bounds in word_hashes(raw, offsets):
                    out += [distinct(shingles(h[bounds[j]:bounds[j + 1]])).tobytes() for j in range(b - a)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], ["node", "shingles"])
    return run


def _exact(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        keep = []
        for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()):
            p, q = np.frombuffer(x, U), np.frombuffer(y, U)
            if NUM * max(len(p), len(q)) > DEN * min(len(p), len(q)):  # sizes too far apart for any overlap
                keep.append(False)
                continue
            both = np.concatenate((p, q))
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            keep.append(DEN * common >= NUM * (len(p) + len(q) - common))
        mask = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], ["u", "v"])


def _apart(x: str, y: str, words: tuple = BITS):
    """Number of signature bits in which two rows differ; their columns have the prefixes x and y."""
    return sum((F.bit_count(F.col(x + c).bitwiseXOR(F.col(y + c))) for c in words), F.lit(0))


def _near(x: str, y: str):
    """The signature check: sizes that allow the threshold, signatures near enough, and parity sketches
    that differ in no more bits than a link leaves shingles unshared."""
    n, m = F.col(x + "n"), F.col(y + "n")
    return ((NUM * n <= DEN * m) & (NUM * m <= DEN * n) & (_apart(x, y) <= FAR)
            & ((DEN + NUM) * _apart(x, y, ODD) <= (DEN - NUM) * (n + m)))


def _renamed(sig: DataFrame, prefix: str, node: str, *more: str) -> DataFrame:
    return sig.select(*more, F.col("node").alias(node), *(F.col(c).alias(prefix + c) for c in ("n", *BITS, *ODD)))


def _blocks(rows: DataFrame, own: str, other: str) -> DataFrame:
    """Each row in its block of its own side of the bucket, once for each block of the other side."""
    return (rows.withColumn(own, F.pmod(F.xxhash64("node", F.lit(own)), F.col(f"n_{own}")))
            .withColumn(other, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(f"n_{other}") - 1))))


def _rated(pairs: DataFrame, sig: DataFrame) -> DataFrame:
    """pairs (a, b) that pass the signature check, with the number of bits apart."""
    got = pairs.join(_renamed(sig, "a_", "a"), "a").join(_renamed(sig, "b_", "b"), "b")
    return got.where(_near("a_", "b_")).select("a", "b", _apart("a_", "b_").alias("apart"))


def _verified(pairs: DataFrame, docs: DataFrame, stages: Stages, name: str) -> DataFrame:
    """The pairs (a, b) whose full shingle sets meet the threshold, as edges (u, v)."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    nodes = stages.keep(nodes, f"nodes-{name}")
    # texts stay where they are read: a Bloom filter of fixed size picks the documents whose sets go on (with far
    # more ids than it has bits it lets all through, which costs time alone), and the join makes the choice exact
    p1, p2 = _places("doc_id")
    named = docs.where("doc_id IS NOT NULL").select("doc_id", "text", p1.alias("p1"), p2.alias("p2"))
    sets = named.mapInArrow(_sets(_bloom(nodes)), "node bigint, shingles binary").join(nodes, "node", "left_semi")
    # an id has one set for each different text under it
    sets = stages.keep(sets.groupBy("node", F.xxhash64("shingles")).agg(F.first("shingles").alias("shingles"))
                       .select("node", "shingles"), f"sets-{name}")
    got = (pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a")
           .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b"))
    out = stages.keep(got.select("a", "b", "set_a", "set_b").mapInArrow(_exact, "u bigint, v bigint"), f"links-{name}")
    stages.drop(f"sets-{name}")
    return out.distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept. See the module docstring."""
    spark = docs.sparkSession
    stages = Stages(spark, "near")
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    signed = stages.keep(docs.mapInArrow(_sign, SIG_SCHEMA), "signed")
    # classes: rows with one digest, or with one id (repeated ids join the classes of their texts)
    usable = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # (kept as a table: both sides of the join back are then plain shuffles, which AQE splits at a hot class)
    classes = stages.keep(usable.groupBy("n_shingles", "d1", "d2").agg(F.min("doc_id").alias("node")), "classes")
    member = stages.keep(signed.select("doc_id", "n_shingles", "d1", "d2").join(
        classes, ["n_shingles", "d1", "d2"], "left").select("doc_id", "n_shingles", "node"), "member")
    reps = usable.join(classes.select("node", F.col("d1").alias("r1"), F.col("d2").alias("r2")),
                       (F.col("doc_id") == F.col("node")) & (F.col("d1") == F.col("r1")) & (F.col("d2") == F.col("r2")), "inner")
    sig = stages.keep(reps.groupBy("node", "d1", "d2").agg(
        F.first("n_shingles").alias("n"), *(F.first(c).alias(c) for c in BITS + ODD), F.first("bands").alias("bands"))
                      .select("node", "n", *BITS, *ODD, "bands"), "reps")
    stages.drop("signed")

    banded = sig.select("node", F.explode("bands").alias("key"))
    buckets = stages.keep(banded.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("top"))
                          .where("pivot < top").drop("top"), "buckets")
    shared = stages.keep(banded.join(buckets, "key").select("key", "node", "pivot"), "shared")

    stars = shared.where("node <> pivot").groupBy(F.col("node").alias("a"), F.col("pivot").alias("b")).agg(F.lit(1).alias("x")).drop("x")
    rated = stages.keep(_rated(stars, sig), "rated")
    best = rated.groupBy("a").agg(F.min(F.struct("apart", "b")).alias("m")).select("a", F.col("m.b").alias("b"))
    links = _verified(best, docs, stages, "first")
    # ids that stand for several texts (repeated ids) tie their classes together
    same_id = member.where("node IS NOT NULL AND doc_id <> node").groupBy("doc_id", "node").agg(F.lit(1).alias("x"))
    tied = same_id.join(same_id.groupBy("doc_id").agg(F.min("node").alias("low"), F.count("*").alias("k")).where("k > 1"), "doc_id") \
        .where("node <> low").select(F.col("node").alias("u"), F.col("low").alias("v"))
    own = member.where("node IS NOT NULL AND doc_id <> node").join(sig.select(F.col("node").alias("doc_id")), "doc_id", "left_semi") \
        .select(F.col("doc_id").alias("u"), F.col("node").alias("v"))
    links = stages.keep(links.union(tied).union(own).distinct(), "links-1")

    first = components(links, stages, "cc1")
    first = stages.keep(first, "comp-1")
    more = _across(shared, rated, first, sig, docs, stages)
    final = components(links.union(more), stages, "cc2")
    named = member.join(final, "node", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(
            F.coalesce("component", "node", "doc_id")).alias("component_id"))
    return named.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _across(shared: DataFrame, rated: DataFrame, comp: DataFrame, sig: DataFrame, docs: DataFrame, stages: Stages) -> DataFrame:
    """Links between members of one bucket that the stars did not connect."""
    label = comp.select("node", "component")
    rows = stages.keep(shared.select("key", "node").join(label, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("comp")), "open")

    # rows of buckets whose members are in several components, with the bucket's largest component and the number of
    # blocks outside it and in all: one, unless the bucket is hot (more than HOT pairs a member lie across components)
    sizes = rows.groupBy("key", "comp").agg(F.count("*").alias("c"))
    keys = sizes.groupBy("key").agg(F.sum("c").alias("m"), F.sum(F.col("c") * F.col("c")).alias("sq"), F.count("*").alias("k"),
                                    F.max(F.struct("c", "comp")).alias("top")).where("k > 1")
    blocks = lambda n: F.when(F.expr("m * m - sq") > HOT * F.col("m"), F.ceil(n / BLOCK)).otherwise(F.lit(1)).cast("bigint")
    keys = keys.select(F.struct("key").alias("k"), F.col("top.comp").alias("main"),
                       blocks(F.col("m") - F.col("top.c")).alias("n_ba"), blocks(F.col("m")).alias("n_bb"))
    # joined on a struct, so that both sides are shuffled anew and AQE can split a large bucket
    part = rows.withColumn("k", F.struct("key")).join(keys, "k").drop("k")
    part = stages.keep(part.join(sig.select("node", "n", *BITS, *ODD), "node")
                       .select("key", "node", "comp", "n", *BITS, *ODD, "main", "n_ba", "n_bb"), "mixed")
    stages.drop("open")
    x = _renamed(_blocks(part.where("comp <> main"), "ba", "bb"), "a_", "a", "key", "ba", "bb", F.col("comp").alias("ca"))
    y = _renamed(_blocks(part, "bb", "ba"), "b_", "b", "key", "ba", "bb", F.col("comp").alias("cb"))
    got = x.join(y, (x.key == y.key) & (x.ba == y.ba) & (x.bb == y.bb) & (F.col("ca") != F.col("cb")) & _near("a_", "b_"))
    pairs = [got.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))]
    # star pairs whose first choice was another pivot, if still apart
    la, lb = label.select(F.col("node").alias("a"), F.col("component").alias("ca")), label.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    pairs.append(rated.select("a", "b").join(la, "a", "left").join(lb, "b", "left").where(
        F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"))
    return _verified(stages.keep(reduce(DataFrame.union, pairs).distinct(), "rest"), docs, stages, "rest")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns, of any type and name) that stay when one document of each group stays: for each
    kept doc_id one row for each different text; of such repeated rows the one whose other columns, as JSON, hash
    first (equal hashes: any of them). Rows without a doc_id stay as they are. An empty table gives no rows."""
    gone = near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias("gone_id")).distinct()
    others = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("doc_id", "text")]
    place = F.xxhash64(F.to_json(F.struct(*others))) if others else F.lit(0)
    # a row travels as one struct, so that no name of its columns meets a name used here
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("bigint").alias("id"),
                       F.sha2(F.col("text").cast("string").cast("binary"), 256).alias("digest"), place.alias("place"))
    left = rows.where("id IS NOT NULL").join(gone, F.col("id") == F.col("gone_id"), "left_anti")
    once = left.groupBy("id", "digest").agg(F.min_by("row", "place").alias("row"))
    return once.select("row.*").unionByName(rows.where("id IS NULL").select("row.*"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ')
         ELSE array_to_string(ws[i:i + 4], ' ') END AS sh
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 75 * (x.n + y.n - c)),
r AS (SELECT doc_id AS node, doc_id AS seen FROM documents
      UNION SELECT r.node, e.v FROM r JOIN e ON e.u = r.seen),
m AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.node = d.doc_id
"""
