"""Mixing sources to target weights by weighted fair queueing.

Every source has a target number of words: a budget is shared by weight, no target is above `repeats` times its
source's size, and what such a source leaves is shared again by weight among the others. A source's documents stand
in a shuffled order (by a hash of the id) and may be gone through `repeats` times. A document in that queue gets a
virtual finish time, the words of its source up to its end divided by the source's target; a document of more than
`PART` words is served in parts, each with a finish time of its own, so that one very long document doesn't carry its
source past the target or keep it short of it. All parts of all sources are sorted by finish time in ranges, and the
order is cut where the budget is spent: at time 1 every source has just given its target.

Plan. Texts are read once, for their sizes; all else runs on narrow rows. Rows that agree in id, source and size are
counted, and dealt out again in blocks, so no pile of copies meets in one task. A source's queue is cut into cells by
leading bits of the hash, about `CELL` rows each: sums of cells give each cell's start, a window runs inside a cell
only. Ranks of sources and shares are running sums over range partitions with one offset a partition. The sorted
copies are a stage table of ranges; only the range in which the budget runs out is summed row by row.

Defined results: a null text has size 0 and is taken 0 times; rows with a null or repeated doc_id each count; a null
source is a source of its own and comes last; equal hashes are ordered by size; documents that are
being served at the cut are taken in part (their first words), so that the budget (rounded down) is spent exactly. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caretrail.llm.common import Stages, table

WORD = r"[^\x20\x09-\x0D]+"
#: rows of a source's queue that one task sums
CELL = 50_000
#: words that are served at once
PART = 256
#: copies of one row that one task deals out
BLOCK = 1 << 16
#: up to so many sources their table is broadcast (some 100 bytes each), beyond it is joined with salted keys
FEW_SOURCES = 50_000
SALTS = 16


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size: the number of words of the whole text."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"))


def in_order(df: DataFrame, order: Sequence, sums: dict, stages: Stages, name: str) -> DataFrame:
    """df with running sums in a global order: sums inside each range partition plus the totals of those before it
    (one row a partition on the driver). `sums` maps new names to summed columns; sums include the row itself."""
    parts = stages.keep(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), name)
    totals = sorted(parts.groupBy("_part").agg(*[F.sum(c).alias(n) for n, c in sums.items()]).collect())
    starts, run = [], dict.fromkeys(sums, 0)
    for row in totals:
        starts.append((row["_part"], *run.values()))
        run = {n: run[n] + row[n] for n in sums}
    schema = ", ".join(["_part int", *(f"_{n} bigint" for n in sums)])
    before = F.broadcast(df.sparkSession.createDataFrame(starts, schema))
    w = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (parts.join(before, "_part").select("*", *[(F.sum(c).over(w) + F.col(f"_{n}")).alias(n) for n, c in sums.items()])
            .drop("_part", *(f"_{n}" for n in sums)))


def targets(sources: DataFrame, weights: Sequence[int], budget: Fraction, repeats: int, stages: Stages) -> DataFrame:
    """source, source_size, rows -> the same with pos (by code point, null last), cap, weight and target."""
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    spent = total * budget.numerator // budget.denominator
    ranked = in_order(sources.withColumn("one", F.lit(1).cast("bigint")), [F.col("source").asc_nulls_last()], {"pos": "one"}, stages, "ranks")
    weight = F.element_at(F.array(*[F.lit(w).cast("bigint") for w in weights]), (F.col("pos") % len(weights) + 1).cast("int"))
    ranked = stages.keep(ranked.withColumn("pos", F.col("pos") - 1).withColumn("weight", weight)
                         .select("source", "source_size", "rows", "pos", "weight", (F.col("source_size") * repeats).alias("cap")), "sources")
    ratio = (F.col("cap") / F.col("weight")).alias("ratio")
    filled = in_order(ranked.select("pos", "cap", "weight", ratio), [F.col("ratio"), F.col("pos")], {"caps": "cap", "taking": "weight"}, stages, "filling")
    everyone = ranked.agg(F.sum("weight")).first()[0] or 0
    # the level at which the sources before a row are full and the rest shares by weight
    level = (F.lit(spent) - (F.col("caps") - F.col("cap"))) / (F.lit(everyone) - (F.col("taking") - F.col("weight")))
    best = filled.select("ratio", "pos", level.alias("level")).where("level <= ratio").agg(F.min(F.struct("ratio", "pos", "level")).alias("at")).first()["at"]
    reached = F.col("weight") * F.lit(float(best["level"])) if best else F.col("cap").cast("double")
    return ranked.withColumn("target", F.least(F.col("cap").cast("double"), reached))


def _with_sources(rows: DataFrame, sources: DataFrame, n: int, salt) -> DataFrame:
    """rows of any source joined to their source's row; a source with very many rows stays spread."""
    known = sources.withColumnRenamed("source", "_source")
    if n <= FEW_SOURCES:
        return rows.join(F.broadcast(known), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    known = known.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return (rows.withColumn("_of", F.pmod(salt, F.lit(SALTS)).cast("int"))
            .join(known, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_of") == F.col("_salt"))).drop("_source", "_salt", "_of"))


def queues(docs: DataFrame, stages: Stages, weights: Sequence[int], budget: Fraction, repeats: int) -> DataFrame:
    """One row a document row: doc_id, size, pos, source, source_size, target, through (words of its source's queue up
    to its end, on the first pass)."""
    rows = stages.keep(sizes(docs), "sizes")
    per_source = stages.keep(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows")), "per-source")
    known = stages.keep(targets(per_source, weights, budget, repeats, stages), "targets")
    units = rows.groupBy("source", "doc_id", "size").agg(F.count("*").alias("copies"))
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    units = _with_sources(units.withColumn("key", key), known.drop("weight", "cap"), known.count(), F.crc32(F.col("key").cast("binary")))
    lead = F.conv(F.substring("key", 1, 8), 16, 10).cast("bigint")
    cells = F.ceil(F.col("rows") / CELL).cast("bigint")
    units = stages.keep(units.withColumn("cell", F.floor(lead * cells / F.lit(float(1 << 32))).cast("bigint")), "units")
    words = F.col("copies") * F.col("size")
    by_cell = units.groupBy("pos", "cell").agg(F.sum(words).alias("held"))
    along = Window.partitionBy("pos").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    by_cell = by_cell.select("pos", "cell", F.coalesce(F.sum("held").over(along), F.lit(0)).alias("start"))
    inside = Window.partitionBy("pos", "cell").orderBy("key", "size", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    units = units.withColumn("_end", F.sum(words).over(inside)).join(by_cell, ["pos", "cell"])
    units = units.withColumn("_begin", F.col("start") + F.col("_end") - words)
    return stages.keep(_dealt(units).select("doc_id", "size", "pos", "source", "source_size", "target", "through"), "queues")


def _dealt(units: DataFrame) -> DataFrame:
    """A row for each copy; units of more than a block are spread over tasks block by block."""
    def rows(df: DataFrame, n, begin) -> DataFrame:
        return df.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), n))).withColumn("through", begin + F.col("_i") * F.col("size"))

    few = rows(units.where(F.col("copies") <= BLOCK), F.col("copies"), F.col("_begin"))
    many = units.where(F.col("copies") > BLOCK).withColumn("_b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / BLOCK).cast("bigint"))))
    many = rows(many.repartition("pos", "key", "size", "_b"), F.least(F.lit(BLOCK).cast("bigint"), F.col("copies") - F.col("_b") * BLOCK),
                F.col("_begin") + F.col("_b") * BLOCK * F.col("size")).drop("_b")
    return few.unionByName(many)


#: the order in which parts are served
ORDER = ("finish", "pos", "through")


def _parts(size):
    return F.ceil(size / PART).cast("bigint")


def served(queue: DataFrame, repeats: int, stages: Stages) -> DataFrame:
    """All parts in ranges of their finish time: doc_id, size (of the part), pos, pass, through, finish, range. Stored
    sorted, range by range."""
    parts = queue.where("size > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    parts = parts.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), _parts(F.col("size")))))
    upto = F.least(F.col("_i") * PART, F.col("size"))
    parts = parts.select("doc_id", (upto - (F.col("_i") - 1) * PART).alias("size"), "pos", "pass", "target",
                         (F.col("pass") * F.col("source_size") + F.col("through") - F.col("size") + upto).alias("through"))
    parts = parts.select("doc_id", "size", "pos", "pass", "through", F.try_divide("through", "target").alias("finish"))
    return stages.keep(parts.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).withColumn("range", F.spark_partition_id()), "served")


def cut(order: DataFrame, spent: int) -> tuple | None:
    """(finish, pos, through, words beyond the budget) of the part in which the budget runs out; None if it never does."""
    before = 0
    for number, held in sorted(order.groupBy("range").agg(F.sum("size")).collect()):
        if before + held >= spent:
            run = F.sum("size").over(Window.partitionBy("range").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0))
            last = (order.where(F.col("range") == number).withColumn("run", run).where(F.col("run") >= spent - before)
                    .agg(F.min(F.struct(*ORDER, "run")).alias("at")).first()["at"])
            return last["finish"], last["pos"], last["through"], last["run"] - (spent - before)
        before += held
    return None


def _taken(end: tuple, number: int):
    """Words of a document that the order holds up to the cut on one pass."""
    begin = F.lit(number) * F.col("source_size") + F.col("through") - F.col("size")
    there = F.struct(F.lit(end[0]).alias("finish"), F.lit(end[1]).cast("bigint").alias("pos"), F.lit(end[2]).cast("bigint").alias("through"))

    def here(words):
        return F.struct(F.try_divide(begin + words, F.col("target")).alias("finish"), F.col("pos").alias("pos"), (begin + words).alias("through"))

    def upto(i):
        return F.least(i * PART, F.col("size"))

    last = F.size(F.filter(F.sequence(F.lit(1).cast("bigint"), _parts(F.col("size"))), lambda i: here(upto(i)) <= there))
    inside = upto(last) - F.when(here(upto(last)) == there, F.lit(end[3])).otherwise(F.lit(0))
    return F.when(here(F.col("size")) < there, F.col("size")).when(here(upto(F.lit(1))) > there, F.lit(0)).otherwise(inside).cast("bigint")


def mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), budget: Fraction = Fraction(3, 2), repeats: int = 2) -> DataFrame:
    """One row a document row: doc_id, size, source, source_size, target, taken, finish (of its first copy). `weights`
    repeat over the sources in code point order, `budget` is a share of all words, a document is taken up to `repeats` times."""
    stages = Stages(docs.sparkSession, "mixing")
    queue = queues(docs, stages, weights, Fraction(budget), repeats)
    total = queue.agg(F.sum("size")).first()[0] or 0
    spent = total * Fraction(budget).numerator // Fraction(budget).denominator
    end = cut(served(queue, repeats, stages), spent) if spent else None
    taken = F.lit(0).cast("bigint")
    for i in range(repeats if spent else 0):
        taken = taken + (F.col("size") if end is None else _taken(end, i))
    taken = F.when((F.col("size") > 0) & (F.col("target") > 0), taken).otherwise(F.lit(0).cast("bigint"))
    return queue.select("doc_id", "size", "source", "source_size", "target", taken.alias("taken"),
                        F.try_divide("through", "target").alias("finish"))


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS pos FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][1 + pos % 3] AS weight, 2 * source_size AS cap, (sum(source_size) OVER () * 3 // 2)::BIGINT AS spent FROM s),
f AS (SELECT *, cap / weight AS ratio,
        (spent - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
        / (sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS level
      FROM w WINDOW o AS (ORDER BY cap / weight, pos)),
t AS (SELECT source, source_size, pos, spent, least(cap::DOUBLE, weight * (SELECT arg_min(level, ratio) FROM f WHERE level <= ratio)) AS target FROM w),
q AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.pos, t.spent, row_number() OVER () AS row,
        sum(d.size) OVER (PARTITION BY t.pos ORDER BY md5(coalesce(d.doc_id::VARCHAR, '')), d.size, d.doc_id ROWS UNBOUNDED PRECEDING)::BIGINT AS through
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT row, pos, spent, target, least(256, size - 256 * i) AS part, pass * source_size + through - size + least(size, 256 * (i + 1)) AS upto
      FROM q, range(2) p(pass), range((size + 255) // 256) k(i)),
r AS (SELECT *, sum(part) OVER (ORDER BY upto / target, pos, upto ROWS UNBOUNDED PRECEDING) AS run FROM e),
g AS (SELECT row, sum(greatest(0, least(part, spent - (run - part))))::BIGINT AS taken FROM r GROUP BY row)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM q LEFT JOIN g USING (row)
"""
