"""First-touch attributes (U12): the value on the first row of each key group.

``first_value(value) over (partition by keys order by order)`` with the default frame is the value
of the group's first row for every row; NULL values are kept, ties are broken by ``tiebreak``.

Plan shape. Most groups are small: they are shuffled by their key and a window gives each row its group's first value, in
one pass over rows and with one exchange. Groups that hold very many rows (a NULL key: all unconverted tickets) are
found in a bounded sample (:mod:`caretrail.operators.pieces`). Their first rows come from ``min(struct(order, tiebreak,
value))``, which Spark combines map-side, as a table with a row a hot group that the plan itself holds; their rows are never
shuffled at all, but look their value up map-side. Struct equality treats NULL fields as equal, so a NULL key group
behaves like the window's NULL partition. None of this rests on AQE's splitting of skewed joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caretrail.operators.pieces import Pieces, find_pieces, key_hash, local


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def first_values(df: DataFrame, keys, order: Sequence[str], values: dict[str, str], *,
                 tiebreak: Sequence[str] = ()) -> DataFrame:
    """One row per key group: the group key (struct ``_k``) and ``{out: value}`` of its first row."""
    ks = _keys(keys)
    cols = list(dict.fromkeys(values.values()))
    first = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(list(order) + list(tiebreak))],
                     *[F.col(c).alias(f"v{i}") for i, c in enumerate(cols)])
    agg = (df.groupBy(F.struct(*[F.col(k) for k in ks]).alias("_k"))
             .agg(F.min(first).alias("_m")))
    return agg.select("_k", *[F.col("_m")[f"v{cols.index(c)}"].alias(out) for out, c in values.items()])


def _split(df: DataFrame, pieces: Pieces) -> tuple[DataFrame, DataFrame]:
    """Rows of hot keys and rows of all others."""
    hashed, hot = df.withColumn("_h", key_hash(pieces.keys)), F.broadcast(pieces.cuts.select("_h"))
    return hashed.join(hot, "_h", "left_semi").drop("_h"), hashed.join(hot, "_h", "left_anti").drop("_h")


def first_touch(df: DataFrame, keys, order: Sequence[str], values: dict[str, str], *,
                tiebreak: Sequence[str] = (), group_rows: int | None = None) -> DataFrame:
    """Append ``{out: value}`` columns holding the first row's value of each row's key group. Groups of more than
    ``group_rows`` rows are answered map-side (see :func:`caretrail.operators.pieces.find_pieces`, which samples the
    keys while this plan is built)."""
    ks = _keys(keys)
    pieces = find_pieces(df, ks, [F.lit(0)], group_rows)
    hot, others = (None, df) if pieces.cuts is None else _split(df, pieces)
    w = Window.partitionBy(*ks).orderBy(*[F.col(c) for c in [*order, *tiebreak]])
    first = F.first(F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(values.values())])).over(w)
    out = others.withColumn("_f", first).select(*[F.col(c) for c in df.columns], *[F.col(f"_f.v{i}").alias(n) for i, n in enumerate(values)])
    if hot is None:
        return out
    firsts = F.broadcast(local(first_values(hot, ks, order, values, tiebreak=tiebreak)))
    looked_up = hot.withColumn("_k", F.struct(*[F.col(k) for k in ks])).join(firsts, "_k", "left").drop("_k")
    return out.unionByName(looked_up)


def first_touch_nested(df: DataFrame, groups: Sequence[str], order: Sequence[str], value: str,
                       outs: Sequence[str], *, tiebreak: Sequence[str] = (), group_rows: int | None = None) -> DataFrame:
    """First-row ``value`` for several nested groupings at once, e.g. session labels at 15/30/60 days.

    ``groups`` go from finest to coarsest, and every finest group must lie inside one group of each
    coarser grouping (sessions at a larger gap are unions of sessions at a smaller gap). One map-side
    combined aggregation over the finest groups is rolled up to the coarser ones on that small
    table, and the result is joined back to the rows once, instead of once per grouping.
    """
    finest, coarser = groups[0], list(groups[1:])
    first = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(list(order) + list(tiebreak))],
                     F.col(value).alias("v"))
    per = df.groupBy(F.col(finest)).agg(F.min(first).alias("_m0"), *[F.max(g).alias(g) for g in coarser])
    for i, g in enumerate(coarser, start=1):
        up = per.groupBy(F.struct(F.col(g)).alias("_u")).agg(F.min("_m0").alias(f"_m{i}"))
        per = per.withColumn("_u", F.struct(F.col(g))).join(up, "_u", "left").drop("_u")
    per = per.select(F.struct(F.struct(F.col(finest)).alias("g")).alias("_j"),
                     *[F.col(f"_m{i}.v").alias(out) for i, out in enumerate(outs)])
    pieces = find_pieces(df, [finest], [F.lit(0)], group_rows)
    hot, others = (None, df) if pieces.cuts is None else _split(df, pieces)

    def answered(rows: DataFrame, firsts: DataFrame) -> DataFrame:
        return rows.withColumn("_j", F.struct(F.struct(F.col(finest)).alias("g"))).join(firsts, "_j", "left").drop("_j")

    out = answered(others, per)
    if hot is None:
        return out
    of_hot = per.withColumn("_h", F.xxhash64("_j.g." + finest)).join(F.broadcast(pieces.cuts.select("_h")), "_h", "left_semi").drop("_h")
    return out.unionByName(answered(hot, F.broadcast(local(of_hot))))
