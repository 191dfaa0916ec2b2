"""Gap-based sessions of repeated contacts (U13) and per-session rollups (U14).

Semantics (per key, rows ordered by time, ties broken by ``tiebreak``):

* ``lag``            previous row's time, NULL for the first row;
* ``date_diff_lag``  whole elapsed days from ``lag`` to the row's time;
* ``n_<gap>``        running count of session starts, where a row starts a session when it has no
                     previous row or ``date_diff_lag > gap``. The running count uses the default
                     RANGE frame: rows with equal time share one value, so two NULL-time rows of a
                     key both get 2, not 1 and 2;
* label              ``concat(key, '-', n)``; a NULL key gives a NULL label, so all sessions of the
                     NULL key form one rollup group, exactly as a window partitioned by the label;
* ``count``          rows per key.

Plan shape: a segmented scan. ``Window.partitionBy(key)`` would send a key's whole history to one task. Here the rows
are read and shuffled once, by ``(key, piece)``: keys are whole, except for the hot ones, which are cut into pieces at
quantiles of their order (:mod:`caretrail.operators.pieces`), also inside an instant that very many rows share.

1. Inside a piece, windows give the previous time, the session starts and their running count. Sessions follow one another
   in the order, so the rollups of all gaps take one window forwards (what the last session start saw) and one backwards
   (where the next session starts) instead of a sorted window for each gap's labels.
2. If there are hot keys, one more job over their rows alone makes the border table, a row a piece: first and last
   time, rows, session starts inside, and the rollups of the piece's first and last session. These few rows are gone
   through once on the driver, which carries the last time, the number of sessions and the sums of sessions that
   cross borders from piece to piece. The number of pieces is bounded by the number of shuffle partitions, not by the data.
3. The border row is joined map-side: a piece's first row sees the time before the piece, session numbers start at
   what the pieces before hold, and the rollups of a piece's first and last session are replaced by the whole ones.

Rows that are equal altogether are told apart by nothing. Without a unique tiebreak they first collapse into units with
a multiplicity, combined map-side, and are dealt out again at the end, in blocks when a unit is very large.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from caretrail.functions.timeutil import whole_days
from caretrail.operators.pieces import find_pieces


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _label(keys: list[str], n: Column) -> Column:
    return F.concat(*[F.col(k) for k in keys], F.lit("-"), n)


# Largest number of rows one task re-expands from a unit of identical rows; bigger units are cut
# into blocks that are spread over tasks first.
EXPAND_BLOCK = 1 << 16


def _expand_units(out: DataFrame, ts: str) -> DataFrame:
    """Back from units (equal rows with a multiplicity) to rows: the first copy has the previous time, the others
    follow a row of their own time."""
    def lags(n: Column, first: Column) -> Column:
        own = F.array_repeat(F.col(ts), (n - F.when(first, 1).otherwise(0)).cast("int"))
        return F.when(first, F.concat(F.array(F.col("_prev")), own)).otherwise(own)

    small = out.where(F.col("_mult") <= EXPAND_BLOCK).withColumn("_prev", F.explode(lags(F.col("_mult"), F.lit(True))))
    big = out.where(F.col("_mult") > EXPAND_BLOCK)
    nblocks = F.ceil(F.col("_mult") / EXPAND_BLOCK).cast("bigint")
    big = (big.withColumn("_blk", F.explode(F.sequence(F.lit(0).cast("bigint"), nblocks - 1)))
              .repartition(F.xxhash64(*[F.col(c) for c in out.columns]), "_blk")
              .withColumn("_n", F.least(F.lit(EXPAND_BLOCK).cast("bigint"), F.col("_mult") - F.col("_blk") * EXPAND_BLOCK))
              .withColumn("_prev", F.explode(lags(F.col("_n"), F.col("_blk") == 0)))
              .drop("_blk", "_n"))
    return small.unionByName(big)


def sessionize(df: DataFrame, key, ts: str, gaps: Sequence[int] = (15,), *,
               tiebreak: Sequence[str] = (),
               tiebreak_unique: bool = False,
               count_name: str = "num_contacts",
               number_fmt: str = "n_contact_{gap}",
               label_fmt: str | None = "client_{gap}",
               lag_name: str | None = "lag",
               diff_name: str | None = "date_diff_lag",
               first_ts_fmt: str | None = None,
               group_count_fmt: str | None = None,
               firsts: Mapping[str, str] | None = None,
               piece_rows: int | None = None) -> DataFrame:
    """Append session columns to every row of ``df`` (no row is added or dropped).

    ``first_ts_fmt`` / ``group_count_fmt`` / ``firsts`` add the U14 rollups per session group:
    earliest time, row count, and for each ``{out_fmt: column}`` in ``firsts`` the value of that
    column on the session's first row (time, then ``tiebreak``; NULL values are kept). Format
    strings take ``{gap}``. ``tiebreak_unique=True`` declares that no two rows of a key share time
    and tiebreak values, which saves looking for equal rows. ``piece_rows`` is the number of rows beyond which a
    key is cut (see :func:`caretrail.operators.pieces.find_pieces`, which reads key, time and tiebreak while this
    plan is built; write an expensive ``df`` to a stage first).
    """
    keys, gaps, firsts = _keys(key), list(gaps), dict(firsts or {})
    values = list(dict.fromkeys(firsts.values()))
    rolled = bool(first_ts_fmt or group_count_fmt or firsts)

    # the order of rows inside a key: time, tiebreak and, if rows may share both, the rest of the row
    order = [F.col(ts), *[F.col(c) for c in tiebreak]]
    cut_by = list(order)
    if tiebreak_unique:
        units = df.withColumn("_mult", F.lit(1).cast("bigint"))
    else:
        cut_by.append(F.xxhash64(*[F.col(c) for c in df.columns]))
        order = [*cut_by, *[F.col(c) for c in df.columns]]
        units = df.groupBy(*[F.col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_mult"))
    pieces = find_pieces(df, keys, cut_by, piece_rows)
    unkeyed = F.lit(False)
    for k in keys:
        unkeyed = unkeyed | F.col(k).isNull()
    scan = _Scan(keys, ts, gaps, order, unkeyed, firsts, values, rolled)

    rows = scan.lagged(pieces.assign(units))
    border = scan.border(scan.lagged(pieces.of_hot_keys(units))) if pieces.cuts is not None else None
    out = scan.answered(rows, border)
    if not tiebreak_unique:
        out = _expand_units(out, ts)

    new_cols: dict[str, Column] = {count_name: F.col("_num")}
    for g in gaps:
        new_cols[number_fmt.format(gap=g)] = F.col(f"_n{g}")
    if diff_name:
        new_cols[diff_name] = whole_days(F.col("_prev"), F.col(ts))
    if lag_name:
        new_cols[lag_name] = F.col("_prev")
    if label_fmt:
        for g in gaps:
            new_cols[label_fmt.format(gap=g)] = _label(keys, F.col(f"_n{g}"))
    for g in gaps if rolled else ():
        if first_ts_fmt:
            new_cols[first_ts_fmt.format(gap=g)] = F.col(f"_r{g}.low")
        if group_count_fmt:
            new_cols[group_count_fmt.format(gap=g)] = F.col(f"_r{g}.rows")
        for out_fmt, col in firsts.items():
            new_cols[out_fmt.format(gap=g)] = F.col(f"_r{g}.v{values.index(col)}")
    base_cols = [c for c in df.columns if c not in new_cols]
    return out.select(*[F.col(c) for c in base_cols], *[v.alias(k) for k, v in new_cols.items()])


class _Scan:
    """The windows inside pieces and the border table between them, for one call of :func:`sessionize`.

    Rows have ``_mult`` (copies) and ``_p`` (piece, NULL for keys in one piece). Session numbers are counted as
    NULL-time rows of the key (each starts a session, and all share the last number) plus starts among the others."""

    def __init__(self, keys, ts, gaps, order, unkeyed, firsts, values, rolled) -> None:
        self.keys, self.ts, self.gaps, self.unkeyed, self.values, self.rolled = keys, ts, gaps, unkeyed, values, rolled
        self.whole = Window.partitionBy(*keys, "_p")
        self.along = self.whole.orderBy(*order)
        self.upto = self.along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        self.beyond = self.whole.orderBy(*[c.desc() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
        self.timeless = F.col(ts).isNull()
        # a session's first row: the smallest by order; its values come last in the struct
        self.first = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], *[F.col(c).alias(f"v{i}") for i, c in enumerate(values)])

    def lagged(self, units: DataFrame) -> DataFrame:
        return units.withColumns({"_prev": F.lag(self.ts).over(self.along), "_rn": F.row_number().over(self.along)})

    def starts(self, g: int) -> Column:
        """1 where a row with a time starts a session."""
        opens = F.col("_prev").isNull() | (whole_days("_prev", self.ts) > F.lit(g))
        return F.when(self.timeless, F.lit(0)).when(opens, F.lit(1)).otherwise(F.lit(0)).cast("bigint")

    def sums(self, mine: Column | None = None) -> Column:
        """Rollup of the rows for which ``mine`` holds: rows, earliest time, first row."""
        def of(x):
            return x if mine is None else F.when(mine, x)
        first = F.min(of(self.first))
        return F.struct(F.coalesce(F.sum(of(F.col("_mult"))), F.lit(0).cast("bigint")).alias("rows"),
                        F.min(of(F.col(self.ts))).alias("low"), *[first[f"v{i}"].alias(f"v{i}") for i in range(len(self.values))])

    def border(self, rows: DataFrame) -> DataFrame:
        """One row a piece of the hot keys: what the pieces before it leave, and the whole rollups of its first and
        last session (``_head``, ``_tail``; their numbers ``_hn``, ``_tn``)."""
        inner = {f"_s{g}": F.when(F.col("_rn") == 1, F.lit(0).cast("bigint")).otherwise(self.starts(g)) for g in self.gaps}
        rows = rows.withColumns(inner)
        rows = rows.withColumns({f"_c{g}": F.when(self.unkeyed, F.lit(0).cast("bigint")).otherwise(F.sum(f"_s{g}").over(self.upto)) for g in self.gaps})
        rows = rows.withColumns({f"_m{g}": F.max(f"_c{g}").over(self.whole) for g in self.gaps})
        aggs = [F.max(F.when(F.col("_rn") == 1, F.col(self.ts))).alias("_t0"), F.max(self.ts).alias("_t1"), F.sum("_mult").alias("_rows"),
                F.sum(F.when(self.timeless, F.col("_mult")).otherwise(F.lit(0).cast("bigint"))).alias("_nulls")]
        for g in self.gaps:
            aggs.append(F.sum(f"_s{g}").alias(f"_in{g}"))
            if self.rolled:
                aggs += [self.sums(F.col(f"_c{g}") == 0).alias(f"_head{g}"), self.sums(F.col(f"_c{g}") == F.col(f"_m{g}")).alias(f"_tail{g}")]
        # a row a piece from here on, key after key and piece after piece
        b = rows.groupBy(*self.keys, "_p").agg(*aggs).repartition(1)
        along = Window.partitionBy(*self.keys).orderBy("_p")
        b = b.withColumns({"_at": F.row_number().over(along), "_carry": F.lag("_t1").over(along)})
        b = b.withColumns({"_days": whole_days("_carry", "_t0"), "_unkeyed": self.unkeyed, "_bp": F.col("_p"),
                           "_bk": F.struct(*[F.col(k) for k in self.keys])}).drop(*self.keys, "_p")
        return _carried(b, self.gaps, self.rolled)

    def answered(self, rows: DataFrame, border: DataFrame | None) -> DataFrame:
        """Rows with previous time, key count ``_num``, session numbers ``_n<gap>`` and rollups ``_r<gap>``."""
        # every window over whole pieces in one step, every running sum in the next
        here = {"_nt": F.sum(F.when(self.timeless, F.col("_mult")).otherwise(F.lit(0).cast("bigint"))).over(self.whole), "_here": F.sum("_mult").over(self.whole)}
        if self.rolled:
            here["_low"] = F.min(self.ts).over(self.whole)
        rows = rows.withColumns(here)
        count = F.col("_here")
        if border is not None:
            mine = F.struct(*[F.col(k) for k in self.keys])
            rows = rows.join(F.broadcast(border), (mine == F.col("_bk")) & (F.col("_p") == F.col("_bp")), "left")
            rows = rows.withColumn("_prev", F.when((F.col("_rn") == 1) & F.col("_bp").isNotNull(), F.col("_carry")).otherwise(F.col("_prev")))
            rows, count = rows.withColumn("_nt", F.coalesce("_null", "_nt")), F.coalesce("_all", "_here")
        rows = rows.withColumns({"_num": count, **{f"_s{g}": self.starts(g) for g in self.gaps}})
        numbers = {}
        for g in self.gaps:
            base = F.lit(0).cast("bigint") if border is None else F.coalesce(f"_b{g}", F.lit(0).cast("bigint"))
            numbers[f"_n{g}"] = F.when(self.timeless, F.col("_nt")).otherwise(F.col("_nt") + base + F.sum(f"_s{g}").over(self.upto))
        if self.rolled:
            numbers["_before"] = F.sum("_mult").over(self.upto) - F.col("_mult")
        rows = rows.withColumns(numbers)
        if not self.rolled:
            return rows.drop("_here")
        rows = rows.withColumns({f"_g{g}": F.when(self.unkeyed, F.lit(-1).cast("bigint")).otherwise(F.col(f"_n{g}")) for g in self.gaps})
        fields = [f"v{i}" for i in range(len(self.values))]
        mine = F.struct("_before", F.col(self.ts).alias("low"), *[F.col(c).alias(v) for c, v in zip(self.values, fields)])
        ends = {}
        for g in self.gaps:
            opens = (F.col("_rn") == 1) | (~self.unkeyed & (F.col(f"_s{g}") == 1))
            ends[f"_o{g}"] = F.last(F.when(opens, mine), ignorenulls=True).over(self.upto)
            ends[f"_e{g}"] = F.last(F.when(opens, F.col("_before")), ignorenulls=True).over(self.beyond)
        rows = rows.withColumns(ends)
        for g in self.gaps:
            # a NULL key's rows are one session, whose first rows may have no time
            own = F.struct((F.coalesce(f"_e{g}", "_here") - F.col(f"_o{g}._before")).alias("rows"),
                           F.when(self.unkeyed, F.col("_low")).otherwise(F.col(f"_o{g}.low")).alias("low"), *[F.col(f"_o{g}.{v}").alias(v) for v in fields])
            if border is not None:
                own = (F.when(F.col("_bp").isNull(), own).when(F.col(f"_g{g}") == F.col(f"_hn{g}"), F.col(f"_head{g}"))
                       .when(F.col(f"_g{g}") == F.col(f"_tn{g}"), F.col(f"_tail{g}")).otherwise(own))
            rows = rows.withColumn(f"_r{g}", own)
        return rows.drop(*ends, "_before", "_here", "_low")


def _carried(b: DataFrame, gaps: Sequence[int], rolled: bool) -> DataFrame:
    """The border table from the facts of each piece (a row a piece, in order): the time before the piece, the key's
    NULL-time rows and rows, the sessions before the piece ``_b``, and the numbers of its first and last session
    (``_hn``, ``_tn``) with their rollups over all pieces that hold a part of them (``_head``, ``_tail``)."""
    got = b.toArrow()
    n = got.num_rows

    def column(name: str) -> pa.Array:
        return pa.concat_arrays(got.column(name).chunks) if n else pa.array([], got.column(name).type)

    def values(name: str) -> list:
        return column(name).to_pylist()

    at, days, unkeyed, nulls, rows = (values(c) for c in ("_at", "_days", "_unkeyed", "_nulls", "_rows"))
    timeless = [(x, y) for x, y in zip(column("_t0").is_null().to_pylist(), column("_t1").is_null().to_pylist())]
    first = [i for i in range(n) if at[i] == 1] + [n]
    out = {name: column(name) for name in ("_bk", "_bp", "_carry")}
    whole_key = [(sum(nulls[i:j]), sum(rows[i:j]), j - i) for i, j in zip(first, first[1:])]
    out["_null"] = pa.array([x for x, _, k in whole_key for _ in range(k)], pa.int64())
    out["_all"] = pa.array([x for _, x, k in whole_key for _ in range(k)], pa.int64())
    for g in gaps:
        inside, base, head, tail = values(f"_in{g}"), [], [], []
        for i in range(n):
            sessions = 0 if at[i] == 1 else sessions
            opens = int(not timeless[i][0] and (days[i] is None or days[i] > g))
            none = out["_null"][i].as_py()
            base.append(sessions)
            head.append(-1 if unkeyed[i] else none if timeless[i][0] else none + sessions + opens)
            tail.append(-1 if unkeyed[i] else none if timeless[i][1] else none + sessions + opens + inside[i])
            sessions += opens + inside[i]
        out[f"_b{g}"] = pa.array(base, pa.int64())
        if rolled:
            out |= {f"_hn{g}": pa.array(head, pa.int64()), f"_tn{g}": pa.array(tail, pa.int64())}
            out |= _joined(at, head, tail, column(f"_head{g}"), column(f"_tail{g}"), g)
    schema = StructType()
    for name in out:
        schema.add(name, b.schema[name].dataType if name in b.columns else LongType())
    return b.sparkSession.createDataFrame(pa.table(out), schema)


def _joined(at: list, head: list, tail: list, heads: pa.Array, tails: pa.Array, g: int) -> dict[str, pa.Array]:
    """Rollups of sessions over all pieces that hold a part of them: rows are added up, the other values are those of the
    first part, the earliest time that of the first part with a time."""
    parts, n = pa.concat_arrays([heads, tails]), len(at)
    sizes, lows = pc.struct_field(parts, "rows").to_pylist(), pc.struct_field(parts, "low")
    no_time = lows.is_null().to_pylist()
    session: dict = {}
    key, of = 0, []
    for i in range(n):
        key += at[i] == 1
        of.append(((key, head[i]), (key, tail[i])))
        for name, part in zip(of[i], (i, n + i) if head[i] != tail[i] else (i,)):
            total = session.setdefault(name, [0, part, part])
            total[0] += sizes[part]
            if no_time[total[2]]:
                total[2] = part
    out = {}
    for end, name in enumerate((f"_head{g}", f"_tail{g}")):
        total = [session[x[end]] for x in of]
        start = pa.array([t[1] for t in total], pa.int64())
        fields = [pa.array([t[0] for t in total], pa.int64()), lows.take(pa.array([t[2] for t in total], pa.int64()))]
        fields += [pc.struct_field(parts, i).take(start) for i in range(2, parts.type.num_fields)]
        out[name] = pa.StructArray.from_arrays(fields, names=[f.name for f in parts.type])
    return out


def session_table(df: DataFrame, key, ts: str, gap: int, *, tiebreak: Sequence[str] = (), tiebreak_unique: bool = False,
                  firsts: Mapping[str, str] | None = None, first_ts_name: str = "first_contact_date",
                  count_name: str = "num_contacts") -> DataFrame:
    """One row per (key, session): session_start, session_end (last contact plus the gap), earliest time, row
    count and first-row values. Rows of a NULL key are one session, as in :func:`sessionize`'s rollups.

    Sessions are numbered by :func:`sessionize` and their rows combined map-side, so a key with any share of the
    rows stays spread over tasks."""
    keys = _keys(key)
    cols = list(dict.fromkeys((firsts or {}).values()))
    rows = df.select(*dict.fromkeys([*keys, ts, *tiebreak, *cols]))
    numbered = sessionize(rows, key, ts, (gap,), tiebreak=tiebreak, tiebreak_unique=tiebreak_unique, count_name="_num",
                          number_fmt="_session", label_fmt=None, lag_name=None, diff_name=None)
    alone = F.lit(False)
    for k in keys:
        alone = alone | F.col(k).isNull()
    first = F.min(F.struct(F.col(ts).alias("t"), *[F.col(c).alias(f"b{i}") for i, c in enumerate(tiebreak)],
                           *[F.col(c).alias(f"v{i}") for i, c in enumerate(cols)]))
    out = numbered.groupBy(*keys, F.when(alone, F.lit(-1)).otherwise(F.col("_session")).alias("_s")).agg(
        F.min(ts).alias("session_start"), F.max(ts).alias("_last"), F.count(F.lit(1)).alias(count_name), first.alias("_first"))
    gap_length = F.expr(f"INTERVAL '{gap} 23:59:59.999999' DAY TO SECOND")
    return out.select(*keys, "session_start", (F.col("_last") + gap_length).alias("session_end"), F.col("session_start").alias(first_ts_name),
                      count_name, *[F.col("_first")[f"v{cols.index(c)}"].alias(n) for n, c in (firsts or {}).items()])
