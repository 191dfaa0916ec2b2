"""Hard-negative mining over an exact multiway hyperplane tree (GNAT style).

Index. A node of the tree has up to `FAN` split points; a row goes to the nearest one, down to a leaf. Every split point
stores, for each subtree beside and below it, the range of its distances to all rows there, and every subtree the range of
its rows' norms. A window of scores [lo, hi] around an anchor is an annulus of distances (|a - x|^2 = |a|^2 + |x|^2 - 2 a.x):
by the triangle inequality a subtree holds no row of the window if, for one split point, its range of distances does
not meet the annulus moved by the anchor's distance to that point. Leaves that are left are searched in full, so the
result is exact. Split points come from a bounded sample of distinct rows; every row is indexed, and ranges cover all rows.

Search, in four rounds of one job each: an anchor's own leaf for positives; the other leaves that may hold a better one
than the last found; its own leaf for the windows of its positives; the other leaves that meet a window, narrowed by
what was found. Anchors and rows meet in packs: (leaf, block of rows) with (leaf, pack of anchors), one matrix product
each. A leaf with any share of the rows (equal vectors, say) is cut into cells by a hash of the id, then into blocks.

Defined results: rows with a null vec_id, label, vector or component, or a component that is not finite, take no part;
rows that agree in vec_id, label and vector count once; an anchor whose vec_id has several different rows is the
smallest by label, then vector, and its other rows are no rows of that search; vectors shorter than the longest are
filled with zeros; components beyond +-2^31 after scaling are set to that bound; extra columns are not read; an empty
table, or an anchor without positives, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caretrail.llm.common import Stages, table

SCALE = 256
FAN = 16
#: rows of a leaf (by the sample's estimate), of a cell and of a block
LEAF, CELL, BLOCK = 8192, 32768, 2048
#: anchors that are multiplied with a block at once
PACK = 256
#: rows and bytes of the sample that split points come from
SAMPLE, SAMPLE_BYTES = 20_000, 16 << 20
FAR = 1 << 62
ROUNDING = 1e-9


def _vectors(col: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(scaled int32 matrix, usable rows) of a list<double> column."""
    n = len(col)
    usable = np.asarray(col.is_valid())
    out = np.zeros((n, dim), np.int32)
    flat = col.flatten()
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64) if len(flat) else np.zeros(0)
    sizes = np.where(usable, np.asarray(col.value_lengths().fill_null(0)), 0)
    row = np.repeat(np.arange(n), sizes)
    at = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    finite = np.isfinite(values)
    usable[row[~finite]] = False
    with np.errstate(over="ignore"):
        scaled = np.floor(SCALE * values[finite])
    out[row[finite], at[finite]] = np.clip(scaled, -(1 << 31), (1 << 31) - 1).astype(np.int32)
    return out, usable


def _scaled(dim: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            q, usable = _vectors(batch.column(2), dim)
            keep = np.flatnonzero(usable)
            picked = batch.take(pa.array(keep))
            yield pa.RecordBatch.from_arrays([picked.column(0), picked.column(1), _binary(q[keep])], ["vec_id", "label", "vec"])
    return run


def _binary(rows: np.ndarray) -> pa.Array:
    """One binary value a row of a matrix."""
    n, width = len(rows), rows.shape[1] * rows.itemsize
    data = np.ascontiguousarray(rows).tobytes()
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(0, (n + 1) * width, max(width, 1), dtype=np.int32)[:n + 1].tobytes()), pa.py_buffer(data)])


def _matrix(values: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.int32).reshape(-1, dim)


def rows_of(embeddings: DataFrame) -> DataFrame:
    """vec_id, label and vector of the rows that may take part; every seventh label is moved on by one."""
    return embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"),
                             F.col("embedding").cast("array<double>").alias("embedding")).where(
        "vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))


def _square(a: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", a, a)


def _distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    d = _square(x)[:, None] + _square(p)[None, :] - 2.0 * (x @ p.T)
    return np.sqrt(np.maximum(d, 0.0))


class Tree:
    """Split points of the nodes; `kids[v][j]` is node k >= 0 or leaf ~k."""

    def __init__(self, sample: np.ndarray, rows: int) -> None:
        self.points: list[np.ndarray] = []
        self.kids: list[list[int]] = []
        #: estimated rows of each leaf, and the (node, child) steps that lead to it
        self.held: list[float] = []
        self.lines: list[list[tuple[int, int]]] = []
        share = rows / max(len(sample), 1)
        todo = [(np.arange(len(sample)), [])]
        while todo:
            own, line = todo.pop()
            fan = min(FAN, int(np.ceil(len(own) * share / LEAF)))
            chosen = self._spread(sample[own], fan) if fan > 1 and len(own) >= 4 * fan else own[:0]
            if line:
                self.kids[line[-1][0]][line[-1][1]] = ~len(self.held) if len(chosen) < 2 else len(self.points)
            if len(chosen) < 2:
                self.held.append(len(own) * share)
                self.lines.append(line)
                continue
            points = sample[own[chosen]].astype(np.float64)
            near = _distances(sample[own].astype(np.float64), points).argmin(1)
            self.points.append(points)
            self.kids.append([0] * len(points))
            todo += [(own[near == j], [*line, (len(self.points) - 1, j)]) for j in range(len(points))]

    @staticmethod
    def _spread(rows: np.ndarray, fan: int) -> np.ndarray:
        """Up to `fan` rows far from each other, out of evenly spaced candidates: each the farthest from those chosen."""
        cand = np.linspace(0, len(rows) - 1, min(len(rows), 3 * fan)).astype(int)
        x = rows[cand].astype(np.float64)
        chosen, far = [0], _distances(x, x[:1])[:, 0]
        while len(chosen) < fan and far.max() > 0:
            chosen.append(int(far.argmax()))
            far = np.minimum(far, _distances(x, x[chosen[-1:]])[:, 0])
        return cand[chosen]

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int32)
        todo = [(0, np.arange(len(x)))] if self.points else []
        while todo:
            v, own = todo.pop()
            near = _distances(x[own], self.points[v]).argmin(1)
            for j, k in enumerate(self.kids[v]):
                mine = own[near == j]
                if k < 0:
                    out[mine] = ~k
                elif len(mine):
                    todo.append((k, mine))
        return out


def _assigned(tree: Tree, dim: int):
    """Rows with their leaf and cell; repeats inside a batch go."""
    cells = np.maximum(1, np.ceil(np.array(tree.held) / CELL)).astype(np.int64)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ids, labels, vecs = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_pylist()
            if len(np.unique(ids)) < len(ids):
                first = np.array(sorted({k: i for i, k in reversed(list(enumerate(zip(ids.tolist(), labels.tolist(), vecs))))}.values()), int)
                ids, labels, vecs = ids[first], labels[first], [vecs[i] for i in first]
            q = _matrix(vecs, dim)
            leaf = tree.leaf_of(q.astype(np.float64))
            mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            cell = (mixed.astype(np.int64) % cells[leaf]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(leaf), pa.array(cell), pa.array(ids), pa.array(labels), pa.array(vecs, pa.binary())],
                                             ["leaf", "cell", "vec_id", "label", "vec"])
    return run


BLOCK_COLUMNS = "block bigint, leaf int, ids binary, labels binary, vecs binary, low array<double>, high array<double>"


def _blocks(tree: Tree, dim: int, most: int):
    """Sorted rows of a cell packed into blocks, with the ranges of their distances to the split points on their way
    from the root, and of their norms (last)."""
    schema = pa.schema([("block", pa.int64()), ("leaf", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("vecs", pa.binary()),
                        ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64()))])

    def block(key: tuple, seq: int, rows: list[tuple]) -> pa.RecordBatch:
        q = _matrix([r[2] for r in rows], dim).astype(np.float64)
        low, high = [], []
        for v, _ in tree.lines[key[0]]:
            d = _distances(q, tree.points[v])
            low += d.min(0).tolist()
            high += d.max(0).tolist()
        norm = np.sqrt(_square(q))
        values = [(key[0] << 42) | (key[1] << 21) | seq, key[0], np.array([r[0] for r in rows], np.int64).tobytes(),
                  np.array([r[1] for r in rows], np.int64).tobytes(), b"".join(r[2] for r in rows), [*low, norm.min()], [*high, norm.max()]]
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(values, schema)], schema=schema)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, seq, rows, last = None, 0, [], None
        for batch in it:
            for leaf, cell, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if key != (leaf, cell):
                    if rows:
                        yield block(key, seq, rows)
                    key, seq, rows, last = (leaf, cell), 0, [], None
                if row == last:
                    continue
                last = row
                rows.append(row)
                if len(rows) == most:
                    yield block(key, seq, rows)
                    seq, rows = seq + 1, []
        if rows:
            yield block(key, seq, rows)
    return run


class Ranges:
    """For every node: the lowest and highest distance of each split point to each child's rows, and the norms of each
    child's rows."""

    def __init__(self, tree: Tree, leaves: dict[int, dict[int, tuple[float, float]]]) -> None:
        none = lambda shape: (np.full(shape, np.inf), np.full(shape, -np.inf))
        self.low, self.high = zip(*(none((len(p), len(p))) for p in tree.points)) if tree.points else ((), ())
        self.short, self.long = zip(*(none(len(p)) for p in tree.points)) if tree.points else ((), ())
        for leaf, seen in leaves.items():
            a, b = np.array([seen[i] for i in range(len(seen))]).T
            at = 0
            for v, j in tree.lines[leaf]:
                n = len(tree.points[v])
                np.minimum(self.low[v][:, j], a[at:at + n], out=self.low[v][:, j])
                np.maximum(self.high[v][:, j], b[at:at + n], out=self.high[v][:, j])
                self.short[v][j], self.long[v][j] = min(self.short[v][j], a[-1]), max(self.long[v][j], b[-1])
                at += n


def _meets(near: np.ndarray, far: np.ndarray, square: np.ndarray, short: np.ndarray, long: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Which (anchor, subtree) may hold a row of one of the anchor's windows: distances of rows lie in [near, far], norms in
    [short, long]; lo and hi are (anchor, window) scores."""
    least, most = square[:, None] + short[None, :] ** 2, square[:, None] + long[None, :] ** 2
    out = np.zeros(near.shape, bool)
    slack = ROUNDING * (most + 1.0)
    for w in range(lo.shape[1]):
        outer, inner = most - 2.0 * lo[:, w, None], least - 2.0 * hi[:, w, None]
        out |= (lo[:, w] <= hi[:, w])[:, None] & (near ** 2 <= outer + slack) & (far ** 2 >= inner - slack)
    return out


def _between(d: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of |a - x| from d = |a - p_i| and the ranges of |p_i - x| ((i, subtree)), for each (anchor, subtree)."""
    near = np.maximum(0.0, np.maximum(d[:, :, None] - high[None], low[None] - d[:, :, None])).max(1)
    return near, (d[:, :, None] + high[None]).min(1)


def _leaves_met(tree: Tree, ranges: Ranges, x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, anchors that must search it)."""
    square = _square(x)
    todo = [(0, np.arange(len(x)))] if tree.points else []
    if not tree.points:
        yield 0, np.arange(len(x))
    while todo:
        v, own = todo.pop()
        near, far = _between(_distances(x[own], tree.points[v]), ranges.low[v], ranges.high[v])
        meets = _meets(near, far, square[own], ranges.short[v], ranges.long[v], lo[own], hi[own])
        for j, k in enumerate(tree.kids[v]):
            mine = own[meets[:, j]]
            if len(mine):
                if k < 0:
                    yield ~k, mine
                else:
                    todo.append((k, mine))


PACK_COLUMNS = "leaf int, anchors binary, own_labels binary, own_vecs binary, windows binary"


def _packs(tree: Tree, ranges: Ranges, dim: int, width: int, own_leaf: bool):
    """Packs of anchors for the leaves they search: their own one, or all others that meet a window. A window is four
    longs: positive_id, positive_score, lo, hi (lo > hi: none); each anchor has room for `width`."""
    names = ["leaf", "anchors", "own_labels", "own_vecs", "windows"]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ids, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            q = _matrix(batch.column(2).to_pylist(), dim)
            x, leaf = q.astype(np.float64), batch.column(3).to_numpy()
            wins = np.zeros((len(ids), width, 4), np.int64)
            wins[:, :, 2] = 1
            for i, mine in enumerate(batch.column(4).to_pylist()):
                for w, one in enumerate(mine):
                    wins[i, w] = (one["positive_id"], one["positive_score"], one["lo"], one["hi"])
            if own_leaf:
                met = ((int(k), np.flatnonzero(leaf == k)) for k in np.unique(leaf))
            else:
                met = ((k, mine[leaf[mine] != k]) for k, mine in _leaves_met(tree, ranges, x, wins[:, :, 2].astype(np.float64), wins[:, :, 3].astype(np.float64)))
            for k, mine in met:
                for i in range(0, len(mine), PACK):
                    part = mine[i:i + PACK]
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), *(pa.array([y[part].tobytes()], pa.binary()) for y in (ids, labels, q, wins))], names)
    return run


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of int32 rows; results are held to the range of a long."""
    most = float(np.abs(a.astype(np.int64)).max(initial=0)) * float(np.abs(b.astype(np.int64)).max(initial=0)) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -FAR, FAR).astype(np.int64)


FOUND = "anchor_id bigint, positive_id bigint, positive_score bigint, found_id bigint, score bigint"


def _searched(tree: Tree, dim: int, width: int, same_label: bool, most: int):
    """The best `most` rows of a block for every window of every anchor of a pack."""
    names = ["anchor_id", "positive_id", "positive_score", "found_id", "score"]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for row in batch.to_pylist():
                ids, labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
                anchors, own = np.frombuffer(row["anchors"], np.int64), np.frombuffer(row["own_labels"], np.int64)
                a = np.frombuffer(row["own_vecs"], np.int32).reshape(-1, dim)
                wins = np.frombuffer(row["windows"], np.int64).reshape(-1, width, 4)
                left = _left(tree, row, a, wins)
                if not len(left):
                    continue
                scores = _products(a[left], np.frombuffer(row["vecs"], np.int32).reshape(-1, dim))
                out: list[tuple] = []
                for k, s in zip(left, scores):
                    use = np.flatnonzero(((labels == own[k]) if same_label else (labels != own[k])) & (ids != anchors[k]))
                    use = use[np.lexsort((ids[use], -s[use]))]  # by score, then id
                    s = s[use]
                    for pid, pscore, lo, hi in wins[k].tolist():
                        if lo > hi:
                            continue
                        begin = int(np.searchsorted(-s, -hi, "left"))
                        end = min(begin + most, int(np.searchsorted(-s, -lo, "right")))
                        out += [(int(anchors[k]), pid, pscore, int(ids[use[i]]), int(s[i])) for i in range(begin, end)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)
    return run


def _left(tree: Tree, row: dict, a: np.ndarray, wins: np.ndarray) -> np.ndarray:
    """The anchors of a pack for which the block itself meets a window."""
    x, low, high = a.astype(np.float64), np.array(row["low"]), np.array(row["high"])
    near, far, at = np.zeros((len(x), 1)), np.full((len(x), 1), np.inf), 0
    for v, _ in tree.lines[row["leaf"]]:
        n = len(tree.points[v])
        here, there = _between(_distances(x, tree.points[v]), low[at:at + n, None], high[at:at + n, None])
        near, far, at = np.maximum(near, here), np.minimum(far, there), at + n
    return np.flatnonzero(_meets(near, far, _square(x), low[-1:], high[-1:], wins[:, :, 2].astype(float), wins[:, :, 3].astype(float))[:, 0])


def _best(found: DataFrame, most: int) -> DataFrame:
    """The first `most` rows of every window."""
    order = Window.partitionBy("anchor_id", "positive_id", "positive_score").orderBy(F.col("score").desc(), "found_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


class Index:
    """The tree over all rows, its blocks in a stage table, and the anchors."""

    def __init__(self, rows: DataFrame, stages: Stages, anchors: str = "vec_id % 100 = 0") -> None:
        self.stages = stages
        n, dim = rows.agg(F.count("*"), F.max(F.size("embedding"))).first()
        self.dim = dim = max(1, dim or 1)
        bound = max(256, min(SAMPLE, SAMPLE_BYTES // (4 * dim)))
        scaled = lambda df: df.select("vec_id", "label", "embedding").mapInArrow(_scaled(dim), "vec_id bigint, label bigint, vec binary")
        rate = min(1.0, bound / max(n, 1))
        picked = rows.where(F.shiftrightunsigned(F.xxhash64("vec_id", "embedding"), 1) <= min(int(rate * (1 << 63)), (1 << 63) - 1))
        sample = sorted({bytes(r["vec"]) + int(r["vec_id"]).to_bytes(8, "big", signed=True) for r in scaled(picked).select("vec_id", "vec").distinct().collect()})
        self.tree = tree = Tree(_matrix([s[:-8] for s in sample], dim), n)
        most = max(64, min(BLOCK, (2 << 20) // (4 * dim)))
        placed = scaled(rows).mapInArrow(_assigned(tree, dim), "leaf int, cell int, vec_id bigint, label bigint, vec binary")
        dealt = placed.repartition("leaf", "cell").sortWithinPartitions("leaf", "cell", "vec_id", "label", "vec")
        self.blocks = stages.keep(dealt.mapInArrow(_blocks(tree, dim, most), BLOCK_COLUMNS), "blocks")
        first = scaled(rows.where(anchors)).mapInArrow(_assigned(tree, dim), "leaf int, cell int, vec_id bigint, label bigint, vec binary")
        first = first.groupBy("vec_id").agg(F.min(F.struct("label", "vec", "leaf")).alias("r")).select(F.col("vec_id").alias("anchor_id"), "r.*")
        self.anchors = stages.keep(first.repartition("leaf").sortWithinPartitions("leaf", "anchor_id"), "anchors")
        seen = (self.blocks.select("leaf", F.posexplode(F.arrays_zip("low", "high")).alias("i", "r"))
                .groupBy("leaf", "i").agg(F.min("r.low"), F.max("r.high")).collect())  # at most a tree's leaves times its depth
        leaves: dict[int, dict[int, tuple[float, float]]] = {}
        for leaf, i, low, high in seen:
            leaves.setdefault(leaf, {})[i] = (low, high)
        self.ranges = Ranges(tree, leaves)

    def search(self, queries: DataFrame, name: str, *, width: int, own_leaf: bool, same_label: bool, most: int) -> DataFrame:
        """Per window the best rows out of the searched leaves. `queries`: the anchors with up to `width` windows."""
        packs = (queries.select("anchor_id", "label", "vec", "leaf", "windows")
                 .mapInArrow(_packs(self.tree, self.ranges, self.dim, width, own_leaf), PACK_COLUMNS))
        # blocks of a leaf first, without their rows: a pack then meets one block a key
        at = packs.join(self.blocks.select(F.col("leaf").alias("_leaf"), "block"), F.col("leaf") == F.col("_leaf")).drop("leaf", "_leaf")
        found = at.join(self.blocks, "block").mapInArrow(_searched(self.tree, self.dim, width, same_label, most), FOUND)
        return self.stages.keep(_best(found, most), name)


def mine(embeddings: DataFrame, positives: int = 5, negatives: int = 10, low: tuple[int, int] = (3, 10), high: tuple[int, int] = (9, 10)) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. Negatives of a positive with score p have
    scores from p * low to p * high (fractions)."""
    stages = Stages(embeddings.sparkSession, "negatives")
    index = Index(rows_of(embeddings), stages)
    window = lambda pid, score, lo, hi: F.struct(pid.cast("bigint").alias("positive_id"), score.cast("bigint").alias("positive_score"),
                                                 lo.cast("bigint").alias("lo"), hi.cast("bigint").alias("hi"))
    nothing = F.lit(0)
    every = index.anchors.withColumn("windows", F.array(window(nothing, nothing, F.lit(-FAR), F.lit(FAR))))
    first = index.search(every, "positives-own", width=1, own_leaf=True, same_label=True, most=positives)
    last = first.where(F.col("rank") == positives).select("anchor_id", F.col("score").alias("least"))
    rest = index.anchors.join(last, "anchor_id", "left").withColumn(
        "windows", F.array(window(nothing, nothing, F.coalesce("least", F.lit(-FAR)), F.lit(FAR))))
    other = index.search(rest, "positives-rest", width=1, own_leaf=False, same_label=True, most=positives)
    chosen = stages.keep(_best(first.drop("rank").union(other.drop("rank")), positives)
                         .select("anchor_id", F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    score = F.col("positive_score")
    ranged = chosen.withColumn("lo", _ceil(score * low[0], low[1])).withColumn("hi", _floor(score * high[0], high[1]))
    asked = ranged.groupBy("anchor_id").agg(F.collect_list(window(F.col("positive_id"), score, F.col("lo"), F.col("hi"))).alias("windows"))
    first = index.search(index.anchors.join(asked, "anchor_id"), "negatives-own", width=positives, own_leaf=True, same_label=False, most=negatives)
    last = first.where(F.col("rank") == negatives).select("anchor_id", "positive_id", "positive_score", F.col("score").alias("least"))
    asked = (ranged.join(last, ["anchor_id", "positive_id", "positive_score"], "left").groupBy("anchor_id")
             .agg(F.collect_list(window(F.col("positive_id"), score, F.coalesce("least", "lo"), F.col("hi"))).alias("windows")))
    other = index.search(index.anchors.join(asked, "anchor_id"), "negatives-rest", width=positives, own_leaf=False, same_label=False, most=negatives)
    out = _best(first.drop("rank").union(other.drop("rank")), negatives)
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("found_id").alias("negative_id"),
                      "positive_score", F.col("score").alias("negative_score"))


def _floor(x, by: int):
    """Whole-number x / by, rounded down."""
    return F.call_function("div", x - F.pmod(x, F.lit(by).cast("bigint")), F.lit(by).cast("bigint"))


def _ceil(x, by: int):
    return -_floor(-x, by)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x : floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x : x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, o.vec_id AS other_id, a.label = o.label AS same, list_inner_product(a.q, o.q)::BIGINT AS score
      FROM v a JOIN v o ON a.vec_id <> o.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
             other_id AS negative_id, positive_score, score AS negative_score
      FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT * FROM n WHERE rank <= 10
"""
