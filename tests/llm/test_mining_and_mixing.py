"""Prefix trie, hard negatives and source mixing against brute force, with awkward rows."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from caretrail.llm import hard_negatives, mixing, prefix_trie
from tests.helpers import bag

TURNS = "conv_id bigint, turn bigint, role string, text string, path string, skel int, node double"


def conversations(seed=3, n=140):
    """Conversations that share openings, with copies, null and tied turns, null roles and texts, and one long one."""
    rng = random.Random(seed)
    rows = []
    for c in [*range(n), -7, -20, 10 ** 12, 10 ** 12 + 1]:
        for t in range(rng.choice([1, 1, 2, 3, 4, 6])):
            rows.append((c, rng.choice([t, t, None, 0]), rng.choice(["user", "assistant", None]), rng.choice(["a b", "c", "", None, "d  e\tf", "日本 x"])))
    rows += [(c, t, "user", "same thing here") for c in range(300, 360) for t in range(3)]
    rows += [(777, t, "user", f"w{t}") for t in range(900)] + [(778, t, "user", f"w{t}") for t in range(900)]
    rows += [(None, 0, "user", "gone"), rows[0], rows[0]]
    return rows


def trie_of(rows):
    """The contract, taken literally."""
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append(((t is not None, t or 0), role or "", text or ""))
    for c in own:
        own[c] = [(r, x) for _, r, x in sorted(own[c], key=lambda r: (r[0], r[1].encode(), r[2].encode()))]
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, m in members.items():
        words = len(node[-1][1].replace("\t", " ").split()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += kids[node] == 0
            saved[node[:d]] += (len(m) - 1) * words
    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(node))
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), kids[node], leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("shards", [1, 9, 60])
def test_trie_equals_brute_force(spark, shards, monkeypatch):
    monkeypatch.setattr(prefix_trie, "ENDS", 100)  # ids of the copies leave in several blocks
    rows = conversations()
    df = spark.createDataFrame([(*r, "x", 1, 0.5) for r in rows], TURNS).repartition(3)
    got = prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.paths(df)), shards)
    assert bag(got, list(prefix_trie.RESULT)) == trie_of(rows)


def test_trie_bounds_its_splitters(spark, monkeypatch):
    """Fewer splitters when their paths are long; the nodes stay the same."""
    rows = conversations(5)
    df = spark.createDataFrame([(*r, "x", 1, 0.5) for r in rows], TURNS)
    convs = prefix_trie.rebuilt(prefix_trie.paths(df)).persist()
    monkeypatch.setattr(prefix_trie, "TRIE_BYTES", 400)
    cuts = prefix_trie.splitters(convs, 50)
    assert 0 < sum(len(p) for p, _ in cuts) <= 400
    assert bag(prefix_trie.trie(convs, 50), list(prefix_trie.RESULT)) == trie_of(rows)


def test_trie_of_nothing(spark):
    assert prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.paths(spark.createDataFrame([], TURNS)))).count() == 0
    nulls = spark.createDataFrame([(None, 1, "user", "x", None, None, None)], TURNS)
    assert prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.paths(nulls))).count() == 0
    long = spark.createDataFrame([(21, 0, "user", "w " * 500_000, None, None, None), (22, 0, "user", "w " * 500_000, None, None, None)], TURNS)
    top = prefix_trie.trie(prefix_trie.paths(long)).where("depth = 0").collect()
    assert [r.saved_tokens for r in top] == [500_000]


VECTORS = "vec_id bigint, embedding array<float>, label int, leaf int, block bigint, score double"


def vectors(seed=1, n=900, dim=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(7, dim))
    rows = [(i, (centres[i % 7] + 0.3 * rng.normal(size=dim)).astype(np.float32).tolist(), int(rng.integers(0, 4))) for i in range(n)]
    rows += [(2000 + i, rows[3][1], int(rng.integers(0, 4))) for i in range(400)]  # one very common vector
    rows += [rows[5], rows[100], rows[100]]  # repeated rows, an anchor among them
    rows += [(3000, None, 1), (3001, [float("nan")] * dim, 1), (3002, [float("inf")] + [0.0] * (dim - 1), 1), (3003, [None] + [0.0] * (dim - 1), 1),
             (3004, [0.5] * dim, None), (None, [0.5] * dim, 1), (3100, [], 1), (3105, [1.0], 2), (3200, [0.0] * dim, 77), (3300, [3.0e4] * dim, 3)]
    return rows


def negatives_of(rows):
    usable = {}
    dim = max(len(v) for _, v, _ in rows if v is not None)
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * float(np.float32(x))) for x in v] + [0] * (dim - len(v))
        usable[i] = ((label + 1) % 10 if i % 7 == 0 else label, np.array(q, object))
    ids = sorted(usable)
    out = []
    for a in (i for i in ids if i % 100 == 0):
        label, q = usable[a]
        scored = sorted((-int(usable[i][1].dot(q)), i) for i in ids if i != a)
        for p, pid in [x for x in scored if usable[x[1]][0] == label][:5]:
            fit = [(-s, i) for s, i in scored if usable[i][0] != label and 30 * -p <= 100 * -s <= 90 * -p]
            out += [(a, pid, k + 1, i, -p, s) for k, (s, i) in enumerate(fit[:10])]
    return Counter(out)


@pytest.mark.parametrize("leaf", [8192, 100, 12])
def test_negatives_equal_brute_force(spark, leaf, monkeypatch):
    for name, value in (("LEAF", leaf), ("CELL", 90), ("BLOCK", 64), ("PACK", 5)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = vectors()
    df = spark.createDataFrame([(*r, 1, 2, 0.5) for r in rows], VECTORS).repartition(3)
    got = hard_negatives.mine(df)
    assert bag(got, ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]) == negatives_of(rows)


def test_tree_prunes_and_never_loses(monkeypatch):
    """Every row within a window lies in a leaf that the anchor searches, and far leaves are left out."""
    monkeypatch.setattr(hard_negatives, "LEAF", 40)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 8)) * 300
    x = np.floor(np.concatenate([c + 20 * rng.normal(size=(60, 8)) for c in centres])).astype(np.int32)
    tree = hard_negatives.Tree(x[::3], len(x))
    leaf = tree.leaf_of(x.astype(float))
    seen = {}
    for k in set(leaf.tolist()):
        part = x[leaf == k].astype(float)
        d = [hard_negatives._distances(part, tree.points[v]) for v, _ in tree.lines[k]]
        low, high = [m for y in d for m in y.min(0)], [m for y in d for m in y.max(0)]
        norm = np.sqrt((part ** 2).sum(1))
        seen[k] = dict(enumerate(zip([*low, norm.min()], [*high, norm.max()])))
    ranges = hard_negatives.Ranges(tree, seen)
    anchors = x[::50].astype(float)
    scores = anchors @ x.T.astype(float)
    lo = np.sort(scores, 1)[:, -20:-19]
    met = {(k, a) for k, mine in hard_negatives._leaves_met(tree, ranges, anchors, lo, np.full_like(lo, 1e18)) for a in mine.tolist()}
    assert all((leaf[j], a) in met for a, j in zip(*np.nonzero(scores >= lo)))
    assert len(met) < 0.6 * len(anchors) * len(seen)


def test_negatives_of_nothing(spark):
    for rows in ([], [(None, None, None, None, None, None)], [(100, [1.0], 1, 0, 0, 0.0)]):
        assert hard_negatives.mine(spark.createDataFrame(rows, VECTORS)).count() == 0


DOCS = "doc_id bigint, text string, source string, target double, finish double, pos int"


def documents(seed=2):
    rng = random.Random(seed)
    rows = [(i, "w " * rng.choice([0, 1, 5, 30, 200]), rng.choice(["a", "a", "a", "b", "ä", "B", "zz", None, "\U0001f600", "￮"])) for i in range(1500)]
    rows += [(None, "x y z", "a")] * 40 + [(7, "same words", "b")] * 300 + [(8, None, "only nulls"), (9, "", "empty"), (10, " \n\t ", "blank")]
    return rows + [(20, "q " * 60_000, "long")]


def targets_of(rows):
    """Water-filling with fractions, source by source."""
    size = Counter()
    for _, text, source in rows:
        size[source] += len((text or "").split())
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None] * (None in size)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, target, open_ = Fraction(sum(size.values()) * 3 // 2), {}, set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= 2 * size[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in full:
            target[s] = Fraction(2 * size[s])
            left -= target[s]
        open_ -= full
    return size, target


@pytest.mark.parametrize("few", [50_000, 0])
def test_mixture_meets_its_targets(spark, few, monkeypatch):
    for name, value in (("CELL", 40), ("BLOCK", 16), ("FEW_SOURCES", few)):
        monkeypatch.setattr(mixing, name, value)
    rows = documents()
    df = spark.createDataFrame([(*r, 0.5, 0.5, 1) for r in rows], DOCS).repartition(3)
    got = mixing.mix(df).collect()
    size, target = targets_of(rows)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, len((t or "").split())) for i, t, _ in rows)
    assert sum(r.taken for r in got) == sum(size.values()) * 3 // 2
    taken, cuts = Counter(), 0
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.source_size == size[r.source]
        assert r.target == pytest.approx(float(target[r.source]))
        cuts += r.size > 0 and r.taken % r.size > 0
        taken[r.source] += r.taken
    assert cuts <= len(size)  # documents are cut only where their source stops
    for s in size:
        assert abs(taken[s] - target[s]) <= 2 * mixing.PART
    again = mixing.mix(df.repartition(5)).collect()
    assert Counter((r.doc_id, r.size, r.taken) for r in got) == Counter((r.doc_id, r.size, r.taken) for r in again)


def test_mixture_serves_by_finish_time(spark):
    """Sizes of one: every source is served in proportion to its target, at every point of the order."""
    rows = [(i, "one", "ab"[i % 2]) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.mix(df, weights=(2, 1), budget=Fraction(1, 2)).collect()
    assert Counter(r.source for r in got if r.taken) == {"a": 300, "b": 150}
    assert all((r.finish <= 1) == (r.taken == 1) for r in got)


def test_mixture_of_nothing(spark):
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0
    empty = mixing.mix(spark.createDataFrame([(1, None, None, None, None, None), (2, " ", "a", None, None, None)], DOCS)).collect()
    assert [(r.size, r.taken, r.target) for r in empty] == [(0, 0, 0.0)] * 2
