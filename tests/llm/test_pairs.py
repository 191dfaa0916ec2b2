"""Near duplicates, components and decontamination against brute force and SQL."""

import random

import duckdb
import numpy as np

from caretrail.llm import decontamination, near_dedup
from caretrail.llm.common import Stages
from caretrail.llm.components import components
from tests.llm.conftest import SF
from tests.helpers import bag


def sets(texts):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split() if (t or "").isascii() else [x.encode() for x in (t or "").split(" ")]
        out.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def groups(ids, links):
    low = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return low


def chain_texts(seed=1, n=120):
    """Copies, near copies at every similarity around the threshold, and chains of them."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    out = []
    while len(out) < n:
        base = [rng.choice(words) for _ in range(rng.choice([3, 5, 9, 40, 120, 400]))]
        for _ in range(rng.randint(1, 6)):
            out.append(" ".join(base))
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                base[rng.randrange(len(base))] = rng.choice(words)
    return out[:n]


def test_near_duplicates_equal_brute_force(spark):
    texts = chain_texts()
    s = sets(texts)
    links = [(a, b) for a in range(len(s)) for b in range(a) if s[a] and s[b] and 100 * len(s[a] & s[b]) >= 75 * len(s[a] | s[b])]
    low = groups(range(len(s)), links)
    got = {r.doc_id: r for r in near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    assert {i: r.component_id for i, r in got.items()} == low
    assert all(got[i].n_shingles == len(s[i]) and got[i].kept == (low[i] == i) for i in got)


def test_parity_sketch_never_rules_out_a_link():
    """Sketches differ in no more bits than the sets have unshared elements, and in as many when these are few."""
    rng = np.random.RandomState(3)
    for n, apart in ((1, 0), (5, 2), (150, 10), (150, 60), (4000, 900), (20000, 9000)):
        x = rng.randint(0, 1 << 62, n).astype(np.uint64)
        y = np.unique(np.concatenate((x[apart // 2:], rng.randint(0, 1 << 62, apart - apart // 2).astype(np.uint64))))
        x = np.unique(x)
        bits = int(np.bitwise_count((near_dedup.parity(x) ^ near_dedup.parity(y)).view(np.uint64)).sum())
        unshared = len(np.setxor1d(x, y))
        assert bits <= unshared and bits % 2 == unshared % 2 and (apart > 60 or bits >= 0.75 * unshared)


def test_links_beyond_the_pivot(spark, monkeypatch):
    """Buckets with several components are paired across them, also when they are split further."""
    monkeypatch.setattr(near_dedup, "HOT", 0)
    texts = chain_texts(seed=2, n=60)
    s = sets(texts)
    low = groups(range(len(s)), [(a, b) for a in range(len(s)) for b in range(a) if s[a] and 100 * len(s[a] & s[b]) >= 75 * len(s[a] | s[b])])
    got = near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == low


def test_hot_buckets_are_searched_whole(spark, monkeypatch):
    """Texts around one core share buckets of hundreds, at 0.6; each is linked (0.766) with one other, seldom a pivot."""
    monkeypatch.setattr(near_dedup, "HOT", 16)
    monkeypatch.setattr(near_dedup, "BLOCK", 64, raising=False)
    rng = random.Random(4)
    fresh = iter(f"w{i}" for i in rng.sample(range(1 << 20), 200_000))
    some = lambda n: [next(fresh) for _ in range(n)]
    core, texts = some(151), []
    for _ in range(1000):
        both = core + some(23)
        texts += [" ".join(both + some(26)) for _ in range(2)]
    got = near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i - i % 2 for i in range(len(texts))}


def test_near_duplicates_awkward(spark, awkward, nothing):
    rows = near_dedup.near_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        if r.doc_id in (0, 1, 2):
            assert r.n_shingles == 0 and r.kept and r.component_id == r.doc_id
    assert near_dedup.near_duplicates(nothing).count() == 0


def test_components(spark):
    rng = np.random.RandomState(0)
    edges = [(i, i + 1) for i in range(40)] + [(100 + int(a), 100 + int(b)) for a, b in rng.randint(0, 80, (60, 2))] + [(5, 5)]
    low = groups({x for e in edges for x in e}, edges)
    got = components(spark.createDataFrame(edges, "u bigint, v bigint"), Stages(spark, "test"), "cc")
    have = {r.node: r.component for r in got.collect()}
    assert have == {k: v for k, v in low.items() if k in have} and all(low[k] == k for k in low if k not in have)
    assert components(spark.createDataFrame([], "u bigint, v bigint"), Stages(spark, "test"), "none").count() == 0


def test_leaks_equal_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = {tuple(r) for r in decontamination.op9_decontamination(spark, SF).collect()}
    assert got and got == {tuple(r) for r in con.execute(decontamination.ORACLE).fetchall()}


def test_leaks_in_blocks(spark, monkeypatch):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = bag(decontamination.leaks(docs, bench))
    monkeypatch.setattr(decontamination, "BLOCK", 100)
    assert bag(decontamination.leaks(docs, bench)) == whole
    left = decontamination.without_leaks(docs, bench)
    assert left.columns == docs.columns and left.count() == docs.count() - len({k[0] for k in bag(decontamination.leaks(docs, bench), ["doc_id"])})


def test_leaks_awkward(spark, awkward, nothing):
    bench = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (2, None), (3, ""), (None, "over the lazy dog the quick brown fox")], "item_id bigint, text string")
    got = decontamination.leaks(awkward, bench).collect()
    assert sorted((str(r.doc_id), str(r.item_id)) for r in got) == sorted([("None", "1"), ("5", "1"), ("5", "1"), ("10", "None")])
    assert decontamination.leaks(nothing, bench).count() == 0 and decontamination.leaks(awkward, bench.limit(0)).count() == 0
    assert decontamination.without_leaks(awkward, bench).count() == awkward.count() - 4
