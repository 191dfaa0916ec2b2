"""What the driver holds while the pipeline's stages train and link."""

import tracemalloc

import numpy as np
import pyarrow as pa

from caretrail.llm import components, language_id, quality_classifier
from caretrail.llm.common import Stages


def peak(call) -> int:
    tracemalloc.start()
    try:
        call()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_language_sample_stays_narrow():
    rng = np.random.RandomState(3)
    texts = ["".join(rng.choice(list("abcdefghijklmnop" if i % 2 else "ijklmnopqrstuvwx"), 12_000)) for i in range(400)] + ["ab" * 40_000]
    batch = pa.RecordBatch.from_arrays([pa.array([str(i % 2) for i in range(401)]), pa.array(texts), pa.array(range(401))], ["lang", "text", "rank"])
    got = next(language_id._features(iter([batch])))
    rows = list(zip(got.column("lang").to_pylist(), got.column("ids").to_pylist(), got.column("counts").to_pylist()))
    buckets = [np.unique(language_id.grams(np.frombuffer(t.encode(), np.uint8)), return_counts=True) for t in texts]
    total = sum(len(u) for u, _ in buckets)
    assert sum(len(i) + len(c) for _, i, c in rows) < 3.1 * total
    for (_, ids, counts), (u, c) in zip(rows, buckets):  # nothing is lost, counts over 255 included
        assert (np.frombuffer(ids, language_id.BUCKET) == u).all()
        assert (np.frombuffer(counts, f"<u{len(counts) // len(u)}") == c).all()
    assert peak(lambda: language_id.fit(rows)) < 4 * total  # 8 bytes for every weight of the sample would be more


def test_quality_values_are_not_kept():
    rng = np.random.RandomState(4)
    rows = [(np.sort(rng.choice(60_000, 10_000, replace=False) + 30_000 * (i % 2)).astype("<u4").tobytes(), i % 2) for i in range(500)]
    models = []
    assert peak(lambda: models.append(quality_classifier.fit(rows, 0.5))) < 20e6  # 400 rows' values as float64 take 32 MB
    assert all((models[0].score(np.frombuffer(ids, "<u4")) > 0.5) == bool(v) for ids, v in rows)


def test_stars_take_no_round(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(components, "large_star", lambda e, f=components.large_star: calls.append(1) or f(e))
    stars = spark.createDataFrame([(5, 1), (1, 7), (7, 1), (9, 8), (9, 9), (None, 3)], "u bigint, v bigint")
    got = components.components(stars, Stages(spark, "test"), "stars")
    assert sorted(map(tuple, got.collect())) == [(1, 1), (5, 1), (7, 1), (8, 8), (9, 8)] and not calls
    # a node with two smaller neighbours, and one between two others, are not settled
    for edges in ([(5, 1), (5, 2)], [(5, 3), (3, 1)]):
        got = components.components(spark.createDataFrame(edges, "u bigint, v bigint"), Stages(spark, "test"), "open")
        assert {r.component for r in got.collect()} == {1} and got.count() == 3
    assert calls


def test_round_reads_its_edges_four_times(spark):
    edges = spark.createDataFrame([(2, 1), (3, 2)], "u bigint, v bigint")
    plan = components.small_star(components.large_star(edges))._jdf.queryExecution().optimizedPlan()
    assert plan.collectLeaves().size() == 4
