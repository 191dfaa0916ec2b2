"""Tokenizer, packing, token files, chat formatting and the pipeline: round trips and brute force."""

import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from caretrail.llm import chat, packing, templates, token_files
from caretrail.llm.common import Stages, text_arrays
from caretrail.llm.elias_fano import EliasFano
from caretrail.llm.tokens import CorpusTokenizer
from tests.llm.conftest import SF, SMOKE

PATH = public_tokenizers.path("word_bpe_49k.json")


def library(texts):
    return [np.array([*e.ids, 2], "<u4") for e in Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_tokenizer_equals_the_library():
    rng = random.Random(3)
    parts = ["'s", "'", "''", "'re", "'LL", "don't", "É", "ß", "×", "÷", "ª", "²³", "12", "a1b", "!!", "<|endoftext|>", "x<|startoftext|>y", " ", "\n", "\x1c", "\x85",
             "\xa0", "ﬁ", "Σ", "日本", "é", "'veß", "µ", "º", "Å", "'S", "¿", "½", "İ", "ſ"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(5000)]
    raw, offsets = text_arrays(pa.array(texts))
    got = [ids[bounds[i]:bounds[i + 1]].tolist() for a, b, ids, bounds in CorpusTokenizer(PATH).encode(raw, offsets) for i in range(b - a)]
    assert got == [x[:-1].tolist() for x in library(texts)]


@pytest.mark.parametrize("n,top", [(0, 1), (1, 0), (1, 10 ** 12), (3000, 5), (3000, 10 ** 9), (70000, 10 ** 6)])
def test_elias_fano(n, top):
    rng = np.random.RandomState(n)
    v = np.sort(rng.randint(0, top + 1, n))
    e, _ = EliasFano.from_bytes(b"__" + EliasFano.encode(v).to_bytes(), 2)
    assert (e.slice(0, n) == v).all() and all(e[i] == v[i] for i in rng.randint(0, max(n, 1), 30) if n)
    if n > 1000:
        assert 8 * len(EliasFano.encode(v).to_bytes()) < n * (3 + max(0, np.log2(top / n)))


def test_token_files(spark, awkward, nothing):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").orderBy("doc_id").collect()
    start = 0
    for r, d, ids in zip(token_files.op8_token_files(spark, SMOKE).orderBy("doc_id").collect(), docs, library([d.text for d in docs])):
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d.doc_id, start, len(ids), zlib.crc32(ids))
        start += len(ids)
    for frame in (awkward, nothing):
        stages = Stages(spark, "test")
        manifest = stages.keep(token_files.write_token_files(frame, stages.path("files"), PATH), "manifest").collect()
        rows = token_files.read_token_files(spark, manifest).orderBy("start").collect()
        texts = sorted((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in frame.collect())
        assert [(r.doc_id, r.ids_crc32) for r in rows] == [(i if k else None, zlib.crc32(x)) for (k, i, _), x in zip(texts, library([t for _, _, t in texts]))]


def check_packing(rows, ids, capacity):
    for r in rows:
        assert zlib.crc32(ids[r.doc_id][r.start:r.start + r.length]) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(by) == set(range(len(by)))
    for parts in by.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0, *(n for _, n in parts)])[:-1].tolist() and sum(n for _, n in parts) <= capacity
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))


def test_packing(spark, awkward, nothing):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").collect()
    ids = dict(zip([d.doc_id for d in docs], library([d.text for d in docs])))
    check_packing(packing.op7_packing(spark, SMOKE).collect(), ids, 4096)
    frame = awkward.dropDuplicates(["doc_id"])
    ids = dict(zip([r.doc_id for r in frame.collect()], library([r.text for r in frame.collect()])))
    check_packing(packing.pack(frame, PATH, capacity=64).collect(), ids, 64)
    assert packing.pack(awkward, PATH).where("length > 0").count() >= awkward.count() and packing.pack(nothing, PATH).count() == 0


def test_shortest_pack_first():
    rng = np.random.RandomState(0)
    for _ in range(30):
        histogram = {int(k): int(rng.randint(1, 400)) for k in rng.randint(1, 101, 12)}
        patterns = packing.shortest_pack_first(histogram, 100)
        placed = {}
        for lengths, count in patterns:
            assert sum(lengths) <= 100
            for x in lengths:
                placed[x] = placed.get(x, 0) + count
        assert placed == histogram
        # one item at a time, each to the pack with the fewest tokens
        packs = []
        for x in sorted((x for x, n in histogram.items() for _ in range(n)), reverse=True):
            k = min(range(len(packs)), key=packs.__getitem__, default=None)
            if k is None or packs[k] + x > 100:
                packs.append(x)
            else:
                packs[k] += x
        assert abs(sum(c for _, c in patterns) - len(packs)) <= 1


def test_templates():
    run = lambda t, m=(), **c: "".join(x for x, _ in templates.compile_template(t, {"up": str.upper}, c)(list(m)) if x)
    assert run("a{{ 1 + 2 }}{{- 'x' | up }} {# no #}{% if false %}b{% elif 2 > 1 and not none %}c{% else %}d{% endif %}") == "a3X c"
    assert run("{% for m in messages %}{{ loop.index0 }}{{ m.t }}{% if loop.last %}.{% else %},{% endif %}{% endfor %}", [{"t": "p"}, {"t": "q"}]) == "0p,1q."
    assert run("{% set k = 'z' %}{{ k ~ b }}", b="y") == "zy" and run("{{ messages.__class__ }}{{ x.y }}{{ 'a'['b'] }}") == ""
    for bad in ("{% if x %}", "{{ f() }}", "{% import os %}", "{{ a | nope }}", "{{ a. }}"):
        with pytest.raises(templates.TemplateError):
            run(bad)
    closures = templates._Compiler({}, {"a": "1"}).fold(templates._parse(templates._chunks("x{{ a }}y{% if a == '1' %}z{% endif %}"), 0, ())[0], frozenset())
    assert closures == ["x1yz"]  # all folded


def test_escape_round_trip():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice(["<", "/", "s>", "</s>", "[INST]", "[/INST]", "\\", "a", "\n", "[", "INST]"]) for _ in range(rng.randint(0, 8)))
        assert chat.unescape(chat.escape(text)) == text and chat.unescape(chat.line(text)) == text
        assert not any(c in chat.escape(text) for c in chat.CONTROLS)


def test_chat(spark):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{SF}/conversations.parquet'")
    got = {tuple(r) for r in chat.op6_chat_formatting(spark, SF).collect()}
    assert got == {tuple(r) for r in con.execute(chat.ORACLE).fetchall()}
    rows = spark.createDataFrame([(1, None, None, None, 9), (1, 2, "assistant", "a\nb", 9), (1, 2, "a\\\nb", "[INST]", 9), (None, 1, "user", "", 9), (None, 1, "user", "", 9)],
                                 "conv_id bigint, turn bigint, role string, text string, part int")
    pieces = chat.format_conversations(rows).collect()
    turns = {k: list(chat.read_turns(p.text for p in sorted((p for p in pieces if p.conv_id == k), key=lambda p: p.part))) for k in (1, None)}
    assert turns == {1: [("", ""), ("a\\\nb", "[INST]"), ("assistant", "a\nb")], None: [("user", ""), ("user", "")]}
    assert chat.format_conversations(rows.limit(0)).count() == 0


def test_pipeline(spark):
    """Every stage keeps columns and drops only what its operator rejects; the last packs what is left."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = Stages(spark, "test")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stages.keep(stage(spark, before, SF), name)
        assert after.columns == docs.columns and after.exceptAll(before).count() == 0 and after.count() > 0
        before = after
    left = {r.doc_id: x for r, x in zip(before.collect(), library([r.text for r in before.collect()]))}
    check_packing(corpus_pipeline.run(spark, SF).collect(), left, 4096)


def test_pipeline_awkward(spark, awkward, nothing):
    for name, stage in corpus_pipeline.STAGES:
        for frame in (awkward, nothing):
            assert stage(spark, frame, SF).count() >= 0, name


def test_near_duplicate_stage_keeps_one_of_repeated_rows(spark):
    text, other = " ".join(f"w{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))
    rows = [(1, text, 7), (1, text, 7), (1, text, 8), (1, other, 9), (2, text, 7), (3, None, 1), (3, None, 1), (None, text, 7), (None, text, 7)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, extra int")
    got = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert got.columns == docs.columns
    want = sorted([(1, text), (1, other), (3, None), (None, text), (None, text)], key=str)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == want
    # columns of any name and type: names that the operators use inside, and maps, which neither compare nor hash
    clashing = docs.withColumns({"gone": F.col("extra"), "one": F.lit(1), "row": F.lit("r"), "id": F.lit(5), "place": F.lit(0), "node": F.lit("n"),
                                 "a b": F.create_map(F.lit("k"), F.col("extra")), "nothing": F.lit(None).cast("string")})
    got = corpus_pipeline.near_duplicates(spark, clashing, SF)
    assert got.columns == clashing.columns and sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == want
    assert {r.extra for r in got.where("text = '" + text + "' AND doc_id = 1").collect()} <= {7, 8}
