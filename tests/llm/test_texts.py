"""Rules, classifiers, language, toxicity, licences: brute force, held-out accuracy, awkward rows."""

import numpy as np
import pandas as pd
import pyarrow as pa

from caretrail.llm import language_id, licenses, quality_classifier, quality_rules, toxicity
from caretrail.llm.common import text_arrays
from tests.llm.conftest import AWKWARD, SF, SMOKE


def auc(y, s):
    r = pd.Series(s).rank().to_numpy()
    n = y.sum()
    return (r[y == 1].sum() - n * (n + 1) / 2) / n / (len(y) - n)


def labelled(spark, out):
    return out.toPandas().merge(spark.read.parquet(f"{SF}/labels.parquet").toPandas(), on="doc_id")


def test_counts_equal_plain_pass(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + AWKWARD + ["a b c a b c", "x\nx\n\n x\ny", "\n\n", "A!? a\x0bb"]
    raw, offsets = text_arrays(pa.array(texts, pa.string()))
    rows = np.concatenate(list(quality_rules.counts(raw, offsets))).tolist()
    assert rows == [list(quality_rules.plain_counts(t)) for t in texts]


def test_rules_find_bad_documents(spark):
    out = labelled(spark, quality_rules.op2_quality_rules(spark, SF))
    assert (out.kept == (out.quality == 1))[~out.base_failed].mean() > 0.98


def test_variety_votes_at_every_length(spark):
    """A salad of 100 words gets a bad vote at any length; a long text that goes on to new words a good one."""
    rng = np.random.RandomState(6)
    salad = [f"w{i}" for i in rng.randint(0, 100, 5000)]
    fresh = [f"w{i}" for i in rng.randint(0, 3000, 40_000)]
    texts = [" ".join(salad[:n]) for n in (2000, 2001, 5000)] + [" ".join(fresh)]
    got = quality_rules.vote_quality(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.vote_variety for r in got} == {0: -1, 1: -1, 2: -1, 3: 1}


def test_em_on_planted_votes():
    rng = np.random.RandomState(0)
    good = rng.rand(5000) < 0.85
    votes = [tuple(np.where(rng.rand(3) < (0.005 if g else 0.6), -1, 1)) for g in good]
    patterns = pd.Series(votes).value_counts()
    prior, logs = quality_rules.fit([(k, int(v)) for k, v in patterns.items()])
    assert abs(prior - 0.85) < 0.03 and np.allclose(np.exp(logs[0, :, 0]), 0.6, atol=0.1)
    assert quality_rules.fit([])[0] == 0.5


def test_quality_held_out(spark):
    out = labelled(spark, quality_classifier.op5_quality_classifier(spark, SF))
    held = out[out.held_out]
    assert auc(held.quality.to_numpy(), held.score.to_numpy()) > 0.97 and (held.predicted == held.quality).mean() > 0.95


def test_quality_on_few_labels_of_one_class(spark):
    """sf0.001 has 87 labels, 11 of them of quality 0: the calibration still tells the classes apart."""
    out = quality_classifier.op5_quality_classifier(spark, SMOKE).toPandas().merge(spark.read.parquet(f"{SMOKE}/labels.parquet").toPandas(), on="doc_id")
    assert (out.predicted == out.quality).mean() > 0.9 and auc(out.quality.to_numpy(), out.score.to_numpy()) > 0.95
    assert (out[out.held_out].predicted == out[out.held_out].quality).mean() > 0.8


def test_dual_coordinate_descent_meets_optimality():
    rng = np.random.RandomState(1)
    rows = [np.sort(rng.choice(30, 8, replace=False)) for _ in range(80)]
    values = [np.ones(8) / np.sqrt(8) for _ in rows]
    y = np.where([r[0] < 3 for r in rows], 1.0, -1.0)
    w, b = quality_classifier.dual_coordinate_descent(rows, values, y, np.ones(80), 30, epochs=400)
    slack = np.array([max(0.0, 1 - yi * (v @ w[r] + b)) for r, v, yi in zip(rows, values, y)])
    gradient = w.copy()
    for r, v, yi, s in zip(rows, values, y, slack):
        gradient[r] -= 2 * s * yi * v
    assert np.abs(gradient).max() < 1e-3


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()[["doc_id", "lang"]]
    out = language_id.op10_language_id(spark, SF).toPandas().merge(docs, on="doc_id")
    held = out[out.held_out & out.lang.notna()]
    assert (held.lang == held.lang_pred).mean() > 0.97


def test_codewords():
    for n in (2, 4, 7, 20):
        code = language_id.codewords(n)
        assert len({tuple(c) for c in code}) == n
        assert min((a != b).sum() for i, a in enumerate(code) for b in code[:i]) >= max(1, code.shape[1] // 4)


def test_toxicity_held_out(spark):
    out = labelled(spark, toxicity.op4_toxicity(spark, SF))
    held = out[out.held_out]
    assert auc(held.toxic.to_numpy(), held.score.to_numpy()) > 0.85


def test_restoration():
    text = "you stupid idiot what a moron such a loser this is pathetic trash and worthless " * 200
    raw = np.frombuffer(text.encode(), np.uint8)
    batch = next(toxicity._trigrams(iter([pa.RecordBatch.from_arrays([pa.array([raw.tobytes().decode()])], ["t"])])))
    counts = np.zeros(toxicity.LETTERS ** 3, np.int64)
    counts[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    model = toxicity.CharModel(counts)
    for written, meant in (("1d10t", "idiot"), ("i.d.i.o.t", "idiot"), ("idiooooot", "idiot"), ("m0r0n", "moron"), ("$tup1d", "stupid"), ("l0s3r", "loser")):
        assert model.decode(written) == meant
    restore = toxicity.Restorer(model)
    plain = set(restore.part(np.frombuffer(b"an idiot", np.uint8), np.zeros(1, np.int64))[1].tolist())
    for written in (b"an i d i o t", b"an 1d10t!!", b"an IDIOT###"):
        assert plain & set(restore.part(np.frombuffer(written, np.uint8), np.zeros(1, np.int64))[1].tolist()) >= plain


def chars_of(text):
    batch = next(toxicity._trigrams(iter([pa.RecordBatch.from_arrays([pa.array([text])], ["t"])])))
    counts = np.zeros(toxicity.LETTERS ** 3, np.int64)
    counts[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return toxicity.CharModel(counts)


def test_spaced_runs_of_several_words():
    model = chars_of("you are a moron and you are an idiot such a loser this is so d\u00e9bile you know that a man can be " * 200)
    restore = toxicity.Restorer(model)
    features = lambda t: set(restore.part(np.frombuffer(t.encode(), np.uint8), np.zeros(1, np.int64))[1].tolist())
    for written, meant in (("you are a m o r o n", "moron"), ("y o u i d i o t", "idiot"), ("an i d i o t", "idiot"), ("d \u00e9 b i l e", "d\u00e9bile"),
                           ("D \u00c9 B I L E", "d\u00e9bile"), ("a l 0 $ e r", "loser")):
        assert features(meant) <= features(written), written
    assert model.decode("amoron", True) == "a moron" and model.decode("idiot", True) == "idiot"


def test_masked_words_are_decoded_in_full():
    """The decoder's path is as probable as the best of a search that keeps every state and text."""
    rng = np.random.RandomState(5)
    words = ["".join(rng.permutation(list("abcdefghijklmnopqrstuvwxyz"))[:rng.randint(3, 9)]) for _ in range(400)]
    model = chars_of(" ".join(words))
    log = model.log

    def best(token):
        states = {(0, 0): 0.0}
        for ch in token:
            new = {}
            for (a, b), s in states.items():
                moves = [(chr(97 + k), toxicity.BLOT) for k in range(26)] if ch == "*" else [(ch, 0.0)]
                if ch == "*":
                    new[a, b] = max(new.get((a, b), -1e9), s + toxicity.SEPARATOR)
                for x, cost in moves:
                    k = toxicity.code_of(x)
                    new[b, k] = max(new.get((b, k), -1e9), s + cost + float(log[a, b, k]))
            states = new
        return max(s + float(log[a, b, 0]) for (a, b), s in states.items())

    def fits(text, token):
        """The best score of any way to read the token as the text."""
        reach = {0: 0.0}
        for ch in token:
            new = {}
            for i, s in reach.items():
                if ch == "*":
                    new[i] = max(new.get(i, -1e9), s + toxicity.SEPARATOR)
                if i < len(text) and (ch == "*" or text[i] == ch):
                    codes = [0, 0, *map(toxicity.code_of, text)]
                    new[i + 1] = max(new.get(i + 1, -1e9), s + (toxicity.BLOT if ch == "*" else 0.0) + float(log[codes[i], codes[i + 1], codes[i + 2]]))
            reach = new
        codes = [0, 0, *map(toxicity.code_of, text)]
        return reach[len(text)] + float(log[codes[-2], codes[-1], 0])

    for word in words:
        token = word[0] + "**" + word[3:]
        assert abs(fits(model.decode(token), token) - best(token)) < 1e-3
    common = " ".join(f"a{x}zz" for x in "acdefghijklmnoprstuvwxyz") + " "
    assert chars_of(common * 50 + "aqb aqb").decode("a*b") == "aqb"  # after "a", q is the rarest letter but one


def test_licences_found(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = licenses.op1_license_scan(spark, SF).toPandas().merge(docs.toPandas(), on="doc_id")
    marks = {"apache": "Licensed under the Apache License, Version 2.0", "mit": "Released under the MIT License",
             "gpl": "GNU General Public License, version 3", "cc-by-nc": "CC BY-NC 4.0"}
    assert [list(f) for f in out.families] == [sorted(k for k, v in marks.items() if v.lower() in t.lower()) for t in out.text]


def test_repeated_rows_have_equal_licences(spark):
    """A row given one, two or three times is scored alike each time."""
    model = licenses.train(spark.read.parquet(f"{SMOKE}/documents.parquet"))
    lines = ["Released under the MIT License.", "It was released under license terms.", "Licensed under the Apache License, Version 2.0\nand more"]
    got = []
    for n in (1, 2, 3):
        rows = spark.createDataFrame([(i, t) for i, t in enumerate(lines)] * n, "doc_id bigint, text string")
        seen = {(r.doc_id, r.n_paragraphs, r.n_predicted, r.n_confirmed, tuple(r.families), round(r.score, 9)) for r in licenses.scan(rows, model).collect()}
        got.append(seen)
    assert len(got[0]) == 3 and got[0] == got[1] == got[2]


def test_licence_paragraphs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = licenses.train(docs)
    extra = spark.createDataFrame([(1, "x\nLicensed under the GNU Affero General Public License, version 3.\nHer license was renewed."), (2, None), (3, ""),
                                   (None, "Released under the MIT License."), (1, "Released under the MIT License.")], "doc_id bigint, text string")
    rows = {(r.doc_id, r.n_paragraphs): r for r in licenses.scan(extra, model).collect()}
    assert rows[1, 3].families == ["agpl", "mit"] == rows[1, 1].families and rows[2, 0].families == [] and rows[None, 1].families == ["mit"]


def test_several_licences_on_a_line(spark):
    """Every family of a line is found, and a notice doesn't count again for its relatives."""
    model = licenses.train(spark.read.parquet(f"{SF}/documents.parquet"))
    lines = {"Released under the MIT License. Licensed under the Apache License, Version 2.0.": ["apache", "mit"],
             "Released under the MIT License.": ["mit"], "Licensed under CC BY-SA 4.0.": ["cc-by-sa"], "Licensed under CC BY-NC 4.0.": ["cc-by-nc"],
             "Licensed under the GNU Affero General Public License, version 3.": ["agpl"],
             "This work is licensed under the GNU General Public License, version 3.": ["gpl"],
             "Her license was renewed at the public office.": []}
    rows = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in licenses.scan(rows, model).collect()}
    assert [got[i].families for i in range(len(lines))] == list(lines.values())
    assert (got[0].n_predicted, got[0].n_confirmed) == (1, 1)


def test_licence_threshold_covers_all_paragraphs(spark):
    """The threshold is the margin that all but 0.1 % of the paragraphs unlike a notice stay below, counted plainly."""
    rows = [(i, 0, f"the public office {i}", 2 if i < 3 else 1, [0.0, 0.0], float(i + 1)) for i in range(10)]
    rows.append((99, 0, "Released under the MIT License.", 5, [0.0, 0.0], 50.0))  # resembles a notice: says nothing
    scored = spark.createDataFrame(rows, "doc_id bigint, pos int, line string, copies bigint, z array<double>, margin double")
    empty = licenses.Model(["mit", "unknown"], None, [0.0, 0.0])
    plain = sorted((r[5] for r in rows[:-1] for _ in range(r[3])), reverse=True)
    for total in (1000, 4005, 12_505, 13_005, 10**6):
        allowed = int(0.001 * (total - 5))
        want = plain[allowed] if allowed < len(plain) else 0.0
        assert licenses.calibrated(empty, scored, total).threshold == want
    assert licenses.calibrated(empty, scored.limit(0), 0).threshold == 0.0


def test_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(3, 1, 0), (7, 1, 0), (10, 0, 1), (11, 0, 1), (11, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    n = awkward.count()
    assert quality_rules.vote_quality(awkward).where("n_words > 0 OR NOT kept").count() == n
    model = quality_classifier.train(awkward, labels)
    assert quality_classifier.score(awkward, model).where("score BETWEEN 0 AND 1").count() == n
    assert quality_classifier.good_quality(awkward, model).columns == awkward.columns
    tox = toxicity.train(awkward, labels)
    assert toxicity.score(awkward, tox).where("score BETWEEN 0 AND 1").count() == n
    lang = language_id.train(awkward)
    got = {r.doc_id: r for r in language_id.identify(awkward, lang).collect()}
    assert got[0].lang_pred == "und" and got[11].lang_pred == "und" and got[7].lang_pred == "en" and got[8].lang_pred == "en"
    assert language_id.known_language(awkward, lang).columns == awkward.columns
    for empty in (nothing,):
        assert quality_rules.vote_quality(empty).count() == 0
        assert quality_classifier.score(empty, quality_classifier.train(empty, labels.limit(0))).count() == 0
        assert toxicity.score(empty, toxicity.train(empty, labels.limit(0))).count() == 0
        assert language_id.identify(awkward, language_id.train(empty)).where("lang_pred = 'und'").count() == n
        assert licenses.scan(empty, licenses.train(awkward)).count() == 0
