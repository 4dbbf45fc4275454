"""Toxicity, languages and mixing: gradients, held-out accuracy, plain versions and cases."""

import os
import random
import sys

import numpy as np
import pytest
import pandas as pd
import pyarrow as pa

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_cases import empty, frame, prose, texts  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from skyframe.llm import langid  # noqa: E402
from skyframe.llm.langid import Classifier, Landmarks, grams, language_sample, languages  # noqa: E402
from skyframe.llm.mixing import calibrated, mix, rake, with_profile  # noqa: E402
from skyframe.llm.queries import QUERIES  # noqa: E402
from skyframe.llm.toxicity import WINDOW, Network, lexicon, toxicity, train, window_rows, windows, with_toxicity  # noqa: E402
from skyframe.llm.words import words  # noqa: E402


def test_gradients_equal_differences():
    net = Network()
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    w = words(pa.array([prose(1, 70), prose(2, 9), prose(3, 40)]))
    lex, (first, size, _) = lexicon(w), windows(w.offsets)
    rows, mask = window_rows(lex, first, size)
    y, weight = np.arange(len(first)) % 2, np.ones(len(first))

    def loss():
        logit = net.forward(rows, mask, net.project(net.features(lex)))[0]
        return np.log1p(np.exp(np.where(y == 1, -logit, logit))).mean()

    for k, g in net.gradient(lex, rows, mask, y, weight).items():
        at, step = np.unravel_index(np.abs(g).argmax(), g.shape), 1e-4
        net.p[k][at] += step
        up = loss()
        net.p[k][at] -= 2 * step
        down = loss()
        net.p[k][at] += step
        assert abs((up - down) / (2 * step) - g[at]) < 1e-3 * abs(g[at]) + 1e-7, k


def test_windows_overlap_and_cover_every_word():
    offsets = np.cumsum([0, 0, 1, WINDOW, WINDOW + 1, 100, 1000])
    first, size, text = windows(offsets)
    for t in range(len(offsets) - 1):
        spans = [(a, a + n) for a, n, x in zip(first, size, text) if x == t]
        assert sorted(set().union(*(range(a, b) for a, b in spans))) == list(range(offsets[t], offsets[t + 1]))
        assert all(b[0] < a[1] for a, b in zip(spans, spans[1:]))


def test_toxic_words_are_learnt_and_found_anywhere():
    r = random.Random(5)

    def text(seed, toxic):
        w = prose(seed, r.randint(20, 200)).split()
        for _ in range(3 if toxic else 0):
            w.insert(r.randrange(len(w) + 1), r.choice(["zzrotten", "zzfoul", "zzvile"]))
        return " ".join(w)

    labels = np.arange(600) % 2
    net = train([text(i, y) for i, y in enumerate(labels)], labels)

    def score(t):
        logit = net.logits(words(pa.array([t])))[0].max()
        return net.a * logit + net.b

    held = [(score(text(5000 + i, i % 2)), i % 2) for i in range(100)]
    assert np.mean([(s > 0) == y for s, y in held]) > 0.85
    assert score(prose(1, 5000) + " zzfoul zzvile " + prose(2, 3000)) > score(prose(1, 5000) + " " + prose(2, 3000))


def test_toxicity_cases(spark):
    docs = frame(spark)
    labels = spark.createDataFrame([(100 + i, i % 2, "e") for i in range(20)] + [(None, 1, "e"), (10, None, "e"), (100, 0, "e")], "doc_id long, toxic int, text string")
    rows = toxicity(docs, labels).collect()
    assert len(rows) == len(texts()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.score == 0 for r in rows if r.doc_id in (20, 21, 22))
    assert len({r.score for r in rows if r.doc_id == 50}) == 1
    nothing = labels.limit(0)
    assert {r.predicted for r in toxicity(docs, nothing).collect()} == {0} and toxicity(empty(spark), labels).collect() == []
    kept, score, predicted = with_toxicity(docs, nothing)
    assert kept.columns == [*docs.columns, "_score", "_predicted"] and (score, predicted) == ("_score", "_predicted")


def test_op5_scores_every_document(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = QUERIES["op5_toxicity"](spark, sf_dir).toPandas()
    assert sorted(rows.doc_id) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert rows.score.between(0, 1).all() and rows.held_out.mean() < 0.3


def test_long_texts_are_learnt_by_excerpts(spark):
    long = [(i, "zz", " ".join(f"word{i} start" if j < 50 else "middle" if j < 2000 else f"end{i}" for j in range(4000))) for i in range(30)]
    rows = spark.createDataFrame(long + [(100 + i, "aa", "brief") for i in range(30)] + [(200, None, "none"), (None, "aa", "no id"), (201, "aa", "")], "doc_id long, lang string, text string")
    got = language_sample(rows, "doc_id", "text", "lang", 20, 400)
    assert got.groupby("lang").size().to_dict() == {"aa": 20, "zz": 20}
    assert all(len(t) == 403 and "start" in t and "middle" in t and "end" in t for t in got.text[got.lang == "zz"])
    again = language_sample(rows.unionByName(rows).repartition(7), "doc_id", "text", "lang", 20, 400)
    assert got.equals(again)
    assert len(language_sample(rows, "doc_id", "text", "lang", 1000, 400)) == 60


def test_languages_are_told_apart(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").toPandas().merge(QUERIES["op10_language_id"](spark, sf_dir).toPandas(), on="doc_id")
    held = d[d.held_out]
    assert len(held) > 150 and (held.lang == held.lang_pred).mean() > 0.97 and d.score.between(0, 1).all()


def test_language_cases(spark):
    rows = languages(frame(spark)).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(texts()) and all(got[i].lang_pred == "und" and got[i].score == 0 for i in (20, 21, 22, 26))
    assert got[10].lang_pred in ("en", "de") and languages(empty(spark)).collect() == []
    assert {r.lang_pred for r in languages(frame(spark).withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert Classifier(["abc"], ["en"]).predict(pa.array(["abd", "1"]))[0] == ["en", "und"]


def test_very_long_texts_are_told_apart():
    r = random.Random(4)
    vocabulary = {lang: ["".join(r.choice(letters) for _ in range(r.randint(2, 8))) for _ in range(150)] for lang, letters in (("aa", "abcdehilnorst"), ("bb", "adefgikmnrsuz"))}

    def text(lang, n, ids):
        return " ".join(r.choice(vocabulary[lang]) for _ in range(n)) + "".join(" #" + "".join(chr(r.randrange(0x4E00, 0x5000)) for _ in range(4)) for _ in range(ids))

    model = Classifier([text(lang, 120, 5) for lang in ("aa", "bb") * 60], ["aa", "bb"] * 60)
    for n, ids in ((200, 0), (20_000, 30_000)):
        assert model.predict(pa.array([text("aa", n, ids), text("bb", n, ids)]))[0] == ["aa", "bb"]


def test_kernels_are_exact_counts(monkeypatch):
    t = ["Ábc 12\tdé", "", "abc abd", "aa aa", "x" * 50 + "abc"]
    sets = []
    for x in t:
        x = x.lower().replace("1", "0").replace("2", "0").replace("\t", " ")
        sets.append({x[a:a + k] for k in (1, 2, 3, 4) for a in range(len(x) - k + 1)})
    monkeypatch.setattr(langid, "BLOCK", 8)  # so that the product runs over several blocks
    got = Landmarks(grams(pa.array([t[0], t[2], t[4]]))).kernel(grams(pa.array(t)))
    want = [[len(a & sets[b]) / max(1, len(a) * len(sets[b])) ** 0.5 for b in (0, 2, 4)] for a in sets]
    assert np.allclose(got, want)


def plain_rake(cells: pd.DataFrame, targets: dict, turns: int = 500) -> np.ndarray:
    w = (cells.tokens / cells.tokens.sum()).to_numpy()
    for _ in range(turns):
        for m, t in targets.items():
            w = w * cells[m].map(t).to_numpy() / pd.Series(w).groupby(cells[m].to_numpy()).transform("sum").to_numpy()
    return w


def test_raking_meets_targets_like_a_plain_version(spark):
    r = random.Random(9)
    cells = pd.DataFrame([(a, b, c, r.randint(1, 1000)) for a in "xyz" for b in "pq" for c in "mn" if r.random() < 0.9], columns=["a", "b", "c", "tokens"])
    targets = {"a": {"x": 0.5, "y": 0.3, "z": 0.2}, "b": {"p": 0.6, "q": 0.4}, "c": {"m": 0.25, "n": 0.75}}
    tables = {m: spark.createDataFrame(list(t.items()), f"{m} string, target double") for m, t in targets.items()}
    raked, gaps = rake(spark.createDataFrame(cells), tables, tolerance=1e-10)
    got = raked.toPandas().merge(cells.assign(want=plain_rake(cells, targets)), on=["a", "b", "c", "tokens"])
    assert max(gaps.values()) < 1e-6 and len(got) == len(cells) and np.allclose(got.weight, got.want, atol=1e-8)
    chance = calibrated(raked, 0.5).toPandas()
    assert abs((chance.tokens * chance.probability).sum() / cells.tokens.sum() - 0.5) < 1e-9
    open_ = chance[chance.probability < 1]
    assert np.allclose(open_.probability * open_.tokens / open_.weight, (open_.probability * open_.tokens / open_.weight).iloc[0])


def test_unknown_levels_and_empty_cells(spark):
    cells = spark.createDataFrame([("x", 10), (None, 10), ("gone", 10), ("x", 0)], "a string, tokens long")
    raked, _ = rake(cells, {"a": spark.createDataFrame([("x", 1.0), (None, 1.0), ("absent", 2.0)], "a string, target double")})
    assert sorted((r.a or "", r.tokens, round(r.weight, 9)) for r in raked.collect()) == [("", 10, 0.5), ("gone", 10, 0.0), ("x", 0, 0.0), ("x", 10, 0.5)]


def test_targets_that_cannot_be_met_are_named(spark):
    one = spark.createDataFrame([("x", "p", 10), ("y", "q", 10), ("y", "p", 5)], "a string, b string, tokens long")
    give = lambda m, t: spark.createDataFrame(list(t.items()), f"{m} string, target double")
    _, gaps = rake(one, {"a": give("a", {"x": 0.9, "y": 0.1}), "b": give("b", {"p": 0.2, "q": 0.8})})
    assert max(gaps.values()) > 0.1
    _, gaps = rake(one, {"a": give("a", {"x": 0.3, "y": 0.7}), "b": give("b", {"p": 0.6, "q": 0.4})})
    assert max(gaps.values()) < 1e-5
    docs = spark.createDataFrame([(1, "s", "en", "some words here"), (2, "t", "de", "andere worte hier")], "doc_id long, source string, lang string, text string")
    with pytest.raises(ValueError, match="source|lang"):
        mix(docs, {"source": give("source", {"s": 0.9, "t": 0.1}), "lang": give("lang", {"en": 0.1, "de": 0.9})})
    met, names = mix(docs, {"source": give("source", {"s": 0.6, "t": 0.4})})
    assert met.count() == 2


def test_op4_keeps_the_wanted_tokens(spark, sf_dir):
    r = QUERIES["op4_mixing"](spark, sf_dir).toPandas()
    assert len(r) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert abs((r.tokens * r.probability).sum() / r.tokens.sum() - 0.8) < 1e-6
    cells = r.groupby(["source", "lang", "topic"]).agg(tokens=("tokens", "sum"), p=("probability", "first")).reset_index()
    targets = {}
    for m in ("source", "lang", "topic"):
        s = cells.groupby(m).tokens.sum() ** 0.7
        targets[m] = (s / s.sum()).to_dict()
    rate = plain_rake(cells, targets) / cells.tokens
    open_ = cells.p < 1
    assert open_.any() and np.allclose(cells.p[open_] / rate[open_], (cells.p / rate)[open_].iloc[0], rtol=1e-3)
    assert abs(r.tokens[r.kept].sum() / r.tokens.sum() - 0.8) < 0.05


def test_mixing_cases(spark):
    mixed, names = mix(frame(spark))
    assert names == {"tokens": "_tokens", "topic": "_topic", "probability": "_probability", "kept": "_kept"}
    rows = mixed.collect()
    assert len(rows) == len(texts()) and all(0 <= r["_probability"] <= 1 for r in rows)
    assert {r["_probability"] for r in rows if r.doc_id in (20, 21, 22)} == {0.8} and {r["_topic"] for r in rows if r.doc_id == 20} == {None}
    assert len({r["_kept"] for r in rows if r.doc_id == 50}) == 1
    assert mix(empty(spark))[0].collect() == []
    assert with_profile(frame(spark), "text", "w", "c").filter("doc_id = 25").first().w == 2
