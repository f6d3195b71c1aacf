import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from hypercell.llm import quality, queries, toxicity
from hypercell.llm.labelled import fold, sample

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name,label,folds,out,cut,least", [("op4_quality", "quality", 4, 2, 0.7, 0.97), ("op8_toxicity", "toxic", 5, 0, 0.5, 0.95)])
def test_held_out_accuracy(spark, name, label, folds, out, cut, least):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = queries.queries()[name](spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    rows = got.join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == out) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= cut) for r in rows)
    assert len(held) > 30 and sum(r["predicted"] == r[label] for r in held) >= least * len(held)


def test_toxicity_recall_and_precision(spark):
    """On the larger table, whose held-out fold has about a hundred toxic documents."""
    big = "/root/testdata/sf0.1"
    rows = queries.op8_toxicity(spark, big).where("held_out").join(spark.read.parquet(f"{big}/labels.parquet").where("toxic in (0, 1)"), "doc_id").collect()
    both = sum(r["predicted"] * r["toxic"] for r in rows)
    assert both >= 0.9 * sum(r["toxic"] for r in rows) and both >= 0.95 * sum(r["predicted"] for r in rows)


def test_scores_as_the_model(spark):
    """The query's scores against the model's, text by text."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    t = toxicity.train(docs, labels, folds=5, held_out=0)
    q = quality.train(docs, labels, folds=4, held_out=2)
    for name, plain in (("op8_toxicity", lambda x: t.score([x])[0]), ("op4_quality", lambda x: q.score(np.array([quality.features(x)]))[0])):
        got = {r["doc_id"]: r["score"] for r in queries.queries()[name](spark, SF).collect()}
        assert got.keys() == texts.keys() and all(abs(got[i] - plain(texts[i])) < 1e-9 for i in texts)


def test_rows_that_occur_often_count_often():
    rng = np.random.default_rng(2)
    v = (rng.random((60, 4)) < [0.1, 0.5, 0.3, 0.2]).astype(np.float32)
    times = rng.integers(1, 5, 60)
    a = toxicity.fit_label_model(np.repeat(v, times, axis=0), np.array([1, 1, 0, 1]))
    b = toxicity.fit_label_model(v, np.array([1, 1, 0, 1]), times.astype(float))
    assert np.allclose(a.rate, b.rate, atol=1e-5) and np.allclose(a.own, b.own, atol=1e-5) and abs(a.prior - b.prior) < 1e-5


def test_held_out_labels_do_not_matter(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").where(fold("doc_id", 4) == 2)
    assert sample(labels, "quality", folds=4, held_out=2) == []


def test_sample_is_bounded_and_the_same(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    a = sample(labels, "quality", limit=50)
    assert len(a) == 50 and a == sample(labels.repartition(7), "quality", limit=50)


def test_preferences_rank():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 4))
    y = (x @ [2.0, -1.0, 0.0, 0.5] > -0.6).astype(int)
    m = quality.fit(x, y)
    assert ((m.score(x) >= quality.CUT) == y).mean() > 0.97
    assert m.weights[0] > 0 > m.weights[1]


def test_weights_are_the_best_over_all_pairs():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 4))
    y = (x @ [2.0, -1.0, 0.0, 0.5] + rng.normal(size=400) > -0.6).astype(int)
    m = quality.fit(x, y)
    z = np.clip((x - x.mean(axis=0)) / x.std(axis=0), -8, 8)
    diff = (z[y == 1][:, None] - z[y == 0][None]).reshape(-1, 4)
    grad = diff.T @ (1 / (1 + np.exp(diff @ m.weights))) / len(diff) - 1e-3 * m.weights
    assert np.abs(grad).max() < 1e-6
    s = np.sort(z @ m.weights)
    k = (y == 0).sum()
    assert abs(m.threshold - (s[k - 1] + s[k]) / 2) < 1e-12 and abs(m.spread - s.std() / 4) < 1e-9


@pytest.mark.parametrize("far", [1e-9, 1.0, 3e4])
def test_scores_of_any_size_have_their_rank(far):
    s = np.random.default_rng(5).normal(size=500).round(2) * far
    for ranks in ((0, 1), (200, 201), (498, 499)):
        assert quality._ranked(lambda found: found(s[:, None], s), lambda x: x[:, 0], ranks) == [np.sort(s)[r] for r in ranks]


def test_every_label_counts(spark, monkeypatch):
    monkeypatch.setattr(quality, "PART_ROWS", 2500)
    monkeypatch.setattr(quality, "FAN", 3)
    rng = np.random.default_rng(6)
    words = ["plain", "words", "of", "a", "text", "BUY", "NOW!!", "| 100 |", "and", "so"]
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 9)).tolist()), int(rng.random() < 0.8)) for i in range(24_000)]
    docs = spark.createDataFrame([(i, t + " #" * (1 - y) * (i % 3)) for i, t, y in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    got, again = quality.train(docs, labels), quality.train(docs.repartition(7), labels.repartition(5))
    plain = quality.fit(np.array([quality.features(t + " #" * (1 - y) * (i % 3)) for i, t, y in rows]), np.array([y for _, _, y in rows]))
    for name in ("mean", "scale", "weights", "threshold", "spread"):
        assert np.allclose(getattr(got, name), getattr(plain, name), rtol=1e-6, atol=1e-9)
        assert np.array_equal(getattr(got, name), getattr(again, name))


def test_without_preferences():
    m = quality.fit(np.ones((3, 2)), np.ones(3, int))
    assert np.allclose(m.score(np.zeros((2, 2))), quality.CUT)
    assert np.allclose(quality.fit(np.empty((0, 2)), np.empty(0, int)).score(np.zeros((1, 2))), quality.CUT)


def test_label_model_finds_accuracies_and_repeats():
    rng = np.random.default_rng(1)
    y = rng.random(4000) < 0.3
    good = [np.where(y, rng.random(4000) < 0.8, rng.random(4000) < 0.05) for _ in range(4)]
    v = np.stack([*good, good[0]], axis=1).astype(np.float32)
    m = toxicity.fit_label_model(v, np.ones(5, int))
    assert ((m.posterior(v) > 0.5) == y).mean() > 0.95
    assert abs(m.prior - 0.3) < 0.05 and m.rate[1, 1] > 0.7 > 0.2 > m.rate[0, 1]
    assert max(m.own[0], m.own[4]) < 0.7 * m.own[1]  # a voter and its copy share their evidence


def test_terms_with_a_few_clean_documents_stay():
    toxic = {"always": 40, "mostly": 26, "chance": 6, "even": 20}
    got = toxicity.induce(toxic, {"mostly": 1, "chance": 4, "even": 20}, 352, 2800)
    assert got == ["always", "mostly"]


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (5, 1, 1), (None, 1, 1), (9, None, None), (77, 1, 0)], "doc_id long, quality int, toxic int")
    for module in (quality, toxicity):
        for given in (labels, labels.where("false")):
            m = module.train(odd, given)
            got = module.score(odd, m)
            assert got.count() == odd.count() and got.where("score is null or not score between 0 and 1").count() == 0
            assert module.score(none, m).collect() == []
        assert module.score(none, module.train(none, labels)).collect() == []
    m = quality.train(odd, labels)
    kept = quality.keep(odd, m)
    assert kept.columns == odd.columns and kept.count() == quality.score(odd, m).where(F.col("score") >= quality.CUT).count()
