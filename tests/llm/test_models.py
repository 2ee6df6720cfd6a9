"""The learnt operators: held-out accuracy on the supplied tables, and defined results at the edges."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from datamove.llm import language, quality, queries, toxicity

DOCS = "doc_id long, text string, lang string, score string"


@pytest.fixture(scope="module")
def larger():
    import os

    path = "/root/testdata/sf0.01"
    if not os.path.isdir(path):
        pytest.skip(f"no test data at {path}")
    return path


def held_out_accuracy(told, truth):
    rows = told.where("held_out").join(truth, "doc_id")
    return rows.agg(F.avg((F.col("guess") == F.col("truth")).cast("int"))).first()[0]


def test_language_held_out(spark, larger):
    told = queries.op9_language_mixture(spark, larger)
    documents = spark.read.parquet(f"{larger}/documents.parquet")
    assert told.count() == documents.count()
    truth = documents.select("doc_id", F.col("lang").alias("truth"))
    assert held_out_accuracy(told.withColumn("guess", F.col("lang_pred")), truth) > 0.97


def test_language_edges_and_mixtures(spark):
    english, german = "the cat sat on the mat with the hat and the rat ", "der hund und die katze sind in dem haus und schlafen "
    train = spark.createDataFrame([(1, english * 40, "en", ""), (2, german * 40, "de", ""), (3, "xyz", None, ""), (4, None, "en", "")], DOCS)
    model = language.learn_languages(train)
    assert model.names == ["de", "en"]
    texts = [english, german * 3, english * 6 + german * 3, None, "", "12 !? ²", "a", english]
    asked = spark.createDataFrame([(i, t, "zz", "mine") for i, t in enumerate(texts)], DOCS)
    told = {r["doc_id"]: r for r in language.tell_languages(asked, model, ["doc_id"]).collect()}
    assert [told[i]["lang_pred"] for i in range(8)] == ["en", "de", "en", "und", "und", "und", "de", "en"]
    assert [x["lang"] for x in told[2]["languages"]] == ["en", "de"] and 0.55 < told[2]["score"] < 0.8
    assert len(told[0]["languages"]) == 1 and told[3]["score"] == 0.0 and told[3]["languages"] == []
    none = language.learn_languages(train.where("lang = 'qq'"))
    assert language.tell_languages(asked, none, ["doc_id"]).select("lang_pred").distinct().collect() == [("und",)]
    assert language.tell_languages(asked.limit(0), model, ["doc_id"]).collect() == []


def test_shares_rise_to_the_likeliest():
    rng = np.random.default_rng(0)
    loglik = np.log(np.where(rng.random((300, 1)) < 0.7, [[0.9, 0.1]], [[0.1, 0.9]]))
    shares, reached = language._shares(loglik, np.zeros(300, int), np.array([0]), np.ones((1, 2)))
    grid = np.linspace(0.01, 0.99, 99)
    best = max(np.log(np.exp(loglik) @ [p, 1 - p]).sum() for p in grid)
    assert reached[0] >= best - 0.5


def test_toxicity_held_out(spark, larger):
    scored = queries.op2_toxicity(spark, larger)
    labels = spark.read.parquet(f"{larger}/labels.parquet").select("doc_id", F.col("toxic").alias("truth"))
    assert held_out_accuracy(scored.withColumn("guess", F.col("predicted")), labels) > 0.9
    assert scored.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_toxicity_of_misspellings_and_edges(spark):
    kind = ["a lovely day in the park with my friends", "the train leaves at nine from the main station", "we read the book and liked the end"]
    rude = [k + " you stupid idiot" for k in kind] + ["stupid stupid moron"]
    texts, labels = (kind * 20 + rude * 15), [0] * 60 + [1] * 60
    model = toxicity.fit(texts, labels, 0.5)
    asked = ["you stuupid person", "what a lovely park", "STUPID!", None, "", "...", "stupid " * 20_000]
    frame = spark.createDataFrame([(i, t, "en", "mine") for i, t in enumerate(asked)], DOCS)
    found = {r["doc_id"]: r for r in toxicity.score_toxicity(frame, model, ["doc_id"]).collect()}
    assert found[0]["score"] > found[1]["score"] and found[1]["predicted"] == 0
    assert found[2]["predicted"] == found[6]["predicted"] == 1
    assert found[3]["score"] == found[4]["score"] == found[5]["score"]
    assert toxicity.score_toxicity(frame.limit(0), model, ["doc_id"]).collect() == []


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b", "en", ""), (None, None, "en", "")], DOCS)
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.learn_toxicity(docs, labels)
    assert {r["predicted"] for r in toxicity.score_toxicity(docs, model, ["doc_id"]).collect()} == {0}


def test_resampling_keeps_good_text(spark, larger):
    kept = queries.op10_importance_resample(spark, larger)
    labels = spark.read.parquet(f"{larger}/labels.parquet")
    shares = {r["quality"]: r["s"] for r in kept.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("s")).collect()}
    assert shares[1] > 0.9 and shares[0] < 0.1
    assert kept.count() == spark.read.parquet(f"{larger}/documents.parquet").count()


def test_resampling_edges(spark):
    docs = spark.createDataFrame([(1, "good words here", "en", "x"), (1, "good words here", "en", "x"), (2, None, "en", "x"), (3, "", "en", "x"), (None, "### ###", "en", "x")], DOCS)
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (9, 1)], "doc_id long, quality int")
    rows = quality.resample(docs, labels, ["doc_id", "score"], k=1).collect()
    assert len(rows) == 5 and [r["kept"] for r in rows if r["doc_id"] == 1] in ([True, True], [False, False])
    assert all(r["log_ratio"] == 0 for r in rows if r["doc_id"] in (2, 3))
    assert sum(r["kept"] for r in rows) in (1, 2)
    assert quality.resample(docs, labels, ["doc_id"], k=99).where("kept").count() == 5
    assert quality.resample(docs, labels.limit(0), ["doc_id"]).where("kept").count() == 0
    assert quality.resample(docs.limit(0), labels, ["doc_id"]).collect() == []


@pytest.mark.parametrize("k", [1, 2, 5, 999, 1000])
def test_kth_largest(spark, k):
    values = [float((i * 7919) % 500) ** 3 for i in range(1000)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    assert quality.kth_largest(frame, "v", k) == sorted(values, reverse=True)[k - 1]


def test_log_ratio_is_the_ratio_of_two_models(spark):
    docs = spark.createDataFrame([(1, "a b a", "en", ""), (2, "c d", "en", "")], DOCS)
    ratio = quality.learn_ratio(docs, F.col("doc_id") == 1, smoothing=2.0)
    row = {r["doc_id"]: r["log_ratio"] for r in quality.log_ratios(docs, ["doc_id"], ratio).collect()}
    assert row[1] > 0 > row[2]


@pytest.mark.parametrize("before", range(12))
def test_worst_window_begins_anywhere(before):
    scores = toxicity.WordScores(np.zeros(toxicity.BUCKETS), 0.0)
    scores.known = {"bad": 4.0, **{f"c{i}": -1.0 for i in range(40)}}
    clean = [f"c{i}" for i in range(40)]
    text = " ".join([*clean[:before], "bad", *clean[12:17], "bad", *clean[17:30]])
    assert scores.texts([text])[0] == pytest.approx((2 * 4 - 6) / 8)
    assert scores.texts(["bad c1"])[0] == pytest.approx(3 / 8)


def test_long_texts_do_not_end_the_sample(spark):
    kind, rude = "we read the book and liked the end of it ", "you stupid idiot moron go away now please "
    rows = [(i, (rude if i % 2 else kind) * (3000 if i < 20 else 2)) for i in range(120)]
    docs = spark.createDataFrame([(i, t, "en", "") for i, t in [*rows, rows[5], (500, None)]], DOCS)
    labels = spark.createDataFrame([*[(i, i % 2) for i, _ in rows], (500, 0)], "doc_id long, toxic int")
    seen = []
    keep, toxicity.fit = toxicity.fit, lambda *sample: seen.append(sample) or keep(*sample)
    try:
        model = toxicity.learn_toxicity(docs, labels, most_chars=60_000)
    finally:
        toxicity.fit = keep
    texts, toxic, _ = seen[0]
    assert len(texts) == 121 and sum(toxic) == 60
    for label in (0, 1):
        assert 25_000 < sum(len(t) for t, x in zip(texts, toxic) if x == label) <= 30_000
    told = toxicity.score_toxicity(docs, model, ["doc_id"]).collect()
    assert all(r["predicted"] == r["doc_id"] % 2 for r in told if r["doc_id"] < 120)


def test_length_that_texts_are_cut_to():
    assert toxicity.longest_kept([], 10) == 0 and toxicity.longest_kept([3, 4], 10) == 4
    assert toxicity.longest_kept([1, 50, 2, 1000], 23) == 10


def test_every_set_size_is_tried_for_every_text(monkeypatch):
    model = language.Languages(["a", "b", "c"], [np.zeros(1 << 20, np.float32)] * 3)

    def shares(loglik, of, firsts, allowed):
        n = int(allowed.sum(1)[0])
        return allowed / n, np.full(len(firsts), {1: 0.0, 2: -1.0, 3: 1e6}[n])

    monkeypatch.setattr(language, "_shares", shares)
    found = language.mixtures(np.frombuffer(b"some text", np.uint8), np.array([0, 9]), model)
    assert found[0] == pytest.approx([1 / 3] * 3)
