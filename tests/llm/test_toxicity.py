import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from patchlens.llm import toxicity as X

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def auc(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y]
    neg = [s for s, y in zip(scores, labels) if not y]
    return np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])


def corpus(n=700, seed=1):
    rnd = random.Random(seed)
    vocab = [f"{a}{b}" for a in ("ta", "mo", "li", "sur") for b in ("ren", "dor", "kin", "pel", "va")]
    rows, labels = [], []
    for i in range(n):
        words = [rnd.choice(vocab) for _ in range(rnd.choice([5, 40, 200]))]
        toxic = rnd.random() < 0.25
        if toxic:
            for _ in range(2):
                words.insert(rnd.randrange(len(words) + 1), "grobok" + rnd.choice(["", "a", "ung", "isch", "en"]))
        rows.append((i, " ".join(words), "xx" if i % 3 else None, "s", 0))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_rows_are_told_apart(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("x")).withColumn("toxic", F.lit(0))
    lab = spark.createDataFrame(labels + [(None, 1, 1), (3, None, None), (10**9, 0, 1)], "doc_id long, quality int, toxic int")
    out = X.score_documents(docs, lab).collect()
    assert sorted(r["doc_id"] for r in out) == list(range(len(rows)))
    truth = {d: t for d, _, t in labels}
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [r for r in out if r["held_out"]]
    assert len(held) > 80
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    assert auc([r["score"] for r in held], [truth[r["doc_id"]] for r in held]) > 0.97
    kept = X.drop_toxic(docs, lab)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == sorted(r["doc_id"] for r in out if not r["rejected"])


def test_synthetic_labels_held_out(spark):
    docs, lab = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = {r["doc_id"]: r for r in X.score_documents(docs, lab).collect()}
    held = [(out[r["doc_id"]]["score"], r["toxic"]) for r in lab.collect() if out[r["doc_id"]]["held_out"]]
    assert auc(*zip(*held)) > 0.85


def test_inputs_of_a_score_are_the_text_alone(spark):
    rows, labels = corpus(300)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows, DOCS)
    model = X.fit(docs, lab, epochs=1)
    texts = [r[1] for r in rows[:20]] + ["", None, "!", "grobok", "a b"]
    a = spark.createDataFrame([(i, t, "xx", "s", 0) for i, t in enumerate(texts)], DOCS)
    b = spark.createDataFrame([(-i, t, None, "q", 9) for i, t in enumerate(texts)], DOCS)
    left, right = ({r["text"]: r["s"] for r in X.with_score(d, model, "s").collect()} for d in (a, b))
    assert left == right and all(0 <= v <= 1 for v in left.values()) and left[""] == left[None]


def test_long_texts_are_scored_whole(spark, monkeypatch):
    rows, labels = corpus(300)
    texts = [r[1] for r in rows]
    model = X.train(texts, np.array([t for *_, t in labels], np.float32), epochs=2)
    long = " ".join(texts) + " grobokung"
    whole = X.Scorer(model).logit(long)
    for size in (7, 64):
        monkeypatch.setattr(X, "_CHUNK", size)
        assert abs(X.Scorer(model).logit(long) - whole) < 1e-4
    monkeypatch.setattr(X, "_CACHE_WORDS", 10)
    scorer = X.Scorer(model)
    assert np.allclose([scorer.logit(t) for t in texts], [X.Scorer(model).logit(t) for t in texts], atol=1e-4)


def test_no_labels_or_one_class(spark):
    docs = spark.createDataFrame([(1, "a", "en", "s", 0), (None, None, None, None, None)], DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {(r["score"], r["predicted"], r["rejected"]) for r in X.score_documents(docs, none).collect()} == {(0.0, 0, False)}
    one = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in X.score_documents(docs, one).collect()} == {0.0}
    assert X.score_documents(docs.limit(0), none).collect() == [] and X.drop_toxic(docs.limit(0), none).collect() == []


def test_sample_is_bounded_and_leaves_held_out_rows_alone(spark):
    rows, labels = corpus(300)
    docs, lab = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    sample = X.training_sample(docs, lab, max_rows=50, max_chars=10_000)
    assert 0 < len(sample) <= 50 and sum(len(r[2]) for r in sample) <= 10_000
    assert all(r[0] != 0 for r in sample)


def test_best_threshold():
    assert 2 < X.best_threshold(np.array([1.0, 5, 2, 4]), np.array([0.0, 1, 0, 1])) < 4
    assert X.best_threshold(np.array([1.0, 1.0]), np.array([1.0, 1.0])) < 1


def test_cuts_of_all_rows_match_the_search_in_memory(spark):
    rnd = random.Random(3)
    rows = [(g, round(rnd.gauss(2 * y, 1.5), rnd.choice([1, 6])) * (50 if i == 7 else 1), y)
            for g in ("", "=en", "=fr") for i, y in enumerate([int(rnd.random() < 0.2) for _ in range(400)])]
    rows += [("=one", 1.0, 1), ("=one", 1.0, 0), ("=flat", 5.0, 1)]
    got = {r["_group"]: r for r in X.best_cuts(spark.createDataFrame(rows, "_group string, _logit double, _toxic long"), 0.3, 1.7)}
    for g in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == g]
        assert got[g]["cut"] == X.best_threshold(np.array([r[1] for r in own]), np.array([r[2] for r in own], float))
        assert (got[g]["toxic"], got[g]["total"]) == (sum(r[2] for r in own), len(own))


def test_thresholds_cover_all_labelled_rows_whatever_the_sample(spark):
    rows, labels = corpus(1200)
    docs, lab = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = X.fit(docs, lab, epochs=2, max_rows=60)
    truth = {d: t for d, _, t in labels}
    held = [(r[2] or "", X.Scorer(model).logit(r[1]), truth[r[0]]) for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 4]
    assert set(model.thresholds) == {"xx", ""}
    assert np.isclose(model.centre, X.best_threshold(np.array([h[1] for h in held]), np.array([h[2] for h in held], float)), atol=1e-4)
    for name, cut in model.thresholds.items():
        own = [h for h in held if h[0] == name]
        assert sum(h[2] for h in own) >= X.MIN_TOXIC
        assert np.isclose(cut, model.score(X.best_threshold(np.array([h[1] for h in own]), np.array([h[2] for h in own], float))), atol=1e-4)


def test_long_texts_do_not_displace_the_others(spark):
    rows, labels = corpus(300)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    short = X.training_sample(spark.createDataFrame(rows, DOCS), lab)
    fit_ids = [r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 5 in (1, 2, 3)]
    assert len(short) == len(fit_ids)
    budget = sum(len(r[2]) for r in short)
    # a copy of each fifth id has a very long text: its row goes, the id's short row stays
    long = [(i, "long " * budget, "en", "s", 0) for i in fit_ids[::5]]
    docs = spark.createDataFrame(rows + long, DOCS)
    assert sorted(r[2] for r in X.training_sample(docs, lab, max_chars=budget)) == sorted(r[2] for r in short)
    only = spark.createDataFrame(long, DOCS)
    with pytest.raises(ValueError, match="training sample"):
        X.fit(only, lab, max_chars=budget)
