"""The TF-IDF estimator against a plain computation, its persistence, and its plan."""

import math
from collections import Counter

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from patchlens.operators import models as MD
from patchlens.operators.tfidf import TfidfModel, TfidfVectorizer, entries

DOCS = [(1, ["b", "a", "a", "c"]), (2, ["a", "b"]), (3, ["b", "d", "d"]), (4, []), (5, None), (6, ["c", "c", "a", "rare"]), (7, ["zz"])]


def plain(docs, size, min_df, max_df):
    docs = [(i, Counter(t or [])) for i, t in docs]
    n = len(docs)
    df = Counter(t for _, c in docs for t in c)
    total = Counter()
    for _, c in docs:
        total.update(c)
    kept = sorted((t for t in df if min_df <= df[t] <= max_df * n), key=lambda t: (-total[t], t))[:size]
    vocab = sorted(kept)
    out = {}
    for i, c in docs:
        w = [c[t] * (math.log((1 + n) / (1 + df[t])) + 1) if t in c else 0.0 for t in vocab]
        norm = math.sqrt(sum(x * x for x in w))
        out[i] = {k: x / norm for k, x in enumerate(w) if x}
    return vocab, out


@pytest.mark.parametrize("size,min_df,max_df", [(10, 1, 1.0), (2, 1, 1.0), (10, 2, 0.4), (10, 5, 1.0)])
def test_weights_equal_the_plain_form(spark, size, min_df, max_df):
    df = spark.createDataFrame(DOCS, "id long, terms array<string>").withColumn("features_terms", F.lit("clash"))
    model = TfidfVectorizer(maxFeatures=size, minDF=min_df, maxDF=max_df).fit(df)
    vocab, want = plain(DOCS, size, min_df, max_df)
    assert model.vocabulary == vocab
    got = {r["id"]: {e["term_index"]: e["weight"] for e in r["w"]} for r in model.transform(df).select("id", entries(F.col("features")).alias("w")).collect()}
    assert got.keys() == want.keys()
    for i in want:
        assert got[i] == pytest.approx(want[i])


def test_empty_table(spark):
    df = spark.createDataFrame([], "id long, terms array<string>")
    model = TfidfVectorizer().fit(df)
    assert model.vocabulary == [] and model.transform(df).collect() == []


def test_saved_models_score_alike(spark, tmp_path):
    df = spark.createDataFrame(DOCS, "id long, terms array<string>")
    model = TfidfVectorizer(maxFeatures=3, minDF=1, outputCol="v").fit(df)
    model.save(str(tmp_path / "m"))
    again = TfidfModel.load(str(tmp_path / "m"))
    assert again.vocabulary == model.vocabulary and again.idf == model.idf and again.getOutputCol() == "v"
    assert again.transform(df).select("id", "v").collect() == model.transform(df).select("id", "v").collect()
    est = TfidfVectorizer(maxFeatures=7)
    est.save(str(tmp_path / "e"))
    assert TfidfVectorizer.load(str(tmp_path / "e")).getOrDefault("maxFeatures") == 7


def test_text_pipeline_round_trip(spark, tmp_path):
    rows = [(i, "fix the null pointer bug" if i % 2 else "add a new driver feature", float(i % 2)) for i in range(30)] + [(99, None, 0.0), (98, "  ", 1.0)]
    df = spark.createDataFrame(rows, "id long, subject string, label double")
    model = MD.text_estimator("subject", vocab_size=50).fit(df)
    MD.save_model(model, str(tmp_path / "p"))
    pick = lambda m: [tuple(r) for r in MD.positive_probability(m.transform(df)).select("id", "prediction", "p").collect()]
    assert pick(MD.load_model(str(tmp_path / "p"))) == pick(model)


def test_weights_need_no_exchange(spark):
    df = spark.createDataFrame(DOCS, "id long, terms array<string>")
    out = TfidfVectorizer(minDF=1).fit(df).transform(df)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_sizes_are_fitted_from_one_count(spark, monkeypatch):
    """Models of several sizes are those of single fits, though the terms are counted once."""
    from patchlens.operators import textvec as TV
    from patchlens.operators.tfidf import TfidfVectorizer

    rows = [(["a", "b", "a"],), (["b", "c"],), (["c", "a", "d"],), (["d"],), (None,), (["e", "e"],)]
    df = spark.createDataFrame(rows, "terms array<string>")
    single = [TfidfVectorizer(maxFeatures=k).fit(df) for k in (1, 3)]
    count, calls = TV.term_stats, []
    monkeypatch.setattr(TV, "term_stats", lambda *a: calls.append(1) or count(*a))
    both = TfidfVectorizer().fit_sizes(df, [1, 3])
    assert len(calls) == 1 and [len(m.vocabulary) for m in both] == [1, 3]
    for one, m in zip(single, both):
        assert (one.vocabulary, one.idf) == (m.vocabulary, m.idf)
        assert [r["features"] for r in one.transform(df).collect()] == [r["features"] for r in m.transform(df).collect()]


def test_grid_counts_the_texts_once(spark, monkeypatch):
    """All sizes and n-gram settings come from one count of the texts, and give what a fit of each would."""
    from patchlens.operators import textvec as TV

    rows = [(i, f"alpha beta{i % 4} gamma{i % 3} alpha beta{i % 4} the delta{i % 7}") for i in range(60)] + [(60, None), (61, " ")]
    df = spark.createDataFrame(rows, "id int, text string")
    points = [(v, b) for b in (False, True) for v in (3, 8)]
    single = []
    for vocab, bigrams in points:
        terms = df.withColumn("terms", F.coalesce(TV.words(F.col("text"), bigrams=bigrams), F.array().cast("array<string>")))
        m = TfidfVectorizer(inputCol="terms", maxFeatures=vocab).fit(terms)
        single.append((m.vocabulary, {r["id"]: r["features"] for r in m.transform(terms).collect()}))
    calls, count = [], TV.text_stats
    monkeypatch.setattr(TV, "text_stats", lambda *a, **k: calls.append(1) or count(*a, **k))
    models = TfidfVectorizer(inputCol="text").fit_grid(df, points)
    assert len(calls) == 1
    out = models[0].with_all(df, models, ["a", "b", "c", "d"])
    assert out.columns == ["id", "text", "a", "b", "c", "d"]
    got = out.collect()
    for (vocabulary, vectors), model, name in zip(single, models, "abcd"):
        assert model.vocabulary == vocabulary
        assert all(abs(r[name].toArray() - vectors[r["id"]].toArray()).max() < 1e-12 for r in got)


def test_text_fit_is_the_estimators(spark):
    """The classifier gets weights that are written once; the fitted pipeline scores raw texts like the estimator's."""
    df = spark.createDataFrame([(i, f"word{i % 5} other{i % 3} word{i % 5}", float(i % 5 > 2)) for i in range(80)], "id int, text string, label double")
    one = {r["id"]: r["probability"][1] for r in MD.text_estimator("text", vocab_size=6).fit(df).transform(df).collect()}
    model = MD.fit_text(df, "text", vocab_size=6)
    two = {r["id"]: r["probability"][1] for r in model.transform(df).collect()}
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-3 for k in one)


def test_fits_at_once_share_the_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(0, 60_000, 1, 8)
    assert MD.gathered(rows).rdd.getNumPartitions() == min(cores, 3)
    assert MD.gathered(rows, 60_000, fits=cores).rdd.getNumPartitions() == 1
