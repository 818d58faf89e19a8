"""Terms made and counted in Arrow batches, against a plain count; texts and rows keep to tasks of bounded size."""

import re
from collections import Counter

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from patchlens.config import ENGLISH_STOP_WORDS
from patchlens.operators import models as MD
from patchlens.operators import split as SP
from patchlens.operators import stats as ST
from patchlens.operators import textvec as TV
from patchlens.operators.tfidf import TfidfVectorizer

TEXTS = ["The Fix of a_b  x9 9x _y", None, "", "caf\u00e9 na\u00efve \u212aernel \u0130x", "fix fix fix-it", "a\x00b \u4f60fix", "x9 fix 1 2 3", "of the"] * 3


def plain(bigrams):
    df, total = Counter(), Counter()
    for t in TEXTS:
        toks = [w for w in re.findall("[a-z0-9_]+", (t or "").lower()) if not w[0].isdigit() and w not in ENGLISH_STOP_WORDS]
        terms = toks + [f"{a} {b}" for a, b in zip(toks, toks[1:])] if bigrams else toks
        total.update(terms)
        df.update(set(terms))
    return {(t, df[t], n) for t, n in total.items()}


def test_counts_equal_the_plain_count(spark, monkeypatch):
    docs = spark.createDataFrame([(t,) for t in TEXTS], "text string").coalesce(2)
    for at_once in (1, 7, 10_000):  # however the documents are grouped
        monkeypatch.setattr(TV, "TERMS_AT_ONCE", at_once)
        for bigrams in (False, True):
            assert {tuple(r) for r in TV.text_stats(docs, "text", bigrams, parts=3).collect()} == plain(bigrams)
            terms = docs.select(TV.words(F.col("text"), bigrams=bigrams).alias("terms"))
            assert {tuple(r) for r in TV.term_stats(terms).collect()} == plain(bigrams)


def test_a_term_is_dealt_by_the_size_of_the_texts(spark, monkeypatch):
    docs = spark.createDataFrame([("x" * 1000,)] * 40, "text string")
    monkeypatch.setattr(TV, "TEXT_BYTES", 500)
    parts = TV.text_parts(docs, "text")
    assert parts == 80 and TV.text_stats(docs, "text", parts=parts).rdd.getNumPartitions() == 80


def test_weights_of_texts_are_those_of_their_terms(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string").withColumn("terms", TV.words(F.col("text"), bigrams=True))
    ours, terms = (TfidfVectorizer(inputCol=c, minDF=1, maxFeatures=5).fit(docs) for c in ("text", "terms"))
    assert (ours.vocabulary, ours.idf) == (terms.vocabulary, terms.idf)
    pick = lambda m: [tuple(r) for r in m.transform(docs).select("id", "features").orderBy("id").collect()]
    assert pick(ours) == pick(terms)


def test_saved_unigram_pipeline(spark, tmp_path):
    rows = [(i, "fix null pointer" if i % 2 else "new driver", float(i % 2)) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, subject string, label double")
    model = MD.text_estimator("subject", kind="naive_bayes", vocab_size=9, bigrams=False).fit(df)
    MD.save_model(model, str(tmp_path / "p"))
    pick = lambda m: [tuple(r) for r in m.transform(df).select("id", "prediction").collect()]
    assert pick(PipelineModel.load(str(tmp_path / "p"))) == pick(model)


def test_split_deals_no_row_by_its_class(spark):
    rows = spark.range(0, 3000, 1, 6).withColumn("label", (F.col("id") % 2).cast("int")).withColumn("text", F.lit("t"))
    d = SP.stratified_split(rows, "id", "label")
    assert d.rdd.getNumPartitions() == 6
    assert "SortMergeJoin" not in d._jdf.queryExecution().executedPlan().toString()


def test_one_sketch_for_the_brackets_of_a_column(spark, monkeypatch):
    monkeypatch.setattr(ST, "BRACKET_ROWS", 10)
    made = []
    sketch = F.percentile_approx
    monkeypatch.setattr(ST.F, "percentile_approx", lambda *a: made.append(1) or sketch(*a))
    df = spark.range(0, 1001).withColumn("x", (F.col("id") * 5 % 1001).cast("double"))
    assert ST.exact_quantiles(df, ["x"], [0.25, 0.5, 0.75]) == {"x": [250.0, 500.0, 750.0]}
    assert len(made) == 1
