"""One-pass patterns equal the separate regexes; counts over hot keys equal a plain count."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from patchlens import config
from patchlens.functions import text as X
from patchlens.functions.multimatch import PatternSet
from patchlens.operators import features as FE
from patchlens.operators import labels as L

ALL = [("kept", "|".join(config.SCHEDULING_KEYWORDS)), ("sql", config.GENERATOR_SUBJECT_REGEXP), *config.SUBJECT_FLAGS]


def _compare(spark, patterns, texts):
    ps = PatternSet(patterns)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = FE.scan_subject(df, ps, "s").withColumnRenamed("_bits", "_b")
    wrong = got.select("i", "s", *[(ps.flag(F.col("_b"), n) != X.rlike_ci("s", p)).alias(n) for n, p in patterns])
    bad = wrong.filter(" OR ".join(f"`{n}`" for n, _ in patterns))
    assert bad.collect() == []
    return got


def test_adversarial_overlaps(spark):
    rnd = random.Random(5)
    pieces = ["load", "balanc", "balance", "real", "time", "rt", "rq", "runqueue", "task", "group", "node", "numa", "de", "deadline",
              "delay", "sched", "uler", "fa", "ir", "fix", "bug", " ", "\n", ".", "x", "\r", " ", "\U0001f600", "RT", "Load", "l", "r"]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 7))) for _ in range(4000)]
    texts += [None, "", "loadbalance", "load\nbalance", "load\U0001f600balance", "realltime", "real\ntime", "loaloadbalanc",
              "fixfaixbug", "unrtime", "x" * 300_000 + "runrunqueue", "rqrtrq" * 20_000]
    got = _compare(spark, ALL, texts)
    assert got.filter("s IS NULL").first()["_b"] == 0


def test_every_character_folds_like_the_regex(spark):
    letters = [(f"l_{c}", c) for c in "abcdefghijklmnopqrstuvwxyz0_"]
    points = [chr(c) for c in itertools.chain(range(0xD800), range(0xE000, 0x1F800)) if c]
    _compare(spark, letters, points)
    _compare(spark, [("wide", "a.b"), ("opt", "a.?b")], [f"a{c}b" for c in points])


def test_random_patterns(spark):
    rnd = random.Random(11)
    for _ in range(4):
        pats = [(f"p{i}", "|".join("".join(rnd.choice(["a", "b", "c", ".", ".?"]) for _ in range(rnd.randint(1, 4))) + rnd.choice("abc")
                                   for _ in range(rnd.randint(1, 3)))) for i in range(6)]
        _compare(spark, pats, ["".join(rnd.choice("abcABC\nx") for _ in range(rnd.randint(0, 9))) for _ in range(600)])


@pytest.mark.parametrize("bad", ["a(b)", "a||b", "", "é", "a+", "a?"])
def test_other_regexes_are_refused(bad):
    with pytest.raises(ValueError):
        PatternSet([("p", bad)])


def test_filter_and_flags_search_the_text_once(spark):
    df = spark.createDataFrame([(1, "sched fix"), (2, "other"), (3, None)], "patch_id int, subject string")
    d = FE.text_features(df, keywords=config.SCHEDULING_KEYWORDS)
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lower(") == 1 and plan.count("(?U)") == 1
    want = L.keyword_filter(df, "subject").select("*", X.char_length("subject").alias("subject_length"),
                                                 X.word_count("subject").alias("word_count"), *X.subject_flags("subject"))
    assert d.collect() == want.collect() and d.count() == 1


def test_counts_with_hot_null_and_repeated_keys(spark):
    n = 30_000
    rows = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 1, None)
                                 .otherwise(F.concat(F.lit("a"), (F.col("id") % 9_000).cast("string"))).alias("e"))
    rows = rows.unionByName(rows.limit(100))
    assert FE.hot_keys(rows, "e") == ["hot"]
    got = FE.map_counts(rows, "e", "c")
    exact = rows.groupBy("e").agg(F.count("e").alias("n"))
    assert got.count() == n + 100 and got.columns == ["id", "e", "c"]
    j = got.join(exact, got.e.eqNullSafe(exact.e))
    assert j.filter("c <> n OR (c IS NULL) <> (n = 0)").count() == 0
    assert FE.map_counts(rows.limit(0), "e", "c").count() == 0
