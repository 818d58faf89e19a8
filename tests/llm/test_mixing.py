import random

import pytest
from pyspark.sql import functions as F

from patchlens.llm import mixing as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(seed=1, n=400):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        source = None if i % 17 == 0 else ("hot" if i % 3 == 0 else f"s{i % 5}")
        words = rnd.choice([0, 1, 3, 10, 40, 200])
        text = None if i % 41 == 0 else "\t ".join(["w x"] * words)
        rows.append((i, text, "en", source, 0))
    rows += [(None, "a b c", "en", "s1", 0), (7, "a b", "en", "s1", 0), (7, "a b", "en", "s1", 0)]
    return rows


def size_of(text):
    return len((text or "").encode().split())


def reference_targets(sizes):
    """Share again and again by weight until no target is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: [3, 1, 2][i % 3] for i, s in enumerate(names)}
    budget, target, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while True:
        left = budget - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not above:
            return target | share
        for s in above:
            target[s] = 2.0 * sizes[s]
            open_.discard(s)


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_draws(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, SCHEMA)
    got = M.draws_of_rows(docs, n_shards=5, block_words=64).select("_row.*", "mix.*").collect()
    assert len(got) == len(rows)
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + size_of(r[1])
    want = reference_targets(sizes)
    for s in sizes:
        mine = [r for r in got if r["source"] == s]
        assert all(r["size"] == size_of(r["text"]) and r["source_size"] == sizes[s] for r in mine)
        assert all(r["target"] == pytest.approx(want[s]) for r in mine)
        words = [sum(d["words"] for d in r["draws"]) for r in mine]
        assert all(w <= 2 * r["size"] for w, r in zip(words, mine))
        assert abs(sum(words) - want[s]) <= 0.5 + 1e-6
    again = M.draws_of_rows(docs.repartition(7), n_shards=5, block_words=64).select("_row.doc_id", "mix.draws").collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"], str(r["draws"]))
    assert sorted(map(str, sorted(again, key=key))) == sorted(str(r) for r in sorted(
        (type(again[0])(doc_id=r["doc_id"], draws=r["draws"]) for r in got), key=key))


def test_mix_rows_and_clashing_names(spark):
    docs = spark.createDataFrame(corpus(3), SCHEMA).withColumn("size", F.lit("x")).withColumn("shard", F.lit(1.5)) \
        .withColumn("words", F.lit(None).cast("string")).withColumn("draws", F.array(F.lit(1))).withColumn("_src", F.lit(0))
    out = M.mix(docs, n_shards=3, block_words=16)
    assert out.columns == [*docs.columns, "_shard", "place", "copy", "_words"]
    n = sum(len(r["draws"]) for r in M.draws_of_rows(docs, n_shards=3, block_words=16).select("mix.draws").collect())
    rows = out.collect()
    assert len(rows) == n and {r["shard"] for r in rows} == {1.5}
    assert {r["_shard"] for r in rows} == {0, 1, 2}


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert M.draws_of_rows(none).collect() == [] and M.mix(none).collect() == []
    blank = spark.createDataFrame([(1, "", "en", "a", 0), (2, None, None, None, None)], SCHEMA)
    assert [r["mix"]["draws"] for r in M.draws_of_rows(blank).collect()] == [[], []]


def test_tree_quotas_are_exact(spark):
    quotas = [1000, 1, 0, 37, 412]
    for k in (1, 2, 7, 64):
        leaves = M.splitting_tree(spark.range(1).select(F.array(*[F.lit(q).cast("bigint") for q in quotas]).alias("quotas")), k, seed=3)
        got = {r["shard"]: r["quotas"] for r in leaves.collect()}
        assert sorted(got) == list(range(k))
        assert [sum(v) for v in zip(*got.values())] == quotas
        n = sum(quotas)
        assert all(sum(got[i]) == (i + 1) * n // k - i * n // k for i in range(k))
        assert min(min(v) for v in got.values()) >= 0


def test_hypergeometric_distribution(spark):
    from math import comb

    n, q, m, trials = 40, 12, 15, 20000
    draws = spark.range(trials).select(M.hypergeometric(F.lit(n), F.lit(q), F.lit(m), M.uniform(F.lit(5), F.col("id"))).alias("x"))
    got = {r["x"]: r["count"] for r in draws.groupBy("x").count().collect()}
    for x in range(0, 13):
        p = comb(q, x) * comb(n - q, m - x) / comb(n, m)
        assert abs(got.get(x, 0) / trials - p) < 5 * (p * (1 - p) / trials) ** 0.5 + 1e-4
    edges = spark.range(50).select(M.hypergeometric(F.lit(9), F.lit(9), F.lit(4), M.uniform(F.col("id"))).alias("a"),
                                   M.hypergeometric(F.lit(9), F.lit(0), F.lit(4), M.uniform(F.col("id"))).alias("b"),
                                   M.hypergeometric(F.lit(9), F.lit(3), F.lit(9), M.uniform(F.col("id"))).alias("c"),
                                   M.hypergeometric(F.lit(0), F.lit(0), F.lit(0), M.uniform(F.col("id"))).alias("d"))
    assert {tuple(r) for r in edges.collect()} == {(4, 0, 3, 0)}


def test_main_path_is_native(spark):
    docs = spark.createDataFrame(corpus(1), SCHEMA)
    plan = M.draws_of_rows(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
