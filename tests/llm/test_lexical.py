"""Ranked search against a plain score of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as E
from patchlens.llm import lexical as S

SF = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, queries, k=20):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, c) for d, c in bags if c]
    n_docs, n_terms = len(bags), sum(sum(c.values()) for _, c in bags)
    df = Counter(t for _, c in bags for t in c)
    out = []
    for item, text in sorted(set(queries), key=repr):
        scored = []
        for d, c in bags:
            m = 75 + (25 * sum(c.values()) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                    for t in terms(text) if t in c)
            if s > 0:
                scored.append((-s, d is None, d or 0))
        for rank, (s, none, d) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, None if none else d, -s))
    return sorted(out, key=repr)


def run(spark, docs, queries, parts=4, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    d = d.withColumn("n", F.lit("clash")).withColumn("terms", F.lit(1)).withColumn("_text", F.lit(1))
    q = spark.createDataFrame(queries, "item_id long, text string").withColumn("score", F.lit("clash"))
    return sorted(map(tuple, S.search(d, q, **kw).collect()), key=repr)


def corpus(seed, n_docs=120, n_words=60):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(n_words)] + ["Caf" + chr(0xE9), chr(0x65E5) + chr(0x672C), "a_b", "X1"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rnd.choices(words, weights, k=rnd.randint(1, 50)))) for i in range(n_docs)]
    queries = [(i, " ".join(rnd.choices(words, weights, k=rnd.randint(1, 12)))) for i in range(15)]
    return docs, queries


def test_terms():
    assert [t.decode() for t in S.terms_of(("A-b " + chr(0xC9) + "t" + chr(0xE9) + "_X9\tz" + chr(0xA0) + "y\x00q").encode())] == \
        terms("A-b " + chr(0xC9) + "t" + chr(0xE9) + "_X9\tz" + chr(0xA0) + "y\x00q")


def test_random_corpora(spark):
    for seed in (1, 2):
        docs, queries = corpus(seed)
        assert run(spark, docs, queries) == brute(docs, queries)
        assert run(spark, docs, queries, k=3, parts=1) == brute(docs, queries, 3)


def test_odd_rows(spark):
    docs, queries = corpus(3, 40)
    docs += [(None, "w1 w2 w50"), (None, "w1 w2 w50"), (5, "w1 w2 w50"), (5, "w1 w2 w50"), (6, None), (7, ""), (8, "!!! --"), (9, "w1 " * 60000)]
    queries += [(1, "w0"), queries[2], queries[2], (None, "w1 w50 w50"), (70, None), (71, ""), (72, "?"), (73, "unseen"), (74, "w1 " * 500)]
    assert run(spark, docs, queries) == brute(docs, queries)


def test_ties_and_copies(spark):
    docs = [(i, "same text here") for i in range(100)] + [(200 + i, "same") for i in range(30)]
    queries = [(1, "text"), (2, "same here"), (3, "same")]
    assert run(spark, docs, queries) == brute(docs, queries)


def test_empty_tables(spark):
    docs, queries = corpus(4, 5)
    assert run(spark, [], queries) == [] and run(spark, docs, []) == [] and run(spark, [(1, None)], queries) == []


def test_query_blocks_and_small_blocks(spark, monkeypatch):
    docs, queries = corpus(5)
    monkeypatch.setattr(S, "query_blocks", lambda q, inner=S.query_blocks: inner(q, 100))
    assert run(spark, docs, queries) == brute(docs, queries)


def block_of(docs, weights, n_docs, n_terms, vocabulary):
    ids, n, sizes, ts, tfs = [], [], [], [], []
    for d, text in docs:
        c = Counter(terms(text))
        ids.append(d)
        n.append(sum(c.values()))
        sizes.append(len(c))
        ts += [vocabulary[t] for t in c]
        tfs += list(c.values())
    a = np.array
    return S.Block(a(ids), np.zeros(len(ids), bool), a(n), a(sizes), a(ts), a(tfs), weights, n_docs, n_terms)


def test_accumulators_are_limited_and_answers_exact():
    # one rare term decides; the common terms' bounds fall below the k-th partial score
    rnd = random.Random(6)
    docs = [(i, " ".join(["rare"] * 20 if i % 50 == 0 else []) + " c1 c2 " + " ".join(rnd.choices(["x", "y"], k=5))) for i in range(2000)]
    bags = [Counter(terms(t)) for _, t in docs]
    df = Counter(t for c in bags for t in c)
    vocabulary = {t: i for i, t in enumerate(sorted(df))}
    n_terms = sum(sum(c.values()) for c in bags)
    weights = np.array([S.weight(len(docs), df[t]) for t in sorted(df)])
    query = sorted(((vocabulary[t], 1) for t in ("rare", "c1", "c2")), key=lambda x: (df[sorted(df)[x[0]]], x[0]))
    best = S.Best(20)
    made = sum(block_of(docs[i: i + 500], weights, len(docs), n_terms, vocabulary).search(query, best) for i in range(0, 2000, 500))
    assert made == 40  # no accumulator for the documents without the rare term
    want = [(d, s) for _, _, d, s in sorted(brute(docs, [(1, "rare c1 c2")]), key=lambda r: r[1])]
    assert list(zip(best.ids.tolist(), best.scores.tolist())) == want


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = E.queries()["op13_lexical_search"](spark, SF)
    assert sorted((tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()), key=repr) == brute(docs, items)
