"""Whitening against numpy and exact integers."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from patchlens.llm import whitening as W

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>"


def x_of(v):
    return [math.floor(1024 * c) + 100000 for c in v]


def sound(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def brute(vectors):
    """n, exact sums, exact covariance (as fractions) of x."""
    xs = [x_of(v) for v in vectors]
    n, dim = len(xs), len(xs[0])
    s = [sum(x[i] for x in xs) for i in range(dim)]
    centred = [[n * x[i] - s[i] for i in range(dim)] for x in xs]
    cov = [[Fraction(sum(c[i] * c[j] for c in centred), n**3) for j in range(dim)] for i in range(dim)]
    return n, s, centred, cov


def check(rows, table, top=8):
    kept = [(i, v) for i, v in table if sound(v)]
    n, s, centred, cov = brute([v for _, v in kept])
    dim = len(s)
    v = np.array([[float(c) for c in row] for row in cov])
    values = np.linalg.eigvalsh(v)[::-1]
    dev = sorted((i is None, i or 0, sum(c * c for c in row)) for (i, _), row in zip(kept, centred))
    k = min(top, dim)
    for comp in range(1, k + 1):
        mine = [r for r in rows if r["component"] == comp]
        assert sorted((r["vec_id"] is None, r["vec_id"] or 0, int(r["deviation"])) for r in mine) == dev
        assert {r["n"] for r in mine} == {n}
        assert mine[0]["explained"] == pytest.approx(values[comp - 1] / v.trace(), rel=1e-9)
    assert len(rows) == n * k
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] <= 1e-9
    # the whitened values span the brute-force components: projecting back gives covariance one
    w = {}
    for r in rows:
        w.setdefault(r["vec_id"], {})[r["component"]] = r["whitened"]
    ids = {}
    for (i, _), row in zip(kept, centred):
        ids[i] = row
    if len(ids) == n:
        y = np.array([[float(Fraction(c, n)) for c in ids[i]] for i in ids])
        z = np.array([[w[i][c + 1] for c in range(k)] for i in ids])
        basis = np.linalg.eigh(v)[1][:, ::-1][:, :k]
        want = y @ basis / np.sqrt(values[:k])
        sign = np.sign((want * z).sum(axis=0))
        assert np.allclose(z, want * sign, atol=1e-7)


def run(spark, table, **kw):
    df = spark.createDataFrame(table, SCHEMA).withColumn("n", F.lit("clash")).withColumn("dim", F.lit(1)).withColumn("v", F.lit(1))
    return W.whiten(df, **kw).collect()


def test_random_vectors_with_unusable_rows(spark):
    rnd = np.random.default_rng(1)
    mix = rnd.normal(size=(10, 10))
    table = [(i, (rnd.normal(size=10) @ mix).tolist()) for i in range(300)]
    bad = [(900, None), (901, [1.0] * 9 + [None]), (902, [float("nan")] + [1.0] * 9), (903, [float("inf")] + [1.0] * 9)]
    check(run(spark, table + bad), table + bad)
    few = [(i, v[:3]) for i, v in table]
    check(run(spark, few), few)


def test_repeated_rows_null_ids_and_zero_vectors(spark):
    rnd = np.random.default_rng(2)
    table = [(i, rnd.normal(size=4).tolist()) for i in range(20)]
    table += [(3, table[3][1]), (3, table[3][1]), (None, [0.0] * 4), (None, [0.0] * 4)]
    check(run(spark, table), table)


def test_one_partition_or_many_agree(spark):
    rnd = np.random.default_rng(3)
    df = spark.createDataFrame([(i, rnd.normal(size=5).tolist()) for i in range(50)], SCHEMA)
    key = lambda rows: sorted((r["vec_id"], r["component"], r["deviation"], r["whitened"]) for r in rows)
    assert key(W.whiten(df.repartition(1)).collect()) == key(W.whiten(df.repartition(7)).collect())


def test_large_entries_stay_exact(spark):
    rnd = np.random.default_rng(4)
    table = [(i, [float(x) for x in rnd.normal(size=3) * 1e12]) for i in range(30)]
    rows = run(spark, table)
    _, _, centred, _ = brute([v for _, v in table])
    dev = {i: sum(c * c for c in row) for (i, _), row in zip(table, centred)}
    assert all(int(r["deviation"]) == dev[r["vec_id"]] for r in rows)
    # an entry without an x of 64 bits takes its row out
    assert {r["vec_id"] for r in run(spark, table + [(99, [1e300, 0.0, 0.0])])} == set(range(30))


def test_rows_that_agree_have_no_components(spark):
    rows = run(spark, [(i, [0.5, 0.25]) for i in range(5)])
    assert len(rows) == 10
    assert all(r["whitened"] is None and r["explained"] is None and r["deviation"] == 0 and r["identity_error"] == 0.0 for r in rows)
    one = run(spark, [(1, [0.5, 0.25])])
    assert len(one) == 2 and one[0]["n"] == 1


def test_lengths_are_whitened_apart(spark):
    rnd = np.random.default_rng(5)
    a = [(i, rnd.normal(size=3).tolist()) for i in range(20)]
    b = [(100 + i, rnd.normal(size=2).tolist()) for i in range(20)]
    rows = run(spark, a + b + [(500, [])])
    check([r for r in rows if r["vec_id"] < 100], a)
    check([r for r in rows if r["vec_id"] >= 100], b)
    assert 500 not in {r["vec_id"] for r in rows}


def test_empty_table(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == []


def test_query(spark):
    table = [(r["vec_id"], list(map(float, r["embedding"]))) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    rows = E.queries()["op12_whitening"](spark, SF).collect()
    kept = [(i, v) for i, v in table if sound(v)]
    x = np.array([x_of(v) for _, v in kept], np.int64)
    n = len(x)
    centred = n * x - x.sum(axis=0)
    dev = {i: int(d) for (i, _), d in zip(kept, (centred**2).sum(axis=1))}
    assert len(rows) == 8 * n and all(r["deviation"] == dev[r["vec_id"]] and r["n"] == n for r in rows)
    v = (centred / n).T @ (centred / n) / n
    values = np.linalg.eigvalsh(v)[::-1]
    w = np.zeros((n, 8))
    at = {i: k for k, (i, _) in enumerate(kept)}
    for r in rows:
        w[at[r["vec_id"]], r["component"] - 1] = r["whitened"]
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / v.trace(), rel=1e-9)
    error = np.abs(w.T @ w / n - np.eye(8)).max()
    assert error <= 1e-9 and abs(rows[0]["identity_error"] - error) <= 1e-9
