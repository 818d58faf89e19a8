import numpy as np
import pytest
from pyspark.sql import functions as F

from patchlens.llm import ann as A

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=20, every=20):
    kept = []
    for i, v, *_ in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        kept.append((i, [float(np.float32(x)) for x in v]))
    out = []
    for a, (q, x) in enumerate(kept):  # rows that repeat an id are rows of their own
        if q % every:
            continue
        scored = []
        for b, (c, y) in enumerate(kept):
            if a != b and len(x) == len(y):
                s = 0.0
                for p, r in zip(x, y):
                    s += p * r
                scored.append((-s, c))
        out += [(q, r, c, -s) for r, (s, c) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("rank", F.lit("x")).withColumn("block", F.lit(1)).repartition(3)
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in A.nearest(df, **kw).collect())


def vectors(seed, n=700, dim=24):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim)).astype(np.float32)
    v[::7] = v[0]  # one vector many times
    v[1::9] *= 1000
    v[2::11] = np.round(v[2::11])
    v[5, 3:] = 0
    return [(i, [float(x) for x in row], 0) for i, row in enumerate(v)]


def test_exact_with_ties_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(A, "BLOCK_BYTES", 8 * 24 * 50)
    monkeypatch.setattr(A, "LEAST_STRIPE_BYTES", 8 * 24 * 120)
    monkeypatch.setattr(A, "STRIPE_BYTES", 8 * 24 * 120)
    monkeypatch.setattr(A, "QUERY_STRIPE_BYTES", 8 * 24 * 20)
    rows = vectors(1)
    rows += [(None, [1.0] * 24, 0), (1000, None, 0), (1020, [0.0] * 24, 0), (1040, [1.0, None] + [0.0] * 22, 0),
             (1060, [float("nan")] + [1.0] * 23, 0), (1080, [float("inf")] + [1.0] * 23, 0), (1100, [], 0),
             (1120, [1.0, 2.0], 0), (1121, [1.0, 3.0], 0), (3, [5.0] * 24, 0), rows[40], rows[40], rows[41], (60, [2.0] * 24, 0), (1140, [1e-30] * 24, 0)]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 15, 45])
def test_few_candidates(spark, n):
    rows = vectors(2, n=max(n, 8))[:n]
    assert run(spark, rows) == brute(rows)


def test_many_dimensions_stay_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(rng.choice([-1.0, 1.0], size=(60, 3000)).astype(np.float32))]
    assert run(spark, rows, k=5) == brute(rows, k=5)


def test_bound_holds():
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(50, 40)), rng.normal(size=(60, 40)) * np.exp(rng.normal(size=(60, 1)) * 4)
    (ca, sa, la, pa), (cb, sb, lb, _) = A.quantise(a), A.quantise(b)
    approx = A.int8_product(ca, cb) * sa[:, None] * sb[None, :]
    bound = la[:, None] * np.linalg.norm(b, axis=1)[None, :] + pa[:, None] * lb[None, :]
    assert (np.abs(a @ b.T - approx) <= bound * (1 + 1e-9) + 1e-12).all()
    assert (A.int8_product(ca, cb) == ca.astype(np.int64) @ cb.astype(np.int64).T).all()
