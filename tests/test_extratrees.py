"""Extremely randomised trees against a plain recursion that draws the same thresholds."""

import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import types as T

from patchlens.operators import extratrees as ET

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("features", VectorUDT()), T.StructField("y", T.DoubleType())])


def _frame(spark, x, y):
    return spark.createDataFrame([(i, Vectors.dense(list(r)), v) for i, (r, v) in enumerate(zip(x, y))], SCHEMA)


def _data(n=400, seed=3):
    rnd = np.random.default_rng(seed)
    x = rnd.normal(size=(n, 4))
    x[:, 2] = 1.0  # constant
    x[:, 3] = np.round(x[:, 3])  # ties
    x[::17, 0] = np.nan
    y = np.where(x[:, 1] > 0, 4.0, -1.0) + 0.25 * x[:, 3] + 0.01 * rnd.normal(size=n)
    return x, y


def _grow(x, y, rows, seed, tree, depth, min_rows):
    """Expected tree as nested tuples, nodes numbered level by level as children are made."""
    values, splits, level, made = {0: y[rows].mean()}, {}, [(0, rows)], 1
    for _ in range(depth):
        below = []
        for node, at in level:
            if len(at) < min_rows or y[at].min() == y[at].max():
                continue
            rnd, best = random.Random(f"{seed}|{tree}|{node}"), None
            for f in range(x.shape[1]):
                u = rnd.random()
                known = x[at, f][~np.isnan(x[at, f])]
                if not len(known) or known.min() == known.max():
                    continue
                cut = known.min() + u * (known.max() - known.min())
                left = at[x[at, f] <= cut]
                right = np.setdiff1d(at, left)
                if len(left) and len(right):
                    gain = y[left].sum() ** 2 / len(left) + y[right].sum() ** 2 / len(right)
                    if best is None or gain > best[0] + 1e-9:
                        best = (gain, f, cut, left, right)
            if best:
                _, f, cut, left, right = best
                splits[node] = (f, cut, made, made + 1)
                for child in (left, right):
                    values[made] = y[child].mean()
                    below.append((made, child))
                    made += 1
        level = below
    return values, splits


def test_equals_plain_recursion(spark):
    x, y = _data()
    df = _frame(spark, x, [float(v) for v in y]).repartition(5)
    model = ET.ExtraTreesRegressor("y", numTrees=4, maxDepth=5, seed=9).fit(df)
    for t, tree in enumerate(model.trees):
        values, splits = _grow(x, y, np.arange(len(y)), 9, t, 5, 2)
        assert {k: (f, tree.left[k], tree.right[k]) for k, f in enumerate(tree.feature) if f >= 0} == {
            k: (f, le, ri) for k, (f, _, le, ri) in splits.items()}
        assert all(abs(tree.cut[k] - c) < 1e-12 for k, (_, c, _, _) in splits.items())
        assert np.allclose(tree.value, [values[k] for k in range(len(values))], atol=1e-5)


def test_same_forest_for_any_partitioning_and_bounded_jobs(spark, monkeypatch):
    x, y = _data(200)
    df = _frame(spark, x, [float(v) for v in y])
    one = ET.ExtraTreesRegressor("y", numTrees=3, maxDepth=6).fit(df.coalesce(1))
    monkeypatch.setattr(ET, "MAX_CELLS", 20)  # four nodes a job
    many = ET.ExtraTreesRegressor("y", numTrees=3, maxDepth=6).fit(df.repartition(7))
    assert one.trees == many.trees


def test_predictions(spark):
    x, y = _data(600)
    df = _frame(spark, x, [float(v) for v in y])
    model = ET.ExtraTreesRegressor("y", numTrees=10, maxDepth=8).fit(df.filter("id % 3 <> 0"))
    held = model.transform(df.filter("id % 3 = 0")).collect()
    assert np.allclose([r["prediction"] for r in held], model.predict(np.array([r["features"].toArray() for r in held])))
    err = np.mean([(r["prediction"] - r["y"]) ** 2 for r in held])
    assert err < 0.15 * np.var([r["y"] for r in held])


def test_edge_cases(spark):
    df = _frame(spark, [[1.0], [2.0], [3.0]], [None, float("nan"), None])
    with pytest.raises(ValueError):
        ET.ExtraTreesRegressor("y", numTrees=1).fit(df)
    same = _frame(spark, [[1.0], [1.0], [1.0]], [0.0, 5.0, None])  # no threshold divides; the null target is left out
    m = ET.ExtraTreesRegressor("y", numTrees=2).fit(same)
    assert [t.feature for t in m.trees] == [[-1], [-1]] and {round(r["prediction"], 6) for r in m.transform(same).collect()} == {2.5}
    zero = _frame(spark, [[1.0], [2.0]], [0.0, 0.0])
    assert ET.ExtraTreesRegressor("y", numTrees=1).fit(zero).trees[0].value == [0.0]
    assert m.transform(same.limit(0)).count() == 0


def test_thresholds_are_drawn_by_the_tasks(spark, monkeypatch):
    """The driver gets thresholds and splits: it draws none itself, whatever the number of nodes."""
    import os

    from patchlens.operators import extratrees as X
    from patchlens.operators import models as MD

    driver, draw = os.getpid(), X.thresholds

    def elsewhere(*a):
        assert os.getpid() != driver, "drawn on the driver"
        return draw(*a)

    monkeypatch.setattr(X, "thresholds", elsewhere)
    df = MD.assembler(["x"]).transform(spark.range(60).selectExpr("double(id % 7) AS x", "double(id % 7) * 2 AS y"))
    model = X.ExtraTreesRegressor("y", numTrees=3, maxDepth=12).fit(df)
    assert all(t.feature[0] == 0 for t in model.trees)


def test_training_rows_are_spread_over_the_cores(spark):
    """Many rows in one partition go to several tasks; few rows stay where they are."""
    from patchlens.operators import models as MD

    cores = spark.sparkContext.defaultParallelism
    assert MD.spread(spark.range(0, 60_000, 1, 1)).rdd.getNumPartitions() == min(cores, 3)
    assert MD.spread(spark.range(0, 1_000, 1, 1)).rdd.getNumPartitions() == 1


def test_training_rows_take_no_more_tasks_than_cores(spark, monkeypatch):
    """Rows in many partitions are gathered; each task of a forest would add up and shuffle the sums of all nodes."""
    from patchlens.operators import models as MD

    cores = spark.sparkContext.defaultParallelism
    got = MD.spread(spark.range(0, 60_000, 1, 5 * cores))
    assert got.rdd.getNumPartitions() == min(cores, 3) and got.count() == 60_000
    assert MD.spread(spark.range(0, 1_000, 1, cores + 1)).rdd.getNumPartitions() == 1
    assert MD.spread(spark.range(0, 1_000, 1, cores)).rdd.getNumPartitions() == cores
    assert MD.spread(spark.range(0, 0, 1, 4)).count() == 0
    monkeypatch.setattr(MD, "SPREAD_MOST", 1_000)
    assert MD.spread(spark.range(0, cores * 1_000 + 1, 1, 1)).rdd.getNumPartitions() == 2 * cores
