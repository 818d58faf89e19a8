"""Histogram boosting against plain recursion over rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from patchlens.operators import boosting as B

FEATURES = ["a", "b", "c"]
SCHEMA = "id long, a double, b double, c double, y string, w double, grp string"


def rows_of(seed, n=240, classes=("no", "yes")):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = rnd.gauss(0, 1), float(rnd.randint(0, 3)), rnd.gauss(0, 1)
        y = classes[min(len(classes) - 1, int(a + 0.4 * b + 0.3 * rnd.gauss(0, 1) > 0.5) + (int(c > 0.8) if len(classes) > 2 else 0))]
        out.append((i, None if rnd.random() < 0.1 else a, b, c if rnd.random() > 0.05 else float("nan"), y, rnd.choice([0.5, 1.0, 2.0]), "g"))
    return out


# ------------------------------------------------------- plain reference

def missing(v):
    return v is None or math.isnan(v)


def t1(g, l1):
    return math.copysign(max(abs(g) - l1, 0.0), g)


def points(g, h, p):
    return t1(g, p.reg_alpha) ** 2 / (h + p.reg_lambda)


def plain_split(rows, g, h, cuts, p):
    """Best (gain, feature, threshold, missing side) over all cut points, by adding up rows."""
    whole = points(sum(g), sum(h), p)
    best = None
    for side in (False, True):
        for f, cs in enumerate(cuts):
            for t in cs:
                left = [side if missing(r[f]) else r[f] <= t for r in rows]
                gl, hl = sum(x for x, k in zip(g, left) if k), sum(x for x, k in zip(h, left) if k)
                gr, hr = sum(g) - gl, sum(h) - hl
                if min(hl, hr) < p.min_child_weight or min(sum(left), len(left) - sum(left)) < p.min_child_rows:
                    continue
                gain = points(gl, hl, p) + points(gr, hr, p) - whole
                if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                    best = (gain, f, t, side)
    return best


def plain_leaves(rows, g, h, cuts, p):
    """Depth-wise or best-first tree, as the value of each row's leaf."""
    value = [0.0] * len(rows)
    leaves = [(0, list(range(len(rows))))]
    done = []
    n = 1
    while leaves:
        if p.num_leaves is None:
            depth, at = leaves.pop()
            s = plain_split([rows[i] for i in at], [g[i] for i in at], [h[i] for i in at], cuts, p) if depth < p.depth else None
        else:
            found = [(plain_split([rows[i] for i in at], [g[i] for i in at], [h[i] for i in at], cuts, p), d, at) for d, at in leaves]
            found = [x for x in found if x[0] is not None]
            if not found or n >= p.num_leaves:
                done += leaves
                break
            s, depth, at = max(found, key=lambda x: x[0][0])
            leaves = [x for x in leaves if x[1] is not at]
        if s is None:
            done.append((depth, at))
            continue
        _, f, t, side = s
        goes = [side if missing(rows[i][f]) else rows[i][f] <= t for i in at]
        leaves += [(depth + 1, [i for i, k in zip(at, goes) if k]), (depth + 1, [i for i, k in zip(at, goes) if not k])]
        n += 1
    for _, at in done:
        gs, hs = sum(g[i] for i in at), sum(h[i] for i in at)
        for i in at:
            value[i] = -p.rate * t1(gs, p.reg_alpha) / (hs + p.reg_lambda)
    return value


def plain_boost(data, cuts, p, classes):
    x = [r[1:4] for r in data]
    y = [classes.index(r[4]) for r in data]
    w = [r[5] for r in data]
    k = 1 if len(classes) == 2 else len(classes)
    margin = [[0.0] * k for _ in data]
    for _ in range(p.rounds):
        prob = []
        for m in margin:
            if k == 1:
                prob.append([1 / (1 + math.exp(-m[0]))])
            else:
                e = [math.exp(v - max(m)) for v in m]
                prob.append([v / sum(e) for v in e])
        adds = []
        for c in range(k):
            if k == 1:
                g = [wi * (q[0] - yi) for wi, q, yi in zip(w, prob, y)]
                h = [wi * q[0] * (1 - q[0]) for wi, q in zip(w, prob)]
            else:
                g = [wi * (q[c] - (yi == c)) for wi, q, yi in zip(w, prob, y)]
                h = [wi * 2 * q[c] * (1 - q[c]) for wi, q in zip(w, prob)]
            adds.append(plain_leaves(x, g, h, cuts, p))
        margin = [[m[c] + adds[c][i] for c in range(k)] for i, m in enumerate(margin)]
    out = []
    for m in margin:
        if k == 1:
            q = 1 / (1 + math.exp(-m[0]))
            out.append([1 - q, q])
        else:
            e = [math.exp(v - max(m)) for v in m]
            out.append([v / sum(e) for v in e])
    return out


def fitted(spark, data, p, classes=None, bins=12, parts=3, **kw):
    df = spark.createDataFrame(data, SCHEMA).repartition(parts)
    model = B.fit(df, FEATURES, F.col("y"), p, weight=F.col("w"), key=F.col("id"), bins=bins, classes=classes, **kw)
    return model, df


def scores(model, df, name="model"):
    return {r["id"]: r["s"] for r in model.score(df, {"s": name}).select("id", "s").collect()}


@pytest.mark.parametrize("p", [
    B.Boost(rounds=3, depth=3, rate=0.3),
    B.Boost(rounds=2, depth=4, rate=0.5, reg_alpha=0.7, reg_lambda=3.0),
    B.Boost(rounds=2, depth=-1, num_leaves=6, rate=0.3, reg_lambda=0.0, min_child_weight=1e-3, min_child_rows=10),
])
@pytest.mark.parametrize("classes", [("no", "yes"), ("hi", "lo", "mid")])
def test_trees_equal_plain_recursion(spark, p, classes):
    data = rows_of(1, classes=classes)
    model, df = fitted(spark, data, p)
    assert model.classes == {"model": sorted(classes)}
    clean = df.select("id", *[F.col(c) for c in FEATURES])
    cuts = B.cut_points(clean, FEATURES, 12)
    want = plain_boost(data, cuts, p, sorted(classes))
    got = scores(model, df)
    for r, q in zip(data, want):
        assert got[r[0]]["probability"] == pytest.approx(q, abs=1e-5)
        top = max(range(len(q)), key=lambda i: q[i])
        assert got[r[0]]["confidence"] == pytest.approx(q[top], abs=1e-5)


def test_penalties_change_the_model():
    g, h, n = (np.array([[0.0, -4.0, 1.0, 5.0]]), np.array([[0.0, 4.0, 2.0, 4.0]]), np.array([[0.0, 8.0, 4.0, 8.0]]))
    allowed = np.array([True])
    plain = B.best_split(g, h, n, allowed, B.Boost(reg_lambda=0.0))
    l2 = B.best_split(g, h, n, allowed, B.Boost(reg_lambda=5.0))
    l1 = B.best_split(g, h, n, allowed, B.Boost(reg_lambda=0.0, reg_alpha=1.0))
    assert plain.gain > l2.gain > 0 and plain.gain > l1.gain > 0
    assert B.best_split(g, h, n, allowed, B.Boost(reg_alpha=10.0)) is None
    assert abs(B.leaf_value(-4.0, 4.0, B.Boost(reg_lambda=0.0, rate=1.0))) == 1.0
    assert abs(B.leaf_value(-4.0, 4.0, B.Boost(reg_lambda=4.0, rate=1.0))) == 0.5
    assert abs(B.leaf_value(-4.0, 4.0, B.Boost(reg_lambda=0.0, reg_alpha=2.0, rate=1.0))) == 0.5


def test_partitions_do_not_change_the_model(spark):
    data = rows_of(2)
    p = B.Boost(rounds=3, depth=4, subsample=0.7, colsample=0.7)
    a, _ = fitted(spark, data, p, parts=1)
    b, _ = fitted(spark, list(reversed(data)), p, parts=7)
    assert a.nodes == b.nodes


def test_models_fitted_together_equal_models_fitted_alone(spark):
    one, two = rows_of(3, 120), [(r[0] + 1000, *r[1:6], "h") for r in rows_of(4, 150, ("x", "y", "z"))]
    ps = {"g": B.Boost(rounds=2, depth=3), "h": B.Boost(rounds=3, depth=2, reg_lambda=2.0)}
    cuts_from = one + two  # cut points come from all rows, so both fits see the same rows
    both, df = fitted(spark, cuts_from, ps, model=F.col("grp"))
    alone, _ = fitted(spark, cuts_from, {"h": ps["h"]}, model=F.lit("h"), classes={"h": ["x", "y", "z"]})
    assert both.classes == {"g": ["no", "yes"], "h": ["x", "y", "z"]} and len(both.nodes["h"]) == 3
    # each model sees its own rows alone, and one pass scores every row by the model of its group
    scored = both.score(df, {"own": F.col("grp"), "none": F.lit(None).cast("string"), "other": F.lit("unknown")}).collect()
    for r in scored:
        assert r["own"]["label"] in both.classes[r["grp"]] and r["none"] is None and r["other"] is None
    assert [len(t) for t in both.nodes["h"]] == [3, 3, 3] and [len(t) for t in both.nodes["g"]] == [2]
    assert [len(t) for t in alone.nodes["h"]] == [3, 3, 3]


def test_rows_and_columns_are_sampled():
    key = np.arange(20000)
    share = B.sampled(key, 3, 42, 0.8).mean()
    assert abs(share - 0.8) < 0.02
    assert (B.sampled(key, 3, 42, 0.8) != B.sampled(key, 4, 42, 0.8)).any()
    assert (B.sampled(key, 3, 42, 0.8) == B.sampled(key, 3, 42, 0.8)).all()


def test_odd_tables(spark):
    p = B.Boost(rounds=2, depth=2, min_child_weight=0.0)
    empty, df = fitted(spark, [], p)
    assert empty.classes == {"model": []} and scores(empty, df) == {}
    single, df = fitted(spark, [(1, 1.0, 1.0, 1.0, "only", 1.0, "g"), (2, None, None, None, None, 1.0, "g")], p)
    assert single.classes == {"model": ["only"]} and single.nodes == {"model": []}
    assert all(s is None for s in scores(single, df).values())
    # constant and all-missing features, repeated rows, null weights
    data = [(i, 1.0, None, float(i % 2), "ab"[i % 2], None if i == 0 else 1.0, "g") for i in range(20)] * 2
    model, df = fitted(spark, data, p)
    got = scores(model, df)
    assert all(got[i]["label"] == "ab"[i % 2] for i in range(1, 20))
    assert model.importances("model") == [0.0, 0.0, 1.0]


def test_save_and_load(spark, tmp_path):
    model, df = fitted(spark, rows_of(5, classes=("hi", "lo", "mid")), B.Boost(rounds=3, depth=3))
    model.save(spark, str(tmp_path / "m"))
    again = B.Boosted.load(spark, str(tmp_path / "m"))
    assert again.nodes == model.nodes and again.classes == model.classes and again.features == model.features
    assert scores(again, df) == scores(model, df)


def test_splits_are_searched_where_the_sums_are(spark, monkeypatch):
    """The driver gets one split a node: it searches none itself, whatever the number of nodes, features and bins."""
    import os

    driver = os.getpid()

    def elsewhere(search):
        def run(*a):
            assert os.getpid() != driver, "searched on the driver"
            return search(*a)

        return run

    for name in ("best_split", "best_splits"):
        monkeypatch.setattr(B, name, elsewhere(getattr(B, name)))
    model, _ = fitted(spark, rows_of(5, classes=("hi", "lo", "mid")), B.Boost(rounds=2, depth=3))
    assert any(t["left"][0] >= 0 for t in model.nodes["model"][0])


def test_every_core_has_a_share_of_the_rows(spark):
    """20,000 rows are no work for one task; a task holds its rows of a model in one block."""
    from pyspark.sql import functions as F

    df = spark.range(20_000, numPartitions=1).select((F.col("id") % 97).cast("double").alias("x"), "id", (F.col("id") % 2).alias("y"))
    state = B.training_state(df, ["x"], F.lit(0), F.col("y"), F.lit(1.0), F.col("id"), [[10.0, 50.0]], [1], 20_000)
    tasks = min(spark.sparkContext.defaultParallelism, 3)
    assert state.rdd.getNumPartitions() == tasks and state.count() == tasks
    assert state.agg({"n": "sum"}).first()[0] == 20_000


def test_missing_values_of_a_feature_with_few_values(spark):
    """A feature of two values whose missing values decide the class, beside one of many values."""
    import random

    rnd = random.Random(4)
    rows = [(i, None if i % 3 == 0 else float(i % 2), rnd.random(), "yes" if i % 3 == 0 else "no") for i in range(120)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y string")
    model = B.fit(df, ["a", "b"], df.y, B.Boost(rounds=10, depth=3, rate=0.5), key=df.id)
    assert model.score(df, {"s": "model"}).filter("s.label <> y").count() == 0


def test_shares_beyond_the_cores_fill_whole_waves(spark):
    """One share more than the cores would leave a last wave of one task in each of the rounds' jobs."""
    cores = spark.sparkContext.defaultParallelism
    df = spark.range(50).select((F.col("id") % 7).cast("double").alias("x"), "id", (F.col("id") % 2).alias("y"))
    state = B.training_state(df, ["x"], F.lit(0), F.col("y"), F.lit(1.0), F.col("id"), [[3.0]], [1], B.TASK_ROWS * cores + 1)
    assert state.rdd.getNumPartitions() == 2 * cores and state.agg({"n": "sum"}).first()[0] == 50


def test_rows_are_routed_by_bins_of_a_feature():
    rnd = np.random.default_rng(1)
    bins = rnd.integers(0, 9, (3, 2 * B.ROUTE_ROWS + 5)).astype(np.uint8)
    tree = B.Tree()
    for node in tree.split(0, 1, 4, True):
        for child in tree.split(node, 2 * (node % 2), 3, False):
            if child % 2:
                tree.split(child, 1, 2, child > 4)
    got = tree.route(bins)
    for i in [*range(200), *range(bins.shape[1] - 50, bins.shape[1])]:
        node = 0
        while tree.left[node] >= 0:
            b = bins[tree.feature[node], i]
            left = tree.missing_left[node] if b == 0 else b <= tree.cut[node]
            node = tree.left[node] if left else tree.right[node]
        assert got[i] == node
    assert not B.Tree().route(bins).any()


def test_rounds_need_no_query_plan(spark, monkeypatch):
    """A round's jobs read the blocks where they lie; only the steps before the rounds are planned."""
    made = []
    collected = type(spark.range(1)).toArrow
    monkeypatch.setattr(type(spark.range(1)), "toArrow", lambda self: made.append(1) or collected(self))
    model, _ = fitted(spark, rows_of(6), B.Boost(rounds=3, depth=3))
    assert not made and len(model.nodes["model"][0]) == 3
