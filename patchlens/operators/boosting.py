"""Regularised second-order boosting on histograms (K4, K8, K9).

Many models are fitted at once: a training row names the model it belongs to,
and every job serves the open nodes of all models and classes.

1. Cut points per feature come from one approximate-quantile aggregation; a row
   keeps one byte a feature (0: missing).  Rows are dealt evenly to the tasks, and
   a task holds the rows of a model in blocks: an array a column, the bins feature by feature.
   The rounds' thousands of short jobs run on an RDD of the blocks, so none of them is planned.
2. For each open node, every task adds up gradients, second derivatives and rows
   per (tree, node, feature, bin), feature by feature; the tasks' cells are shuffled by node, and
   the tasks that get them find the best split of each of their nodes.  Sums are of
   fixed-point integers, so they do not depend on the order of rows or on recomputed tasks.
3. The best split of a node has the largest
       T(GL)^2 / (HL + l2) + T(GR)^2 / (HR + l2) - T(G)^2 / (H + l2),
   T(x) = sign(x) max(|x| - l1, 0); missing values go to the better side; a leaf
   adds -rate T(G) / (H + l2).  Trees grow level by level or, with
   ``num_leaves``, best leaf first; then all leaves that the order may reach are
   evaluated by one job, and the order is settled from their gains.
4. After a round, every row's margins take up the new trees.  Rows stay cached;
   every CHECKPOINT_ROUNDS rounds they go to the checkpoint folder, so a lost
   executor costs a few rounds at most.  A model ends early after a round in which no
   tree of it has a split.

What reaches the driver is one split for each open node.  A job serves as many
nodes as have MAX_CELLS (node, feature, bin) cells, whatever the number of rows.
"""

from __future__ import annotations

import heapq
import json
import random
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINS = 256
#: Cells of one job, the bound of what a task adds up at once, and cells of one of the tasks that find the splits.
MAX_CELLS = 1 << 22
SPLIT_CELLS = 1 << 16
CHECKPOINT_ROUNDS = 20
#: Most rows of one task's share of the training rows; shares below LEAST_ROWS are not worth a task.
TASK_ROWS = 100_000
LEAST_ROWS = 8_000
#: Gradients are summed in units of 2^-24.
UNIT = float(1 << 24)
LEAST_GAIN = 1e-6

# a block: the rows of one model, each column as the bytes of an array (bins and margin row by row)
_STATE = "model int, n int, key binary, bins binary, y binary, w binary, margin binary"
_STATE_ARROW = pa.schema([("model", pa.int32()), ("n", pa.int32()), *[(c, pa.binary()) for c in ("key", "bins", "y", "w", "margin")]])
#: Rows that a tree routes, and (row, feature) pairs that are counted, at a time: they stay in a core's cache.
ROUTE_ROWS = 1 << 14
COUNT_PAIRS = 1 << 15


@dataclass(frozen=True)
class Boost:
    """Parameters of one model; the defaults are those of a depth-wise booster."""

    rounds: int = 100
    depth: int = 6  # levels of splits; below 1: no bound
    rate: float = 0.1
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0
    subsample: float = 1.0
    colsample: float = 1.0
    num_leaves: int | None = None  # grow the best leaf first, up to so many
    min_child_weight: float = 1.0
    min_child_rows: int = 1
    seed: int = 42


@dataclass
class Tree:
    """Nodes as lists; ``left`` below 0 is a leaf.  Bins above 0 and up to ``cut`` go left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, missing_left: bool) -> tuple[int, int]:
        self.feature[node], self.cut[node], self.missing_left[node] = feature, cut, missing_left
        self.left[node], self.right[node] = len(self.left), len(self.left) + 1
        for name, empty in (("feature", -1), ("cut", 0), ("missing_left", False), ("left", -1), ("right", -1), ("value", 0.0)):
            getattr(self, name).extend([empty, empty])
        return self.left[node], self.right[node]

    def route(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of every row; ``bins`` holds a row a feature."""
        n = bins.shape[1]
        node = np.zeros(n, np.int64)
        feature, cut, left, right, missing = (np.array(a) for a in (self.feature, self.cut, self.left, self.right, self.missing_left))
        depth = [0] * len(left)
        for k in np.flatnonzero(left >= 0):  # parents come before their children
            depth[left[k]] = depth[right[k]] = depth[k] + 1
        # where each bin leads from each node; a leaf leads to itself
        bin_ = np.arange(BINS)
        goes = np.where(np.where(bin_ == 0, missing[:, None], bin_ <= cut[:, None]), left[:, None], right[:, None])
        goes = np.where(left[:, None] < 0, np.arange(len(left))[:, None], goes).reshape(-1)
        values, begin = bins.reshape(-1), np.maximum(feature, 0) * n
        for lo in range(0, n if max(depth) else 0, ROUTE_ROWS):
            rows = np.arange(lo, min(n, lo + ROUTE_ROWS))
            at = node[lo: lo + ROUTE_ROWS]
            for _ in range(max(depth)):
                at = goes[at * BINS + values[begin[at] + rows]]
            node[lo: lo + ROUTE_ROWS] = at
        return node


# ------------------------------------------------------------------ gradients

def probabilities(margin: np.ndarray) -> np.ndarray:
    """Class probabilities of margins: of the second class for one column, of each class for several."""
    if margin.shape[1] == 1:
        return 1.0 / (1.0 + np.exp(-margin))
    e = np.exp(margin - margin.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def gradients(margin: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted first and second derivatives per class, as fixed-point integers (whole numbers in doubles)."""
    p = probabilities(margin)
    if margin.shape[1] == 1:
        g, h = p - y[:, None], p * (1 - p)
    else:
        g, h = p.copy(), 2 * p * (1 - p)
        g[np.arange(len(y)), y] -= 1
    return np.rint(g * w[:, None] * UNIT), np.rint(np.maximum(h, 1e-16) * w[:, None] * UNIT)


def sampled(key: np.ndarray, round_: int, seed: int, share: float) -> np.ndarray:
    """Which rows a round uses: a fixed function of the row's key."""
    if share >= 1:
        return np.ones(len(key), bool)
    with np.errstate(over="ignore"):
        x = key.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (round_ + 1) + seed) & (2**64 - 1))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) < share * 2.0**53


# --------------------------------------------------------------------- splits

def shrink(g, l1):
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def leaf_value(g: float, h: float, p: Boost) -> float:
    return float(-p.rate * shrink(g, p.reg_alpha) / (h + p.reg_lambda)) if h + p.reg_lambda > 0 else 0.0


@dataclass
class Split:
    gain: float
    feature: int
    cut: int
    missing_left: bool
    left: tuple[float, float, int]  # g, h, rows
    right: tuple[float, float, int]


def best_splits(g: np.ndarray, h: np.ndarray, n: np.ndarray, sizes: list[int], allowed: np.ndarray, ps: list[Boost]) -> list[Split | None]:
    """The best split of each node from its sums (a row; the bins of the features side by side, ``sizes`` of them).

    Ties go to the smaller feature, then the smaller cut, then missing values right.
    ``allowed`` (a row a node) are the features that may divide it.
    """
    start = np.cumsum([0, *sizes[:-1]])
    # a cut leaves the feature's last bin on the right
    feature = np.repeat(np.arange(len(sizes)), [max(0, k - 2) for k in sizes])
    cut = np.concatenate([np.arange(1, max(1, k - 1)) for k in sizes])
    if not len(cut):
        return [None] * len(g)
    first, rows = np.argmax(allowed, axis=1), np.arange(len(g))
    missing = [a[:, start] for a in (g, h, n)]
    side, total = [], []
    for a, none in zip((g, h, n), missing):
        upto = np.cumsum(a, axis=1)
        total.append((upto[:, start + np.array(sizes) - 1] - upto[:, start] + none)[rows, first][:, None])
        side.append(upto[:, start[feature] + cut] - upto[:, start[feature]])
    l1, l2, least_h, least_n = (np.array(v, dtype=float)[:, None] for v in zip(*(
        (p.reg_alpha, p.reg_lambda, p.min_child_weight, max(1, p.min_child_rows)) for p in ps)))

    def scores(x, y):
        return shrink(x, l1) ** 2 / np.maximum(y + l2, 1e-300)

    whole = scores(total[0], total[1])
    best: list[Split | None] = [None] * len(g)
    for missing_left in (False, True) if any(m.any() for m in missing) else (False,):
        if missing_left:
            side = [s + m[:, feature] for s, m in zip(side, missing)]
        rest = [t - s for t, s in zip(total, side)]
        gain = scores(side[0], side[1]) + scores(rest[0], rest[1]) - whole
        fine = (np.minimum(side[1], rest[1]) >= least_h) & (np.minimum(side[2], rest[2]) >= least_n)
        gain[~(fine & allowed[:, feature])] = -np.inf
        for i, at in enumerate(np.argmax(gain, axis=1)):
            if gain[i, at] > LEAST_GAIN and (best[i] is None or gain[i, at] > best[i].gain):
                best[i] = Split(float(gain[i, at]), int(feature[at]), int(cut[at]), missing_left,
                                tuple(float(s[i, at]) for s in side), tuple(float(s[i, at]) for s in rest))
    return best


def best_split(g: np.ndarray, h: np.ndarray, n: np.ndarray, allowed: np.ndarray, p: Boost) -> Split | None:
    """The best split of one node from its (feature, bin) sums."""
    sizes = [g.shape[1]] * len(g)
    return best_splits(*(a.reshape(1, -1) for a in (g, h, n)), sizes, allowed[None, :], [p])[0]


class Growth:
    """A tree while it grows: evaluated nodes, their splits, and which nodes are still to be evaluated."""

    def __init__(self, p: Boost, allowed: np.ndarray):
        self.p, self.allowed = p, allowed
        self.tree = Tree()
        self.depth = [0]
        self.sums: list[tuple[float, float, float] | None] = [None]
        self.splits: dict[int, Split | None] = {}
        self.open = [0]

    def can_split(self, node: int) -> bool:
        s = self.sums[node]
        deep = self.p.depth > 0 and self.depth[node] >= self.p.depth
        return not deep and (s is None or s[1] >= 2 * self.p.min_child_weight and s[2] >= 2 * max(1, self.p.min_child_rows))

    def evaluated(self, node: int, total: tuple[float, float, float], split: Split | None) -> None:
        if self.sums[node] is None:
            self.sums[node] = total
        self.splits[node] = split if self.can_split(node) else None

    def _divide(self, node: int) -> None:
        s = self.splits[node]
        if self.tree.left[node] < 0:
            self.tree.split(node, s.feature, s.cut, s.missing_left)
            self.depth += [self.depth[node] + 1] * 2
            self.sums += [s.left, s.right]

    def advance(self) -> None:
        """Divide what the policy divides; ``open`` then lists the nodes that the next job evaluates."""
        if self.p.num_leaves is None:
            for node in list(self.splits):
                if self.splits[node] is not None:
                    self._divide(node)
            waiting = [k for k in range(len(self.depth)) if k not in self.splits and self.tree.left[k] < 0]
        else:
            waiting = [k for k in self._order()[1] if k not in self.splits]
        self.open = [k for k in waiting if self.can_split(k)]
        for k in waiting:
            if k not in self.open:
                self.splits[k] = None
        if waiting and not self.open and self.p.num_leaves is not None:
            self.advance()

    def _order(self) -> tuple[set[int], set[int]]:
        """Best leaf first over the known gains: the nodes divided and the leaves that are left."""
        divided: set[int] = set()
        leaves = {0}
        heap = [(-self.splits[0].gain, 0)] if self.splits.get(0) else []
        while heap and len(leaves) < max(2, self.p.num_leaves or 2):
            _, node = heapq.heappop(heap)
            self._divide(node)
            divided.add(node)
            leaves.remove(node)
            for child in (self.tree.left[node], self.tree.right[node]):
                leaves.add(child)
                if self.splits.get(child):
                    heapq.heappush(heap, (-self.splits[child].gain, child))
        return divided, leaves

    def finish(self) -> Tree:
        if self.p.num_leaves is not None:
            divided, _ = self._order()
            for node in range(len(self.depth)):
                if node not in divided:
                    self.tree.left[node] = -1
        for node in range(len(self.depth)):
            g, h, _ = self.sums[node] or (0.0, 0.0, 0.0)
            self.tree.value[node] = leaf_value(g, h, self.p)
        return self.tree


# ----------------------------------------------------------------------- jobs

def cut_points(rows: DataFrame, features: list[str], bins: int = BINS) -> list[list[float]]:
    """At most ``bins`` - 2 cut points per feature, by one aggregation over all rows."""
    share = ", ".join(repr(i / (bins - 1)) for i in range(1, bins - 1))
    value = [f"if(isnan(`{c}`), null, `{c}`)" for c in features]
    got = rows.selectExpr(*[f"percentile_approx({v}, array({share}), 10000) AS q{i}" for i, v in enumerate(value)],
                          *[f"max({v}) AS m{i}" for i, v in enumerate(value)]).first()
    # the largest value needs no cut: everything is on its left
    return [sorted({v for v in got[f"q{i}"] or [] if v < got[f"m{i}"]}) for i in range(len(features))]


@dataclass
class Block:
    """Training rows of one model."""

    model: int
    key: np.ndarray
    bins: np.ndarray  # a row a feature
    y: np.ndarray
    w: np.ndarray
    margin: np.ndarray

    def columns(self) -> list:
        return [self.model, len(self.key), *[a.tobytes() for a in (self.key, self.bins, self.y, self.w, self.margin)]]


def block_of(row) -> Block:
    """A row of the training state as arrays."""
    model, n, key, bins, y, w, margin = row
    return Block(model, np.frombuffer(key, np.int64), np.frombuffer(bins, np.uint8).reshape(-1, n), np.frombuffer(y, np.int32),
                 np.frombuffer(w), np.frombuffer(margin).reshape(n, -1))


def _as_batch(blocks: list[Block]) -> pa.RecordBatch:
    cols = zip(*[b.columns() for b in blocks])
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(cols, _STATE_ARROW)], schema=_STATE_ARROW)


def training_state(rows: DataFrame, features: list[str], model: Column, label: Column, weight: Column, key: Column,
                   cuts: list[list[float]], outputs: list[int], n_rows: int) -> DataFrame:
    """The training rows in blocks (model, n, key, bins, y, w, margin), binned, with margins 0."""
    narrow = rows.select(model.cast("int").alias("model"), key.cast("bigint").alias("key"), F.array(*features).alias("x"),
                         label.cast("int").alias("y"), weight.cast("double").alias("w"))

    def blocks(held: list[list[np.ndarray]]) -> Iterator[Block]:
        which, key, x, y, w = (np.concatenate(c) for c in zip(*held))
        bins = np.stack([np.where(np.isnan(x[:, j]), 0, 1 + np.searchsorted(np.array(c), x[:, j], side="left"))
                         for j, c in enumerate(cuts)]).astype(np.uint8)
        for m in np.unique(which):
            mine = np.flatnonzero(which == m)
            yield Block(int(m), key[mine], bins[:, mine], y[mine], w[mine], np.zeros((len(mine), outputs[m])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            if b.num_rows:
                x = b.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b.num_rows, -1)
                held.append([b.column(0).to_numpy(), b.column(1).to_numpy(), x, b.column(3).to_numpy(), b.column(4).to_numpy()])
                n += b.num_rows
            if n >= TASK_ROWS:
                yield _as_batch([*blocks(held)])
                held, n = [], 0
        if held:
            yield _as_batch([*blocks(held)])

    # every core has a share, unless shares would be small: a round's jobs are short
    cores = rows.sparkSession.sparkContext.defaultParallelism
    tasks = max(-(-n_rows // TASK_ROWS), min(cores, -(-n_rows // LEAST_ROWS)), 1)
    tasks = -(-tasks // cores) * cores if tasks > cores else tasks  # no last wave of a few tasks
    return narrow.repartition(tasks).mapInArrow(run, _STATE).checkpoint(eager=True)


def _trees_of(classes: list[int]) -> list[tuple[int, int]]:
    return [(m, k) for m, c in enumerate(classes) for k in range(c)]


def node_splits(state: RDD, growths: dict[tuple[int, int], Growth], nodes: list[tuple[int, int, int]], params: list[Boost],
                round_: int, sizes: list[int]) -> dict[int, tuple[tuple[float, float, float], Split | None]]:
    """(g, h, rows) and best split of each node of ``nodes`` (model, class, node), by its place; ``sizes`` are the features' bins."""
    plan: dict[int, dict[int, tuple[Tree, dict[int, int]]]] = {}
    for slot, (m, k, node) in enumerate(nodes):
        plan.setdefault(m, {}).setdefault(k, (growths[m, k].tree, {}))[1][node] = slot
    allowed = {(m, k): growths[m, k].allowed for m, k, _ in nodes}
    owners = [(m, k) for m, k, _ in nodes]
    n_nodes, width, size, start = len(nodes), sum(sizes), np.array(sizes), np.cumsum([0, *sizes[:-1]])
    wanted = {m: params[m] for m in plan}
    # a task finds the splits of consecutive places
    tasks = max(1, min(state.ctx.defaultParallelism, n_nodes * width // SPLIT_CELLS))
    some = -(-n_nodes // tasks)

    def sums_of_task(blocks: Iterator[Block]) -> Iterator[tuple]:
        sums = [np.zeros((n_nodes, width), t) for t in (float, float, np.int64)]
        for b in blocks:
            p = wanted.get(b.model)
            if p is None:
                continue
            use = sampled(b.key, round_, p.seed + b.model, p.subsample)
            if not use.any():
                continue
            g, h = gradients(b.margin, b.y, b.w)
            for k, (tree, slots) in plan[b.model].items():
                slot_of = np.full(len(tree.left), -1, np.int64)
                slot_of[list(slots)] = list(slots.values())
                slot = slot_of[tree.route(b.bins)]
                at = np.flatnonzero((slot >= 0) & use)
                if not len(at):
                    continue
                slot, gk, hk = slot[at], g[at, k], h[at, k]
                first, last = int(slot.min()), int(slot.max()) + 1
                slot -= first
                cols = np.flatnonzero(allowed[b.model, k])
                group = max(1, COUNT_PAIRS // len(at))
                for fs in (cols[i: i + group] for i in range(0, len(cols), group)):
                    upto = np.cumsum(size[fs])
                    wide = int(upto[-1])
                    begin = (upto - size[fs])[:, None]
                    cell = (slot * wide + begin + b.bins[fs].take(at, axis=1)).reshape(-1)
                    into = np.concatenate([np.arange(start[f], start[f] + size[f]) for f in fs])
                    for total, weight in zip(sums, (gk, hk, None)):
                        add = np.bincount(cell, None if weight is None else np.tile(weight, len(fs)), (last - first) * wide)
                        total[first:last, into] += add.reshape(last - first, wide)
        for task in range(tasks):
            part = slice(task * some, (task + 1) * some)
            used = np.flatnonzero(sums[2][part])
            if len(used):
                yield task, (used.astype(np.int32), *[a[part].reshape(-1)[used].astype(np.int64) for a in sums])

    def splits_of_task(parts: Iterator[tuple]) -> Iterator[tuple]:
        sums = task = None
        for task, (used, *values) in parts:
            if sums is None:
                sums = np.zeros((3, (min(n_nodes, (task + 1) * some) - task * some) * width), np.int64)
            for into, v in zip(sums, values):
                into[used] += v
        if sums is None:
            return
        sums = sums.reshape(3, -1, width)
        of_one = [(f, f + z) for f, z in zip(start, sizes)]
        found = np.flatnonzero(sums[2].any(axis=1))
        few = max(1, SPLIT_CELLS // width)
        for part in (found[i: i + few] for i in range(0, len(found), few)):
            g, h, n = (sums[c][part] / unit for c, unit in enumerate((UNIT, UNIT, 1.0)))
            slots = [int(i) + task * some for i in part]
            may = np.stack([allowed[owners[slot]] for slot in slots])
            best = best_splits(g, h, n, sizes, may, [wanted[owners[slot][0]] for slot in slots])
            for i, (slot, s) in enumerate(zip(slots, best)):
                lo, hi = of_one[int(np.argmax(may[i]))]
                total = tuple(float(a[i, lo:hi].sum()) for a in (g, h, n))
                yield slot, total, s and replace(s, right=tuple(t - x for t, x in zip(total, s.left)))

    got = state.mapPartitions(sums_of_task).partitionBy(tasks, int).mapPartitions(splits_of_task).collect()  # one a node
    return {slot: (total, split) for slot, total, split in got}


def updated(state: RDD, trees: dict[tuple[int, int], Tree]) -> RDD:
    """``state`` with the round's trees added to the margins."""
    plan: dict[int, list[tuple[int, Tree]]] = {}
    for (m, k), tree in trees.items():
        plan.setdefault(m, []).append((k, tree))

    def add(b: Block) -> Block:
        margin = b.margin.copy()
        for k, tree in plan.get(b.model, []):
            margin[:, k] += np.array(tree.value)[tree.route(b.bins)]
        return replace(b, margin=margin)

    return state.map(add)


# ---------------------------------------------------------------------- model

class Boosted:
    """Fitted models by name: ``classes`` of each, and the trees of each class with thresholds on feature values.

    A model of two classes has one margin, that of its second class.
    """

    def __init__(self, features: list[str], classes: dict[str, list[str]], nodes: dict[str, list[list[dict]]],
                 gains: dict[str, list[float]] | None = None):
        self.features, self.classes, self.nodes = features, classes, nodes
        self.gains = gains or {}

    def importances(self, model: str) -> list[float]:
        """Share of each feature in the gain of all splits of a model."""
        total = sum(self.gains[model])
        return [g / total if total else 0.0 for g in self.gains[model]]

    def save(self, spark, path: str) -> None:
        rows = [(m, k, r, json.dumps(t)) for m, per in self.nodes.items() for k, trees in enumerate(per) for r, t in enumerate(trees)]
        spark.createDataFrame(rows, "model string, class int, round int, tree string").write.mode("overwrite").parquet(f"{path}/trees")
        about = json.dumps({"features": self.features, "classes": self.classes, "gains": self.gains})
        spark.createDataFrame([(about,)], "about string").write.mode("overwrite").parquet(f"{path}/about")

    @classmethod
    def load(cls, spark, path: str) -> Boosted:
        about = json.loads(spark.read.parquet(f"{path}/about").first()[0])
        nodes: dict[str, list[list[dict]]] = {m: [] for m in about["classes"]}
        for r in spark.read.parquet(f"{path}/trees").orderBy("model", "class", "round").collect():  # bounded by the model's size
            per = nodes[r["model"]]
            while len(per) <= r["class"]:
                per.append([])
            per[r["class"]].append(json.loads(r["tree"]))
        return cls(about["features"], about["classes"], nodes, about["gains"])

    def _packed(self) -> dict[str, list[dict[str, np.ndarray]]]:
        """Per model and class, the nodes of all trees in one set of arrays."""
        out: dict[str, list[dict[str, np.ndarray]]] = {}
        for m, per in self.nodes.items():
            for trees in per:
                base = np.cumsum([0] + [len(t["left"]) for t in trees])
                cat = {c: np.concatenate([np.array(t[c]) for t in trees]) if trees else np.empty(0)
                       for c in ("feature", "threshold", "missing_left", "left", "right", "value")}
                lift = np.repeat(base[:-1], np.diff(base))
                leaf = cat["left"] < 0
                # a leaf leads to itself, so all rows take the same number of steps
                for c in ("left", "right"):
                    cat[c] = np.where(leaf, np.arange(len(leaf)), cat[c] + lift).astype(np.int64)
                cat["feature"] = np.maximum(cat["feature"], 0).astype(np.int64)
                cat["roots"] = base[:-1].astype(np.int64)
                cat["leaf"] = leaf
                out.setdefault(m, []).append(cat)
        return out

    def score(self, rows: DataFrame, routes: dict[str, Column | str]) -> DataFrame:
        """``rows`` with, per route, a struct (label, confidence, probability array) by the model that the route names.

        All models are evaluated in one pass over the rows; a route whose model
        is null or unknown gives a null struct.
        """
        names = list(routes)
        keep = [F.col(f"`{c}`") for c in rows.columns]
        route = F.array(*[c if isinstance(c, Column) else F.lit(c) for c in routes.values()])
        work = rows.select(F.struct(*keep).alias("_row"), F.array(*[F.col(f"`{c}`").cast("double") for c in self.features]).alias("_x"),
                           route.alias("_routes"))
        shared = rows.sparkSession.sparkContext.broadcast((self._packed(), self.classes))  # bounded by the models' sizes
        result = T.StructType().add("label", "string").add("confidence", "double").add("probability", T.ArrayType(T.DoubleType()))
        schema = T.StructType(work.select("_row").schema.fields).add("_scores", T.ArrayType(result))

        def margins(packed, x):
            out = np.zeros((len(x), len(packed)))
            for k, t in enumerate(packed):
                for lo in range(0, len(x), 4096):
                    part = x[lo: lo + 4096]
                    node = np.repeat(t["roots"][None, :], len(part), axis=0)
                    at = np.arange(len(part))[:, None]
                    while node.size and not t["leaf"][node].all():
                        v = part[at, t["feature"][node]]
                        go = np.where(np.isnan(v), t["missing_left"][node].astype(bool), v <= t["threshold"][node])
                        node = np.where(go, t["left"][node], t["right"][node])
                    out[lo: lo + 4096, k] = t["value"][node].sum(axis=1)
            return out

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            packed, classes = shared.value
            for b in batches:
                if not b.num_rows:
                    continue
                x = b.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b.num_rows, -1)
                routed = np.array(b.column(2).to_pylist(), dtype=object).reshape(b.num_rows, len(names))
                scores: list[list] = [[None] * len(names) for _ in range(b.num_rows)]
                for j in range(len(names)):
                    for m in {r for r in routed[:, j] if r in packed}:
                        mine = np.flatnonzero(routed[:, j] == m)
                        p = probabilities(margins(packed[m], x[mine]))
                        p = np.concatenate([1 - p, p], axis=1) if p.shape[1] == 1 else p
                        for i, q in zip(mine, p):
                            top = int(q.argmax())
                            scores[i][j] = {"label": classes[m][top], "confidence": float(q[top]), "probability": q.tolist()}
                kind = pa.list_(pa.struct([("label", pa.string()), ("confidence", pa.float64()), ("probability", pa.list_(pa.float64()))]))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, kind)], names=["_row", "_scores"])

        scored = work.mapInArrow(run, schema)
        return scored.select(*[F.col(f"_row.`{c}`") for c in rows.columns], *[F.col("_scores")[j].alias(n) for j, n in enumerate(names)])


def fit(rows: DataFrame, features: list[str], label: Column, params: Boost | dict[str, Boost], model: Column | None = None,
        classes: list[str] | dict[str, list[str]] | None = None, weight: Column | None = None, key: Column | None = None,
        bins: int = BINS) -> Boosted:
    """Fit one model per name in ``params`` (or one named ``model``) on the rows that ``model`` gives it.

    ``label`` is a class as a string; ``classes`` lists them (by default all
    labels of a model's rows, in alphabetical order).  Rows whose label or model is null
    or not listed take no part.  Null and NaN features are missing values.
    ``key`` decides the row samples (default: a hash of the features and label).
    A model without rows, or with one class, has no trees.
    """
    params = params if isinstance(params, dict) else {"model": params}
    names = list(params)
    work = rows.select((F.lit(names[0]) if model is None else model.cast("string")).alias("_model"), label.cast("string").alias("_label"),
                       (F.lit(1.0) if weight is None else F.coalesce(weight.cast("double"), F.lit(0.0))).alias("_w"),
                       *([] if key is None else [key.cast("bigint").alias("_key")]),
                       *[F.col(f"`{c}`").cast("double").alias(f"_f{i}") for i, c in enumerate(features)])
    cols = [f"_f{i}" for i in range(len(features))]
    if key is None:
        work = work.withColumn("_key", F.xxhash64("_label", *cols))
    work = work.filter(F.col("_model").isin(names) & F.col("_label").isNotNull())
    found: dict[str, list[str]] = {m: [] for m in names}
    n_rows = 0
    for r in work.groupBy("_model", "_label").count().orderBy("_model", "_label").collect():  # one row a class
        found[r["_model"]].append(r["_label"])
        n_rows += r["count"]
    if isinstance(classes, list):
        found = {m: list(classes) for m in names}
    elif classes is not None:
        found = {m: list(classes.get(m, found[m])) for m in names}
    outputs = [0 if len(found[m]) < 2 else 1 if len(found[m]) == 2 else len(found[m]) for m in names]
    ps = [params[m] for m in names]
    cuts = cut_points(work, cols, bins) if n_rows else [[] for _ in cols]
    trees: dict[tuple[int, int], list[Tree]] = {mk: [] for mk in _trees_of(outputs)}
    gains = {m: [0.0] * len(cols) for m in names}
    if n_rows and trees:
        places = F.create_map(*[F.lit(x) for m, name in enumerate(names) if outputs[m] for k, c in enumerate(found[name])
                                for x in (f"{name}\x00{c}", k)])
        at = F.create_map(*[F.lit(x) for m, name in enumerate(names) for x in (name, m)])
        y = places[F.concat("_model", F.lit("\x00"), "_label")]
        state = training_state(work.filter(y.isNotNull()), cols, at[F.col("_model")], y, F.col("_w"), F.col("_key"), cuts, outputs, n_rows)
        _boost(state, trees, ps, cuts, gains, names)
    nodes: dict[str, list[list[dict]]] = {m: [] for m in names}
    for (m, _), grown in trees.items():
        nodes[names[m]].append([_named(t, cuts) for t in grown])
    return Boosted(list(features), found, nodes, gains)


def _named(t: Tree, cuts: list[list[float]]) -> dict:
    inner = [x >= 0 for x in t.left]
    threshold = [cuts[f][c - 1] if i else 0.0 for i, f, c in zip(inner, t.feature, t.cut)]
    return {"feature": t.feature, "threshold": threshold, "missing_left": [bool(x) for x in t.missing_left], "left": t.left,
            "right": t.right, "value": t.value}


def _boost(state: DataFrame, trees: dict, ps: list[Boost], cuts: list, gains: dict, names: list[str]) -> None:
    n_features = len(cuts)
    sizes = [2 + len(c) for c in cuts]  # no more than the values need
    rows = state.rdd.map(block_of).persist(StorageLevel.MEMORY_AND_DISK)
    held = [rows]
    finished: set[int] = set()
    for round_ in range(max(p.rounds for p in ps)):
        growths = {}
        for m, k in trees:
            if round_ < ps[m].rounds and m not in finished:
                rnd = random.Random(f"{ps[m].seed}-{m}-{k}-{round_}")
                chosen = rnd.sample(range(n_features), max(1, round(ps[m].colsample * n_features)))
                growths[m, k] = Growth(ps[m], np.isin(np.arange(n_features), chosen))
        while todo := [(m, k, node) for (m, k), g in growths.items() for node in g.open]:
            room = max(1, MAX_CELLS // sum(sizes))
            for lo in range(0, len(todo), room):
                part = todo[lo: lo + room]
                found = node_splits(rows, growths, part, ps, round_, sizes)
                for slot, (m, k, node) in enumerate(part):
                    growths[m, k].evaluated(node, *found.get(slot, ((0.0, 0.0, 0.0), None)))
            for g in growths.values():
                if g.open:
                    g.advance()
        if not growths:
            break
        done = {mk: g.finish() for mk, g in growths.items()}
        finished |= {m for m, _ in done} - {m for (m, _), t in done.items() if t.left[0] >= 0}
        for mk, t in done.items():
            trees[mk].append(t)
            for node, s in growths[mk].splits.items():
                if s is not None and t.left[node] >= 0:
                    gains[names[mk[0]]][s.feature] += s.gain
        rows = updated(rows, done).persist(StorageLevel.MEMORY_AND_DISK)
        held.append(rows)
        if (round_ + 1) % CHECKPOINT_ROUNDS == 0:
            rows.checkpoint()
            rows.count()
        # the newest two hold what the next jobs read; older ones have served
        while len(held) > 2:
            held.pop(0).unpersist()
    for old in held:
        old.unpersist()
