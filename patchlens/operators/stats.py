"""Feature weighting ("attention"), scaling and univariate statistics.

Plan shape:
* all per-column moments come from one aggregation (one pass, partial
  aggregation per task), then ``stack`` turns the single wide row into a
  long (position, feature, ...) table of one row per feature;
* mutual information bins every column in one projection, unpivots once
  and counts (feature, x_bin, y_bin) cells in one group-by;
* quartile edges are exact but distributed (``exact_quantiles``): values are
  collapsed to (value, count), ranked by bucketed prefix sums, and only the
  few rows at the wanted ranks reach the driver;
* fitted constants (means, edges, weights) are bounded by the number of
  features and are applied as literals, like an MLlib model's ``transform``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.ml.feature import Bucketizer

from patchlens import config

EPS = config.EPS


def _stack(df: DataFrame, cols: list[str], value_exprs: dict[str, str]) -> DataFrame:
    """One wide row -> one row per feature: (position, feature, <stat>...)."""
    names = list(value_exprs)
    parts = []
    for i, c in enumerate(cols):
        parts.append(f"{i}, '{c}', " + ", ".join(value_exprs[n].format(i=i) for n in names))
    expr = f"stack({len(cols)}, {', '.join(parts)}) AS (position, feature, {', '.join(names)})"
    return df.selectExpr(expr)


def _normalise(long: DataFrame, col: str, out: str = "weight") -> DataFrame:
    """w / (sum(w) + 1e-8) over the per-feature table (a handful of rows)."""
    return long.withColumn(out, F.col(col) / (F.sum(col).over(Window.partitionBy()) + EPS))


# ------------------------------------------------------------ moments

def fit_moments(df: DataFrame, cols: list[str]) -> dict[str, dict[str, float]]:
    """mean, pop std, min, max per column from one aggregation."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    r = df.agg(*aggs).first()
    return {c: {"mean": r[f"m{i}"], "std": r[f"s{i}"], "min": r[f"lo{i}"], "max": r[f"hi{i}"]} for i, c in enumerate(cols)}


def standard_scale(df: DataFrame, cols: list[str], keep: list[str] | None = None, fitted=None) -> DataFrame:
    """(x - mean) / pop std; a zero std divides by 1 (constant column -> 0)."""
    m = fitted or fit_moments(df, cols)
    sel = [F.col(k) for k in (keep or [])]
    for c in cols:
        s = m[c]["std"] or 0.0
        sel.append(((F.col(c).cast("double") - F.lit(m[c]["mean"])) / F.lit(s if s != 0 else 1.0)).alias(c))
    return df.select(*sel)


def minmax_scale(df: DataFrame, cols: list[str], keep: list[str] | None = None, fitted=None) -> DataFrame:
    """(x - min) / (max - min); a constant column maps to 0."""
    m = fitted or fit_moments(df, cols)
    sel = [F.col(k) for k in (keep or [])]
    for c in cols:
        lo, hi = m[c]["min"], m[c]["max"]
        rng = (hi - lo) if hi is not None and lo is not None else 0.0
        sel.append(((F.col(c).cast("double") - F.lit(lo)) / F.lit(rng if rng != 0 else 1.0)).alias(c))
    return df.select(*sel)


def minmax_inverse(df: DataFrame, col: str, lo: float, hi: float, out: str | None = None) -> DataFrame:
    rng = (hi - lo) if hi != lo else 1.0
    return df.withColumn(out or col, F.col(col) * F.lit(rng) + F.lit(lo))


# ---------------------------------------------------------- weights

def variance_weights(df: DataFrame, cols: list[str]) -> DataFrame:
    """Population variance per column / (sum + 1e-8)."""
    agg = df.agg(*[F.var_pop(F.col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(cols)])
    long = _stack(agg, cols, {"variance": "v{i}"})
    return _normalise(long, "variance")


def _corr_agg(df: DataFrame, cols: list[str], y: str) -> DataFrame:
    """One aggregation: std of y, and covariance with y and std of every column."""
    yy = F.col(y).cast("double")
    aggs = [F.stddev_pop(yy).alias("sy")]
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.covar_pop(x, yy).alias(f"cv{i}"), F.stddev_pop(x).alias(f"sx{i}")]
    return df.agg(*aggs)


def correlation_weights(df: DataFrame, cols: list[str], y: str, moments: DataFrame | None = None) -> DataFrame:
    """|Pearson r| per column (constant column -> 0) / (sum + 1e-8).

    ``covar_pop / (stddev_pop * stddev_pop)`` with ``try_divide``: Spark's
    ``corr`` raises DIVIDE_BY_ZERO on a constant column under ANSI mode.
    """
    agg = moments if moments is not None else _corr_agg(df, cols, y)
    long = _stack(agg, cols, {"corr": "abs(try_divide(cv{i}, sx{i} * sy))"})
    long = long.withColumn("corr", F.coalesce(F.col("corr"), F.lit(0.0)))
    return _normalise(long, "corr")


def value_counts(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """Distinct (by..., value) with their count: a partial aggregation."""
    by = by or []
    return df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("cnt"))


BUCKET_ROWS = 100_000


def bucket_bounds(counted: DataFrame, value: str, n_buckets: int | None = None) -> list[float]:
    """Bounds of buckets of about BUCKET_ROWS rows each, for a Bucketizer.

    Bounds are approximate quantiles; only the balance of the work depends on them.
    """
    n_buckets = n_buckets or max(16, -(-counted.count() // BUCKET_ROWS))
    qs = [i / n_buckets for i in range(1, n_buckets)]
    bounds = counted.agg(F.percentile_approx(value, qs, max(10_000, 4 * n_buckets)).alias("b")).first()["b"] or []
    splits = [-math.inf] + sorted({float(b) for b in bounds if b is not None and math.isfinite(b)}) + [math.inf]
    return splits if len(splits) > 2 else [-math.inf, 0.0, math.inf]


def value_ranks(df: DataFrame, value: str, by: list[str] | None = None, n_buckets: int | None = None,
                counted: DataFrame | None = None) -> DataFrame:
    """Distinct values with their count and the number of smaller values.

    Output (by..., value, cnt, below).  Exact; work is spread by approximate
    quantile buckets, whose number follows from the number of distinct values.
    ``counted`` may pass a precomputed (cached) ``value_counts`` table.
    """
    by = by or []
    c = counted if counted is not None else value_counts(df, value, by)
    c = Bucketizer(splits=bucket_bounds(c, value, n_buckets), inputCol=value, outputCol="_b", handleInvalid="keep").transform(
        c.withColumn(value, F.col(value).cast("double")))
    bt = c.groupBy(*by, "_b").agg(F.sum("cnt").alias("_bn"))
    bt = bt.withColumn("_boff", F.coalesce(F.sum("_bn").over(
        Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_bn")
    c = c.withColumn("_inb", F.coalesce(F.sum("cnt").over(
        Window.partitionBy(*by, "_b").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    j = c.join(bt, [*by, "_b"], "inner")
    return j.select(*by, value, "cnt", (F.col("_boff") + F.col("_inb")).alias("below"))


#: Rank error of the approximate quantiles that propose bounds is one part in so many.
BRACKET_ACCURACY = 10_000
#: A bracket of at most so many rows is read out; a larger one is narrowed first.
BRACKET_ROWS = 50_000


class _Bracket:
    """The values of a column between ``lo`` and ``hi`` (None: no bound), both left out, that hold the row of rank ``k``.

    ``below`` rows come before them, ``inside`` rows are among them.
    """

    def __init__(self, col: str, x, k: int, n: int):
        self.col, self.x, self.k = col, x, k
        self.lo = self.hi = self.value = None
        self.below, self.inside = 0, n

    def holds(self):
        cond = self.x.isNotNull()
        if self.lo is not None:
            cond = cond & (self.x > F.lit(self.lo))
        return cond if self.hi is None else cond & (self.x < F.lit(self.hi))

    def wanted(self) -> list[float]:
        """Ranks, as shares, at which to ask for values around the wanted one."""
        room = 3.0 / BRACKET_ACCURACY
        at = (self.k - self.below + 0.5) / self.inside
        return [min(1.0, max(0.0, at + e)) for e in (-room, room)]

    def test(self, value: float, smaller: int, upto: int) -> None:
        """Take up that ``smaller`` rows are less than ``value`` and ``upto`` rows no greater."""
        if self.value is not None:
            return
        if self.k < smaller:
            if smaller - self.below < self.inside:
                self.hi, self.inside = value, smaller - self.below
        elif self.k < upto:
            self.value = value
        elif upto > self.below:
            self.lo, self.below, self.inside = value, upto, self.below + self.inside - upto


def _narrow(df: DataFrame, brackets: list[_Bracket]) -> None:
    """One scan proposes two values around each wanted rank, one counts the rows up to them.

    Brackets of the same rows share one sketch, and equal values of a column one count.
    """
    same: dict[tuple, list[_Bracket]] = {}
    for b in brackets:
        same.setdefault((b.col, b.lo, b.hi), []).append(b)
    groups = list(same.values())
    got = df.agg(*[F.percentile_approx(F.when(g[0].holds(), g[0].x), [q for b in g for q in b.wanted()], BRACKET_ACCURACY).alias(f"g{m}")
                   for m, g in enumerate(groups)]).first()
    tests = [(b, v) for m, g in enumerate(groups) for i, b in enumerate(g) for v in sorted(set(got[f"g{m}"][2 * i: 2 * i + 2]))]
    values = {(b.col, repr(v)): (b.x, v) for b, v in tests}
    at = {key: m for m, key in enumerate(values)}
    counts = df.agg(*[c for m, (x, v) in enumerate(values.values())
                      for c in (F.count_if(x < F.lit(v)).alias(f"s{m}"), F.count_if(x <= F.lit(v)).alias(f"u{m}"))]).first()
    for b, v in tests:
        m = at[b.col, repr(v)]
        b.test(v, counts[f"s{m}"], counts[f"u{m}"])


def exact_quantiles(df: DataFrame, cols: list[str], qs: list[float]) -> dict[str, list[float]]:
    """Linear-interpolated quantiles (NumPy default) of each column, exactly, by selection.

    A bracket of values is kept around every wanted rank.  A scan for all
    columns proposes values near the ranks (approximate quantiles), the next
    counts the rows below and up to them, which shrinks the brackets to a few
    parts in BRACKET_ACCURACY or settles the value; brackets that are still large
    are narrowed again.  A last scan reads out the rows inside: only those are
    shuffled, never a column's distinct values.  Proposed values lie inside
    their bracket and leave it, so it shrinks each time, ties or not.  A column without
    values has None for every quantile.  Nulls are left out; NaN is the largest value.
    """
    x = {c: F.col(c).cast("double") for c in cols}
    total = df.agg(*[F.count(x[c]).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    n = {c: total[f"n{i}"] for i, c in enumerate(cols)}
    ranks = {(c, k) for c in cols if n[c] for q in qs for k in (math.floor((n[c] - 1) * q), math.ceil((n[c] - 1) * q))}
    brackets = {(c, k): _Bracket(c, x[c], k, n[c]) for c, k in sorted(ranks)}
    while large := [b for b in brackets.values() if b.value is None and b.inside > BRACKET_ROWS]:
        _narrow(df, large)
    rest = [b for b in brackets.values() if b.value is None]
    if rest:
        cells = F.array(*[F.when(b.holds(), F.struct(F.lit(m).alias("m"), b.x.alias("v"))) for m, b in enumerate(rest)])
        inside = df.select(F.explode(F.filter(cells, lambda s: s.isNotNull())).alias("s")).groupBy("s.m", "s.v").count()
        found: dict[int, list[tuple[float, int]]] = {}
        for r in inside.collect():  # at most BRACKET_ROWS rows a bracket
            found.setdefault(r["m"], []).append((r["v"], r["count"]))
        for m, b in enumerate(rest):
            at = b.below
            for v, count in sorted(found[m], key=lambda t: (math.isnan(t[0]), t[0])):
                at += count
                if b.value is None and b.k < at:
                    b.value = v
    out = {}
    for c in cols:
        out[c] = [] if n[c] else [None] * len(qs)
        for q in qs if n[c] else []:
            h = (n[c] - 1) * q
            lo, hi = brackets[c, math.floor(h)].value, brackets[c, math.ceil(h)].value
            out[c].append(lo if lo == hi else lo + (h - math.floor(h)) * (hi - lo))
    return out


def _bin_expr(c: str, edges: list[float]):
    """Number of edges <= x (``np.digitize`` with increasing edges)."""
    x = F.col(c).cast("double")
    e = F.lit(0)
    for v in edges:
        if v is not None:
            e = e + (x >= F.lit(v)).cast("int")
    return e


def approx_quantiles(df: DataFrame, cols: list[str], qs: list[float], accuracy: int = 10000) -> dict[str, list[float]]:
    """Quantiles of every column from one ``percentile_approx`` aggregation (bounded memory)."""
    r = df.agg(*[F.percentile_approx(F.col(c).cast("double"), qs, accuracy).alias(f"q{i}") for i, c in enumerate(cols)]).first()
    return {c: list(r[f"q{i}"]) for i, c in enumerate(cols)}


def mutual_information_weights(df: DataFrame, cols: list[str], y: str, edges=None, exact: bool = True) -> DataFrame:
    """Quartile-binned mutual information per column, normalised.

    Bins: number of quartile edges <= value, for each column and for y.
    Joint 4x4 histogram + 1e-8 per cell (absent cells included),
    MI = sum p * ln(p / (px * py + 1e-8)).  A column (or y) without values
    has no bins and says nothing: its MI is 0.
    """
    qs = [0.25, 0.5, 0.75]
    edges = edges or (exact_quantiles(df, cols + [y], qs) if exact else approx_quantiles(df, cols + [y], qs))
    binned = df.select(*[_bin_expr(c, edges[c]).alias(f"b{i}") for i, c in enumerate(cols)],
                       _bin_expr(y, edges[y]).alias("yb"))
    stack = ", ".join(f"{i}, '{c}', b{i}" for i, c in enumerate(cols))
    long = binned.selectExpr("yb", f"stack({len(cols)}, {stack}) AS (position, feature, xb)")
    cells = long.groupBy("position", "feature", "xb", "yb").agg(F.count(F.lit(1)).alias("n"))
    # the full 4x4 grid per feature (absent cells carry the 1e-8 smoothing too),
    # generated from the features present in the (small) cell table
    grid = (cells.select("position", "feature").distinct()
            .withColumn("xb", F.explode(F.sequence(F.lit(0), F.lit(3))))
            .withColumn("yb", F.explode(F.sequence(F.lit(0), F.lit(3)))))
    g = grid.join(cells, ["position", "feature", "xb", "yb"], "left").withColumn("n", F.coalesce(F.col("n"), F.lit(0)))
    tot = Window.partitionBy("position")
    g = g.withColumn("p", (F.col("n") + EPS) / (F.sum("n").over(tot) + 16 * EPS))
    g = g.withColumn("px", F.sum("p").over(Window.partitionBy("position", "xb")))
    g = g.withColumn("py", F.sum("p").over(Window.partitionBy("position", "yb")))
    mi = g.groupBy("position", "feature").agg(
        F.sum(F.col("p") * F.log(F.col("p") / (F.col("px") * F.col("py") + EPS))).alias("mi"))
    silent = [c for c in cols if None in edges[c] or None in edges[y]]
    mi = mi.withColumn("mi", F.when(F.col("feature").isin(silent), F.lit(0.0)).otherwise(F.col("mi")))
    return _normalise(mi, "mi")


def attention_weights(df: DataFrame, cols: list[str], y: str, standardized: bool = True) -> DataFrame:
    """softmax(0.3 * variance + 0.4 * correlation + 0.3 * MI weights).

    With ``standardized`` the variance component is taken on standardised
    columns (as in the analysed tool): 1 for a varying column, 0 for a
    constant one; correlation and quartile bins are invariant to it.
    """
    a, b, c = config.ATTENTION_MIX
    moments = _corr_agg(df, cols, y)  # one pass feeds both the variance and the correlation part
    if standardized:
        v = _normalise(_stack(moments, cols, {"variance": "CASE WHEN sx{i} > 0 THEN 1.0D ELSE 0.0D END"}), "variance")
    else:
        v = variance_weights(df, cols)
    r = correlation_weights(df, cols, y, moments=moments)
    m = mutual_information_weights(df, cols, y)
    j = (v.select("position", "feature", F.col("weight").alias("wv"))
         .join(r.select("position", F.col("weight").alias("wc")), "position")
         .join(m.select("position", F.col("weight").alias("wm")), "position"))
    z = F.lit(a) * F.col("wv") + F.lit(b) * F.col("wc") + F.lit(c) * F.col("wm")
    j = j.withColumn("score", z)
    return j.withColumn("weight", F.exp("score") / F.sum(F.exp("score")).over(Window.partitionBy())).select(
        "position", "feature", "wv", "wc", "wm", "weight")


def apply_attention(df: DataFrame, cols: list[str], weights: dict[str, float], keep: list[str] | None = None) -> DataFrame:
    """x * (0.9 * w + 0.1) per column (weights fitted beforehand)."""
    p, q = config.ATTENTION_APPLY
    sel = [F.col(k) for k in (keep or [])]
    sel += [(F.col(c) * F.lit(p * weights[c] + q)).alias(c) for c in cols]
    return df.select(*sel)


def attention_stats(weights: DataFrame, top: int = 5) -> DataFrame:
    """mean, pop std, entropy and the sum of the ``top`` largest weights."""
    w = Window.orderBy(F.desc("weight"), F.asc("position"))  # per-feature table: a handful of rows
    r = weights.withColumn("_rn", F.row_number().over(w))
    return r.agg(
        F.avg("weight").alias("mean"),
        F.stddev_pop("weight").alias("std"),
        (-F.sum(F.col("weight") * F.log(F.col("weight") + EPS))).alias("entropy"),
        F.sum(F.when(F.col("_rn") <= top, F.col("weight")).otherwise(0.0)).alias("concentration"),
    )


def top_features(weights: DataFrame, k: int = 10) -> DataFrame:
    """Largest weights first; ties keep input order."""
    return weights.orderBy(F.desc("weight"), F.asc("position")).limit(k)


def anova_f(long: DataFrame, feature: str, value: str, label: str) -> DataFrame:
    """One-way ANOVA F per feature: (SSB / (k - 1)) / (SSW / (n - k)).

    Input is long (feature, value, label); two grouped aggregations, both
    partial, so the wide input never shuffles.
    """
    g = long.groupBy(feature, label).agg(
        F.count(value).alias("ng"), F.sum(F.col(value).cast("double")).alias("sg"),
        F.sum(F.col(value).cast("double") ** 2).alias("qg"))
    f = g.groupBy(feature).agg(
        F.sum("ng").alias("n"), F.count(F.lit(1)).alias("k"), F.sum("sg").alias("s"),
        F.sum(F.col("sg") ** 2 / F.col("ng")).alias("sum_sg2_ng"), F.sum("qg").alias("q"))
    ssb = F.col("sum_sg2_ng") - F.col("s") ** 2 / F.col("n")
    ssw = F.col("q") - F.col("sum_sg2_ng")
    return f.select(feature, "n", "k", (F.try_divide(ssb / (F.col("k") - 1), ssw / (F.col("n") - F.col("k")))).alias("f_stat"))
