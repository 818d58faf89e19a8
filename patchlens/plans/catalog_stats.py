"""Feature weighting, scaling and univariate statistics.

Binding: ``lineitem`` numeric columns (quantity, discount, tax, line number
and a constant bias column) against ``l_extendedprice``; ANOVA and vector
statistics on ``embeddings`` (64 floats, label 0-9).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from patchlens.functions import rowstats as RS
from patchlens.operators import stats as ST
from patchlens.plans.registry import query
from patchlens.sources.tables import table

COLS = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "bias"]
Y = "l_extendedprice"
KEYS = ["l_orderkey", "l_linenumber"]


def li_frame(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey"), F.col("l_linenumber").alias("line"),
        *[F.col(c).cast("double").alias(c) for c in COLS[:-1]], F.lit(1.0).alias("bias"), F.col(Y))


# DuckDB source with the same columns
LI_SQL = ("(SELECT l_orderkey, l_linenumber AS line, CAST(l_quantity AS DOUBLE) AS l_quantity, "
          "CAST(l_discount AS DOUBLE) AS l_discount, CAST(l_tax AS DOUBLE) AS l_tax, "
          "CAST(l_linenumber AS DOUBLE) AS l_linenumber, CAST(1.0 AS DOUBLE) AS bias, l_extendedprice FROM lineitem)")


def _long_sql(src: str, exprs: list[str], names=("v",)) -> str:
    """UNION ALL of (position, feature, <expr>) rows, one per column."""
    parts = []
    for i, c in enumerate(COLS):
        vals = ", ".join(f"{e.format(i=i, c=c)} AS {n}" for e, n in zip(exprs, names))
        parts.append(f"SELECT {i} AS position, '{c}' AS feature, {vals} FROM {src}")
    return "(" + " UNION ALL ".join(parts) + ")"


def _norm_sql(col: str) -> str:
    return f"{col} / (sum({col}) OVER () + 1e-8)"


VAR_SQL = f"""(SELECT position, feature, variance, {_norm_sql('variance')} AS weight FROM
  {_long_sql(f"(SELECT {', '.join(f'var_pop({c}) AS v{i}' for i, c in enumerate(COLS))} FROM {LI_SQL})", ['v{i}'], ['variance'])})"""

CORR_SQL = f"""(SELECT position, feature, corr, {_norm_sql('corr')} AS weight FROM
  {_long_sql(f"(SELECT stddev_pop({Y}) AS sy, {', '.join(f'covar_pop({c}, {Y}) AS cv{i}, stddev_pop({c}) AS sx{i}' for i, c in enumerate(COLS))} FROM {LI_SQL})",
             ['coalesce(abs(cv{i} / nullif(sx{i} * sy, 0)), 0)'], ['corr'])})"""


def _bin_sql(c: str, q: str) -> str:
    return f"(CAST({c} >= {q}[1] AS INTEGER) + CAST({c} >= {q}[2] AS INTEGER) + CAST({c} >= {q}[3] AS INTEGER))"


_Q = "[0.25, 0.5, 0.75]"
MI_SQL = f"""(WITH e AS (SELECT {', '.join(f'quantile_cont({c}, {_Q}) AS q{i}' for i, c in enumerate(COLS))},
                        quantile_cont({Y}, {_Q}) AS qy FROM {LI_SQL}),
  b AS (SELECT {', '.join(_bin_sql(c, f'q{i}') + f' AS b{i}' for i, c in enumerate(COLS))}, {_bin_sql(Y, 'qy')} AS yb
        FROM {LI_SQL}, e),
  lg AS ({' UNION ALL '.join(f"SELECT {i} AS position, '{c}' AS feature, b{i} AS xb, yb FROM b" for i, c in enumerate(COLS))}),
  cells AS (SELECT position, xb, yb, count(*) AS n FROM lg GROUP BY position, xb, yb),
  grid AS (SELECT f.position, f.feature, x.xb, y.yb FROM (SELECT DISTINCT position, feature FROM lg) f,
           (SELECT range AS xb FROM range(4)) x, (SELECT range AS yb FROM range(4)) y),
  g AS (SELECT grid.*, coalesce(cells.n, 0) AS n FROM grid LEFT JOIN cells USING (position, xb, yb)),
  p AS (SELECT *, (n + 1e-8) / (sum(n) OVER (PARTITION BY position) + 16 * 1e-8) AS p FROM g),
  m AS (SELECT *, sum(p) OVER (PARTITION BY position, xb) AS px, sum(p) OVER (PARTITION BY position, yb) AS py FROM p),
  mi AS (SELECT position, feature, sum(p * ln(p / (px * py + 1e-8))) AS mi FROM m GROUP BY position, feature)
  SELECT position, feature, mi, {_norm_sql('mi')} AS weight FROM mi)"""

# variance of the standardised columns, computed as such: standardise, then var_pop
STD_SQL = f"""(SELECT {', '.join(f'CASE WHEN s{i} = 0 THEN {c} - m{i} ELSE ({c} - m{i}) / s{i} END AS z{i}' for i, c in enumerate(COLS))}
  FROM {LI_SQL}, (SELECT {', '.join(f'avg({c}) AS m{i}, stddev_pop({c}) AS s{i}' for i, c in enumerate(COLS))} FROM {LI_SQL}))"""
VARIND_SQL = f"""(SELECT position, feature, {_norm_sql('ind')} AS weight FROM
  {_long_sql(f"(SELECT {', '.join(f'var_pop(z{i}) AS v{i}' for i, c in enumerate(COLS))} FROM {STD_SQL})", ['v{i}'], ['ind'])})"""

ATT_SQL = f"""(SELECT position, feature, wv, wc, wm, exp(score) / sum(exp(score)) OVER () AS weight FROM (
  SELECT v.position, v.feature, v.weight AS wv, c.weight AS wc, m.weight AS wm,
         0.3 * v.weight + 0.4 * c.weight + 0.3 * m.weight AS score
  FROM {VARIND_SQL} v JOIN {CORR_SQL} c USING (position) JOIN {MI_SQL} m USING (position)))"""


def _r6(*cols):
    return [F.round(F.col(c), 6).alias(c) for c in cols]


@query("variance_weights", sql=f"SELECT position, feature, round(variance, 6) AS variance, round(weight, 6) AS weight FROM {VAR_SQL}")
def variance_weights(spark, sf_dir):
    w = ST.variance_weights(li_frame(spark, sf_dir), COLS)
    return w.select("position", "feature", *_r6("variance", "weight"))


@query("correlation_weights", sql=f"SELECT position, feature, round(corr, 6) AS corr, round(weight, 6) AS weight FROM {CORR_SQL}")
def correlation_weights(spark, sf_dir):
    w = ST.correlation_weights(li_frame(spark, sf_dir), COLS, Y)
    return w.select("position", "feature", *_r6("corr", "weight"))


@query("mi_weights", headline=True, sql=f"SELECT position, feature, round(mi, 6) AS mi, round(weight, 6) AS weight FROM {MI_SQL}")
def mi_weights(spark, sf_dir):
    w = ST.mutual_information_weights(li_frame(spark, sf_dir), COLS, Y)
    return w.select("position", "feature", *_r6("mi", "weight"))


def _attention(spark, sf_dir):
    return ST.attention_weights(li_frame(spark, sf_dir), COLS, Y)


@query("attention_weights", sql=f"""
SELECT position, feature, round(wv, 6) AS wv, round(wc, 6) AS wc, round(wm, 6) AS wm, round(weight, 6) AS weight FROM {ATT_SQL}
""")
def attention_weights(spark, sf_dir):
    return _attention(spark, sf_dir).select("position", "feature", *_r6("wv", "wc", "wm", "weight"))


@query("attention_stats", sql=f"""
SELECT round(avg(weight), 6) AS mean, round(stddev_pop(weight), 6) AS std,
       round(-sum(weight * ln(weight + 1e-8)), 6) AS entropy,
       round(sum(weight) FILTER (WHERE rn <= 5), 6) AS concentration
FROM (SELECT weight, row_number() OVER (ORDER BY weight DESC, position) AS rn FROM {ATT_SQL})
""")
def attention_stats(spark, sf_dir):
    s = ST.attention_stats(_attention(spark, sf_dir), top=5)
    return s.select(*_r6("mean", "std", "entropy", "concentration"))


@query("top_features", sql=f"SELECT position, feature, round(weight, 6) AS weight FROM {ATT_SQL} ORDER BY weight DESC, position LIMIT 3")
def top_features(spark, sf_dir):
    return ST.top_features(_attention(spark, sf_dir), k=3).select("position", "feature", *_r6("weight"))


@query("mean_importance", sql=f"""
SELECT feature, round(avg(weight), 6) AS mean_importance, count(*) AS n_models FROM (
  SELECT feature, weight FROM {VAR_SQL} UNION ALL SELECT feature, weight FROM {CORR_SQL}
  UNION ALL SELECT feature, weight FROM {MI_SQL}) GROUP BY feature
""")
def mean_importance(spark, sf_dir):
    """Per-feature importances of three weighting models, averaged and ranked."""
    df = li_frame(spark, sf_dir)
    parts = [ST.variance_weights(df, COLS).select("feature", "weight"),
             ST.correlation_weights(df, COLS, Y).select("feature", "weight"),
             ST.mutual_information_weights(df, COLS, Y).select("feature", "weight")]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    g = u.groupBy("feature").agg(F.round(F.avg("weight"), 6).alias("mean_importance"), F.count(F.lit(1)).alias("n_models"))
    return g.orderBy(F.desc("mean_importance"), "feature")


_MOM = ", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(COLS))


def _std_expr(i, c):
    return f"({c} - m{i}) / CASE WHEN s{i} = 0 THEN 1 ELSE s{i} END"


@query("standard_scale", sql=f"""
SELECT l_orderkey, line, {', '.join(f'round({_std_expr(i, c)}, 6) AS {c}' for i, c in enumerate(COLS))}
FROM {LI_SQL}, (SELECT {_MOM} FROM {LI_SQL})
""")
def standard_scale(spark, sf_dir):
    s = ST.standard_scale(li_frame(spark, sf_dir), COLS, keep=["l_orderkey", "line"])
    return s.select("l_orderkey", "line", *_r6(*COLS))


@query("minmax_scale", sql=f"""
SELECT l_orderkey, line, round(y_scaled, 6) AS y_scaled, round(y_scaled * CASE WHEN hi = lo THEN 1 ELSE hi - lo END + lo, 6) AS y_restored
FROM (SELECT l_orderkey, line, lo, hi, ({Y} - lo) / CASE WHEN hi = lo THEN 1 ELSE hi - lo END AS y_scaled
      FROM {LI_SQL}, (SELECT min({Y}) AS lo, max({Y}) AS hi FROM {LI_SQL}))
""")
def minmax_scale(spark, sf_dir):
    df = li_frame(spark, sf_dir)
    fit = ST.fit_moments(df, [Y])
    s = ST.minmax_scale(df, [Y], keep=["l_orderkey", "line"], fitted=fit).withColumnRenamed(Y, "y_scaled")
    s = ST.minmax_inverse(s, "y_scaled", fit[Y]["min"], fit[Y]["max"], out="y_restored")
    return s.select("l_orderkey", "line", *_r6("y_scaled", "y_restored"))


@query("apply_attention", sql=f"""
WITH w AS (SELECT {', '.join(f"max(CASE WHEN position = {i} THEN weight END) AS w{i}" for i in range(len(COLS)))} FROM {ATT_SQL})
SELECT l_orderkey, line, {', '.join(f'round(({_std_expr(i, c)}) * (0.9 * w{i} + 0.1), 6) AS {c}' for i, c in enumerate(COLS))}
FROM {LI_SQL}, (SELECT {_MOM} FROM {LI_SQL}), w
""")
def apply_attention(spark, sf_dir):
    """Standardise, then scale each column by 0.9 * weight + 0.1."""
    df = li_frame(spark, sf_dir)
    w = {r["feature"]: r["weight"] for r in _attention(spark, sf_dir).select("feature", "weight").collect()}
    s = ST.standard_scale(df, COLS, keep=["l_orderkey", "line"])
    a = ST.apply_attention(s, COLS, w, keep=["l_orderkey", "line"])
    return a.select("l_orderkey", "line", *_r6(*COLS))


EMB_LONG_SQL = ("(SELECT label, CAST(unnest(embedding) AS DOUBLE) AS v, "
                "CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS dim FROM embeddings)")


@query("anova_f", sql=f"""
WITH g AS (SELECT dim, label, count(v) AS ng, sum(v) AS sg, sum(v * v) AS qg FROM {EMB_LONG_SQL} GROUP BY dim, label),
f AS (SELECT dim, CAST(sum(ng) AS BIGINT) AS n, count(*) AS k, sum(sg) AS s, sum(sg * sg / ng) AS a, sum(qg) AS q FROM g GROUP BY dim)
SELECT dim, n, k, round(((a - s * s / n) / (k - 1)) / nullif((q - a) / (n - k), 0), 6) AS f_stat FROM f
""")
def anova_f(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    long = e.select("label", F.posexplode("embedding").alias("dim", "v"))
    f = ST.anova_f(long, "dim", "v", "label")
    return f.select(F.col("dim").cast("int").alias("dim"), "n", "k", *_r6("f_stat"))


@query("vector_stats", sql="""
SELECT vec_id, round(CAST(len(list_filter(embedding, lambda x: coalesce(CAST(x AS DOUBLE), 0) = 0)) AS DOUBLE) / len(embedding), 6) AS sparsity,
       round(sqrt(list_sum(list_transform(embedding, lambda x: coalesce(CAST(x AS DOUBLE), 0) * coalesce(CAST(x AS DOUBLE), 0)))), 6) AS magnitude
FROM embeddings
""")
def vector_stats(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.round(RS.sparsity("embedding"), 6).alias("sparsity"),
                    F.round(RS.magnitude("embedding"), 6).alias("magnitude"))
