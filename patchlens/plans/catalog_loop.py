"""Improvement loop: parameter moves, schedule, accept rule and report.

Bindings (derived from the tables, so the work grows with them):
* parameter space: one candidate parameter map per ``part`` row - kind by
  key, estimators / depth / split sizes from ``p_size`` (integers stored as
  text, 'None' for unset, as in a JSON config), rate from ``p_retailprice``;
* loop history: one model per ``events`` score rule, one improvement cycle
  per event day; the cycle's F1 is that model's F1 on that day's events
  (a grouped aggregation, so the history is pre-aggregated before the
  sequential accept fold).
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from patchlens import config
from patchlens.functions.rowstats import safe_param
from patchlens.operators import tuning as TU
from patchlens.plans.catalog_eval import SCORES_SQL, _confusion_long, event_scores
from patchlens.plans.registry import query
from patchlens.sources.tables import table

N_FEATURES = 19


def param_table(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    kinds = F.array(F.lit(TU.RF), F.lit(TU.XGB), F.lit(TU.LGB))
    size = F.col("p_size")
    return p.select(
        F.col("p_partkey").alias("param_id"),
        F.element_at(kinds, (F.col("p_partkey") % 3 + 1).cast("int")).alias("model"),
        (size * 4).cast("string").alias("n_estimators"),
        F.when(size % 10 == 0, F.lit("None")).when(size % 10 == 1, F.lit("-1"))
        .otherwise((size % 10 + 2).cast("string")).alias("max_depth"),
        (size % 5 + 2).cast("string").alias("min_samples_split"),
        F.when(size % 7 == 0, F.lit(None).cast("double")).otherwise(F.col("p_retailprice") / 10000).alias("learning_rate"),
        (F.lit(0.5) + (size % 6) * 0.1).alias("subsample"),
        ((size % 4) * 0.05).alias("reg_alpha"),
        F.when(size % 9 == 0, F.lit(None).cast("double")).otherwise((size % 3) * 0.5).alias("reg_lambda"),
        (size % 40 + 7).cast("string").alias("num_leaves"),
    )


PARAMS_SQL = """(SELECT p_partkey AS param_id, ['random_forest', 'xgboost', 'lightgbm'][p_partkey % 3 + 1] AS model,
  CAST(p_size * 4 AS VARCHAR) AS n_estimators,
  CASE WHEN p_size % 10 = 0 THEN 'None' WHEN p_size % 10 = 1 THEN '-1' ELSE CAST(p_size % 10 + 2 AS VARCHAR) END AS max_depth,
  CAST(p_size % 5 + 2 AS VARCHAR) AS min_samples_split,
  CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_retailprice / 10000 END AS learning_rate,
  0.5 + (p_size % 6) * 0.1 AS subsample, (p_size % 4) * 0.05 AS reg_alpha,
  CASE WHEN p_size % 9 = 0 THEN NULL ELSE (p_size % 3) * 0.5 END AS reg_lambda,
  CAST(p_size % 40 + 7 AS VARCHAR) AS num_leaves FROM part)"""


def _ti(c, d):
    return f"coalesce(TRY_CAST({c} AS INTEGER), {d})"


def _td(c, d):
    return f"coalesce(CAST({c} AS DOUBLE), {d})"


def _r6(*cols):
    return [F.round(F.col(c), 6).alias(c) for c in cols]


# --------------------------------------------------------------- params

@query("safe_cast", sql=f"""
SELECT param_id, {_ti('n_estimators', 100)} AS n_estimators, {_ti('max_depth', 6)} AS max_depth,
       round({_td('learning_rate', 0.1)}, 6) AS learning_rate, {_ti('num_leaves', 31)} AS num_leaves
FROM {PARAMS_SQL}
""")
def safe_cast(spark, sf_dir):
    p = param_table(spark, sf_dir)
    return p.select("param_id", safe_param("n_estimators", 100, "int").alias("n_estimators"),
                    safe_param("max_depth", 6, "int").alias("max_depth"),
                    F.round(safe_param("learning_rate", 0.1, "double"), 6).alias("learning_rate"),
                    safe_param("num_leaves", 31, "int").alias("num_leaves"))


@query("param_weaken", sql=f"""
SELECT param_id, model,
  CASE WHEN model = 'random_forest' THEN greatest(50, {_ti('n_estimators', 100)} // 4)
       ELSE greatest(50, {_ti('n_estimators', 100)} // 3) END AS n_estimators,
  CASE WHEN model = 'random_forest' THEN least(5, {_ti('max_depth', 10)}) ELSE least(3, {_ti('max_depth', 6)}) END AS max_depth,
  CASE WHEN model = 'random_forest' THEN greatest(10, {_ti('min_samples_split', 2)} * 2) END AS min_samples_split,
  CASE WHEN model <> 'random_forest' THEN round(least(0.05, {_td('learning_rate', 0.1)}), 6) END AS learning_rate,
  CASE WHEN model = 'xgboost' THEN CAST(0.7 AS DOUBLE) END AS subsample,
  CASE WHEN model = 'lightgbm' THEN least(15, {_ti('num_leaves', 31)}) END AS num_leaves
FROM {PARAMS_SQL}
""")
def param_weaken(spark, sf_dir):
    w = TU.weaken(param_table(spark, sf_dir))
    return w.select("param_id", "model", F.col("n_estimators").cast("int").alias("n_estimators"),
                    F.col("max_depth").cast("int").alias("max_depth"),
                    F.col("min_samples_split").cast("int").alias("min_samples_split"),
                    *_r6("learning_rate"), "subsample", F.col("num_leaves").cast("int").alias("num_leaves"))


_DEPTH = (f"CASE WHEN model = 'random_forest' THEN {_ti('max_depth', 10)} "
          f"WHEN model = 'lightgbm' THEN (CASE WHEN {_ti('max_depth', -1)} = -1 THEN 6 ELSE {_ti('max_depth', -1)} END) "
          f"ELSE {_ti('max_depth', 6)} END")
_LAM = f"CASE WHEN model = 'xgboost' THEN {_td('reg_lambda', 1.0)} ELSE {_td('reg_lambda', 0.0)} END"


@query("param_moves", sql=f"""
SELECT param_id, model, strategy,
  CAST(CASE WHEN strategy = 'tune_learning_rate' THEN model IN ('xgboost', 'lightgbm') ELSE true END AS INTEGER) AS applicable,
  CASE WHEN strategy = 'add_estimators' THEN least({_ti('n_estimators', 100)} + 25, 300) ELSE TRY_CAST(n_estimators AS INTEGER) END AS n_estimators,
  round(CASE WHEN strategy = 'tune_learning_rate' AND model IN ('xgboost', 'lightgbm')
             THEN least({_td('learning_rate', 0.1)} * 1.2, 0.3) ELSE learning_rate END, 6) AS learning_rate,
  CASE WHEN strategy = 'adjust_depth' THEN least(({_DEPTH}) + 1, 12) ELSE TRY_CAST(max_depth AS INTEGER) END AS max_depth,
  CASE WHEN strategy = 'feature_selection' THEN {min(config.SELECT_K, N_FEATURES)} END AS select_k,
  round(CASE WHEN strategy = 'ensemble_weights' AND model = 'random_forest' THEN 0.9
             WHEN strategy = 'ensemble_weights' THEN least({_td('subsample', 1.0)} + 0.1, 1.0) ELSE CAST(subsample AS DOUBLE) END, 6) AS subsample,
  round(CASE WHEN strategy = 'regularization_tuning' AND model <> 'random_forest' THEN greatest({_td('reg_alpha', 0.0)} * 0.8, 0.0)
             ELSE CAST(reg_alpha AS DOUBLE) END, 6) AS reg_alpha,
  round(CASE WHEN strategy = 'regularization_tuning' AND model = 'xgboost' THEN greatest(({_LAM}) * 0.9, 0.1)
             WHEN strategy = 'regularization_tuning' AND model = 'lightgbm' THEN greatest(({_LAM}) * 0.9, 0.0)
             ELSE CAST(reg_lambda AS DOUBLE) END, 6) AS reg_lambda,
  CASE WHEN strategy = 'regularization_tuning' AND model = 'random_forest' THEN greatest({_ti('min_samples_split', 2)} - 1, 2)
       ELSE TRY_CAST(min_samples_split AS INTEGER) END AS min_samples_split
FROM {PARAMS_SQL}, (SELECT unnest({[s for s in config.STRATEGIES]}) AS strategy)
""")
def param_moves(spark, sf_dir):
    m = TU.apply_moves(param_table(spark, sf_dir), N_FEATURES)
    return m.select("param_id", "model", "strategy", "applicable", F.col("n_estimators").cast("int").alias("n_estimators"),
                    *_r6("learning_rate"), F.col("max_depth").cast("int").alias("max_depth"), "select_k",
                    *_r6("subsample", "reg_alpha", "reg_lambda"),
                    F.col("min_samples_split").cast("int").alias("min_samples_split"))


# -------------------------------------------------------------- history

def history(spark, sf_dir):
    """(model, iteration, strategy, new_f1): F1 of each score rule per event day."""
    s = event_scores(spark, sf_dir)
    lg = s.selectExpr("day", "actual", "stack(3, 'p1', p1, 'p2', p2, 'p3', p3) AS (model, p)")
    per_day = _confusion_long(lg, ["model", "day"]).select("model", "day", F.round("f1", 6).alias("new_f1"))
    # per-(model, day) table: one row per model and cycle
    it = (F.dense_rank().over(Window.partitionBy("model").orderBy("day")) - 1).cast("int")
    h = per_day.withColumn("iteration", it)
    return h.select("model", "iteration", TU.strategy_for("iteration").alias("strategy"), "new_f1")


_STRATS = "[" + ", ".join(f"'{s}'" for s in config.STRATEGIES) + "]"
HISTORY_SQL = f"""(SELECT model, iteration,
    CASE WHEN iteration = 0 THEN 'baseline' ELSE {_STRATS}[(iteration - 1) % 6 + 1] END AS strategy, new_f1
  FROM (SELECT model, CAST(dense_rank() OVER (PARTITION BY model ORDER BY day) - 1 AS INTEGER) AS iteration,
               round(coalesce(2 * prec * rec / nullif(prec + rec, 0), 0), 6) AS new_f1
        FROM (SELECT model, day, coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS prec,
                     coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS rec
              FROM (SELECT model, day,
                           count(*) FILTER (WHERE actual = 1 AND p > 0.5) AS tp, count(*) FILTER (WHERE actual = 0 AND p > 0.5) AS fp,
                           count(*) FILTER (WHERE actual = 1 AND NOT coalesce(p > 0.5, false)) AS fn
                    FROM (SELECT day, actual, 'p1' AS model, p1 AS p FROM {SCORES_SQL}
                          UNION ALL SELECT day, actual, 'p2', p2 FROM {SCORES_SQL}
                          UNION ALL SELECT day, actual, 'p3', p3 FROM {SCORES_SQL})
                    GROUP BY model, day))))"""

FOLD_SQL = f"""WITH RECURSIVE h AS {HISTORY_SQL},
r AS (
  SELECT model, iteration, new_f1, CAST(NULL AS DOUBLE) AS prev_f1, new_f1 AS current_f1, 0 AS accepted FROM h WHERE iteration = 0
  UNION ALL
  SELECT h.model, h.iteration, h.new_f1, r.current_f1,
         CASE WHEN h.new_f1 - r.current_f1 > 0.0001 THEN h.new_f1 ELSE r.current_f1 END,
         CASE WHEN h.new_f1 - r.current_f1 > 0.0001 THEN 1 ELSE 0 END
  FROM r JOIN h ON h.model = r.model AND h.iteration = r.iteration + 1)
"""


def moves(spark, sf_dir):
    return TU.accept_moves(history(spark, sf_dir))


@query("strategy_schedule", sql=f"SELECT model, iteration, strategy FROM {HISTORY_SQL}")
def strategy_schedule(spark, sf_dir):
    return history(spark, sf_dir).select("model", "iteration", "strategy")


@query("running_best", sql=f"""
SELECT model, iteration, new_f1, max(new_f1) OVER (PARTITION BY model ORDER BY iteration ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best_f1
FROM {HISTORY_SQL}
""")
def running_best(spark, sf_dir):
    return TU.running_best(history(spark, sf_dir)).select("model", "iteration", "new_f1", "best_f1")


@query("accepted_moves", sql=FOLD_SQL + """
SELECT model, iteration, new_f1, prev_f1, current_f1, accepted,
       CASE WHEN accepted = 1 THEN round(new_f1 - prev_f1, 6) END AS improvement FROM r
""")
def accepted_moves(spark, sf_dir):
    m = moves(spark, sf_dir)
    return m.select("model", "iteration", "new_f1", "prev_f1", "current_f1", "accepted", *_r6("improvement"))


@query("loop_report", sql=FOLD_SQL + """
SELECT model, arg_min(current_f1, iteration) AS baseline_f1, arg_max(current_f1, iteration) AS final_f1,
       max(current_f1) AS best_f1, CAST(sum(accepted) AS BIGINT) AS improvement_count,
       count(*) FILTER (WHERE iteration > 0) AS attempts,
       round(sum(accepted) / greatest(count(*) FILTER (WHERE iteration > 0), 1), 6) AS success_rate
FROM r GROUP BY model
""")
def loop_report(spark, sf_dir):
    r = TU.loop_report(moves(spark, sf_dir))
    return r.select("model", "baseline_f1", "final_f1", "best_f1", "improvement_count", "attempts", *_r6("success_rate"))


@query("first_stop_iteration", sql=FOLD_SQL + f"""
, it AS (SELECT iteration, max(current_f1) AS best_current FROM r GROUP BY iteration)
SELECT coalesce(min(iteration) FILTER (WHERE best_current > {config.STOP_F1} AND iteration > 0), max(iteration)) AS stop_iteration,
       CASE WHEN min(iteration) FILTER (WHERE best_current > {config.STOP_F1} AND iteration > 0) IS NOT NULL THEN 'target' ELSE 'time' END AS reason,
       max(iteration) AS last_iteration
FROM it
""")
def first_stop_iteration(spark, sf_dir):
    return TU.first_stop_iteration(moves(spark, sf_dir))
