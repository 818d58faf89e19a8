"""Bounded accept-if-better tuning: parameter moves, schedule and history.

Parameter maps are rows of a DataFrame and every move is a column
expression, so a whole search space is transformed in one projection.  The
accept rule is sequential (a rejected move keeps the old "current" score),
so it is a fold over each model's history, ordered by iteration, written
with ``aggregate`` over a sorted array.  That array holds one entry per
improvement cycle of one model: histories are aggregated per cycle before
this step, so its length is bounded by the number of cycles, not by rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patchlens import config
from patchlens.functions.rowstats import safe_param

RF, XGB, LGB = "random_forest", "xgboost", "lightgbm"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def weaken(params: DataFrame) -> DataFrame:
    """The deliberately weaker starting model per kind (L1)."""
    m = F.col("model")
    n = safe_param("n_estimators", 100, "int")
    depth_rf = F.least(F.lit(5), safe_param("max_depth", 10, "int"))
    depth_b = F.least(F.lit(3), safe_param("max_depth", 6, "int"))
    boosted = m.isin(XGB, LGB)
    return params.select(
        "param_id", "model",
        F.when(m == RF, F.greatest(F.lit(50), F.floor(n / 4).cast("int")))
        .when(boosted, F.greatest(F.lit(50), F.floor(n / 3).cast("int"))).alias("n_estimators"),
        F.when(m == RF, depth_rf).when(boosted, depth_b).alias("max_depth"),
        F.when(m == RF, F.greatest(F.lit(10), safe_param("min_samples_split", 2, "int") * 2)).alias("min_samples_split"),
        F.when(boosted, F.least(F.lit(0.05), safe_param("learning_rate", 0.1, "double"))).alias("learning_rate"),
        F.when(m == XGB, F.lit(0.7)).alias("subsample"),
        F.when(m == LGB, F.least(F.lit(15), safe_param("num_leaves", 31, "int"))).alias("num_leaves"),
    )


def apply_moves(params: DataFrame, n_features: int, strategies=None) -> DataFrame:
    """Every strategy applied to every parameter row (L3).

    ``applicable`` is 0 when a strategy has no move for the model kind
    (e.g. learning rate for a random forest).  A parameter that the strategy
    does not touch stays as it was, unset ones unset; a touched one starts
    from its kind's default if it is unset.
    """
    strategies = strategies or config.STRATEGIES
    d = params.withColumn("strategy", F.explode(F.array(*[F.lit(s) for s in strategies])))
    m, s = F.col("model"), F.col("strategy")
    boosted = m.isin(XGB, LGB)
    n = safe_param("n_estimators", 100, "int")
    lr_def = safe_param("learning_rate", 0.1, "double")
    depth = (F.when(m == RF, safe_param("max_depth", 10, "int"))
             .when(m == LGB, F.when(safe_param("max_depth", -1, "int") == -1, F.lit(6)).otherwise(safe_param("max_depth", -1, "int")))
             .otherwise(safe_param("max_depth", 6, "int")))
    sub = safe_param("subsample", 1.0, "double")
    alpha = safe_param("reg_alpha", 0.0, "double")
    lam = F.when(m == XGB, safe_param("reg_lambda", 1.0, "double")).otherwise(safe_param("reg_lambda", 0.0, "double"))
    mss = safe_param("min_samples_split", 2, "int")
    applicable = (F.when(s == "tune_learning_rate", boosted)
                  .when(s == "regularization_tuning", m.isin(RF, XGB, LGB))
                  .otherwise(m.isin(RF, XGB, LGB)))
    held = {c: F.col(c).try_cast(t) for c, t in (("n_estimators", "int"), ("learning_rate", "double"), ("max_depth", "int"),
                                                 ("subsample", "double"), ("reg_alpha", "double"), ("reg_lambda", "double"),
                                                 ("min_samples_split", "int"))}
    return d.select(
        "param_id", "model", "strategy", applicable.cast("int").alias("applicable"),
        F.when(s == "add_estimators", F.least(n + config.ESTIMATOR_STEP, F.lit(config.MAX_ESTIMATORS))).otherwise(held["n_estimators"]).alias("n_estimators"),
        F.when((s == "tune_learning_rate") & boosted,
               F.least(lr_def * config.LEARNING_RATE_FACTOR, F.lit(config.MAX_LEARNING_RATE))).otherwise(held["learning_rate"]).alias("learning_rate"),
        F.when(s == "adjust_depth", F.least(depth + 1, F.lit(config.MAX_DEPTH))).otherwise(held["max_depth"]).alias("max_depth"),
        F.when(s == "feature_selection", F.lit(min(config.SELECT_K, n_features))).alias("select_k"),
        F.when((s == "ensemble_weights") & (m == RF), F.lit(0.9))
        .when((s == "ensemble_weights") & boosted, F.least(sub + 0.1, F.lit(1.0))).otherwise(held["subsample"]).alias("subsample"),
        F.when((s == "regularization_tuning") & boosted, F.greatest(alpha * 0.8, F.lit(0.0))).otherwise(held["reg_alpha"]).alias("reg_alpha"),
        F.when((s == "regularization_tuning") & (m == XGB), F.greatest(lam * 0.9, F.lit(0.1)))
        .when((s == "regularization_tuning") & (m == LGB), F.greatest(lam * 0.9, F.lit(0.0))).otherwise(held["reg_lambda"]).alias("reg_lambda"),
        F.when((s == "regularization_tuning") & (m == RF), F.greatest(mss - 1, F.lit(2))).otherwise(held["min_samples_split"]).alias("min_samples_split"),
    )


def strategy_for(iteration) -> Column:
    """Round robin: cycle i (1-based) uses strategies[(i - 1) % 6]; cycle 0 is the baseline."""
    it = _c(iteration)
    arr = F.array(*[F.lit(s) for s in config.STRATEGIES])
    return F.when(it == 0, F.lit("baseline")).otherwise(
        F.element_at(arr, (F.pmod(it - 1, F.lit(len(config.STRATEGIES))) + 1).cast("int")))


def running_best(history: DataFrame, model: str = "model", it: str = "iteration", score: str = "new_f1") -> DataFrame:
    w = Window.partitionBy(model).orderBy(it).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return history.withColumn("best_f1", F.max(score).over(w))


def accept_moves(history: DataFrame, model: str = "model", it: str = "iteration", score: str = "new_f1",
                 min_gain: float = config.ACCEPT_MIN_GAIN) -> DataFrame:
    """Sequential accept rule per model: keep a move only if it beats the
    current score by more than ``min_gain``; iteration 0 is the baseline.

    Output per (model, iteration): prev_f1, current_f1, accepted, improvement.
    """
    per_model = history.groupBy(model).agg(F.array_sort(F.collect_list(F.struct(F.col(it).alias("it"), F.col(score).alias("f1")))).alias("h"))
    init = F.struct(F.lit(None).cast("double").alias("cur"),
                    F.array().cast("array<struct<it:int,f1:double,prev:double,cur:double,acc:int>>").alias("out"))

    def step(state, x):
        first = state["cur"].isNull()
        gain = x["f1"] - state["cur"]
        acc = (~first) & (gain > F.lit(min_gain))
        new_cur = F.when(first | acc, x["f1"]).otherwise(state["cur"])
        rec = F.struct(x["it"].cast("int").alias("it"), x["f1"].cast("double").alias("f1"), state["cur"].alias("prev"),
                       new_cur.alias("cur"), acc.cast("int").alias("acc"))
        return F.struct(new_cur.alias("cur"), F.array_append(state["out"], rec).alias("out"))

    folded = per_model.select(model, F.aggregate("h", init, step)["out"].alias("o"))
    e = folded.select(model, F.explode("o").alias("r"))
    return e.select(model, F.col("r.it").alias(it), F.col("r.f1").alias(score), F.col("r.prev").alias("prev_f1"),
                    F.col("r.cur").alias("current_f1"), F.col("r.acc").alias("accepted"),
                    F.when(F.col("r.acc") == 1, F.col("r.f1") - F.col("r.prev")).alias("improvement"))


def loop_report(moves: DataFrame, model: str = "model", it: str = "iteration") -> DataFrame:
    """Per model: baseline, final and best F1, accepted count, attempts, success rate."""
    return moves.groupBy(model).agg(
        F.min_by("current_f1", F.col(it)).alias("baseline_f1"),
        F.max_by("current_f1", F.col(it)).alias("final_f1"),
        F.max("current_f1").alias("best_f1"),
        F.sum("accepted").cast("bigint").alias("improvement_count"),
        F.count_if(F.col(it) > 0).alias("attempts"),
    ).withColumn("success_rate", F.col("improvement_count") / F.greatest(F.col("attempts"), F.lit(1)))


def first_stop_iteration(moves: DataFrame, it: str = "iteration", target: float = config.STOP_F1) -> DataFrame:
    """First cycle after which any model's current F1 exceeds ``target``;
    otherwise the last cycle (time budget used up)."""
    per_it = moves.groupBy(it).agg(F.max("current_f1").alias("best_current"))
    return per_it.agg(
        F.min(F.when((F.col("best_current") > target) & (F.col(it) > 0), F.col(it))).alias("_hit"),
        F.max(it).alias("last_iteration"),
    ).select(
        F.coalesce("_hit", "last_iteration").alias("stop_iteration"),
        F.when(F.col("_hit").isNotNull(), "target").otherwise("time").alias("reason"),
        "last_iteration",
    )
