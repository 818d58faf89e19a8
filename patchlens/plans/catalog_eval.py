"""Splits, folds, samples and model metrics.

Model scores come from the ``events`` score table (three fixed scoring
rules p1, p2, p3; actual = purchase), so metric and ensemble operators are
value-checked without training.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from patchlens.operators import metrics as MT
from patchlens.operators import split as SP
from patchlens.plans.registry import query
from patchlens.sources.tables import PATCH_VIEW_SQL, patch_view, table

PV = PATCH_VIEW_SQL
MODELS = ["p1", "p2", "p3"]


def event_scores(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        F.to_date("ts").alias("day"),
        (F.col("event_type") == "purchase").cast("int").alias("actual"),
        F.try_divide(F.col("value"), F.col("value") + 100).alias("p1"),
        (F.get_json_object("props", "$.k").cast("double") / 100).alias("p2"),
        (F.hour("ts") / 24.0).alias("p3"),
    )


SCORES_SQL = """(SELECT event_id, CAST(ts AS DATE) AS day, CAST(event_type = 'purchase' AS INTEGER) AS actual,
  value / nullif(value + 100, 0) AS p1, CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100 AS p2,
  hour(ts) / 24.0 AS p3 FROM events)"""


def long_scores(df, models=MODELS, keep=("event_id", "actual")):
    stack = ", ".join(f"'{m}', {m}" for m in models)
    return df.selectExpr(*keep, f"stack({len(models)}, {stack}) AS (model, p)")


LONG_SQL = f"""(SELECT event_id, actual, 'p1' AS model, p1 AS p FROM {SCORES_SQL}
  UNION ALL SELECT event_id, actual, 'p2', p2 FROM {SCORES_SQL}
  UNION ALL SELECT event_id, actual, 'p3', p3 FROM {SCORES_SQL})"""


def split_sql(src: str, id_col: str, label: str | None, test: str, val: str | None, seed: int = 42) -> str:
    part = f"PARTITION BY {label}" if label else ""
    rk = f"row_number() OVER ({part} ORDER BY md5(CAST({id_col} AS VARCHAR) || '|{seed}'), {id_col})"
    n = f"count(*) OVER ({part})"
    case = f"CASE WHEN rk <= ceil(n * {test}) THEN 'test' "
    if val:
        case += f"WHEN rk <= ceil(n * {test}) + ceil((n - ceil(n * {test})) * {val}) THEN 'val' "
    case += "ELSE 'train' END"
    return f"(SELECT *, {case} AS split FROM (SELECT *, {rk} AS rk, {n} AS n FROM {src}))"


def fold_sql(src: str, id_col: str, label: str | None, k: int, seed: int = 42) -> str:
    part = f"PARTITION BY {label}" if label else ""
    rk = f"row_number() OVER ({part} ORDER BY md5(CAST({id_col} AS VARCHAR) || '|{seed}'), {id_col})"
    return f"(SELECT *, CAST(({rk} - 1) % {k} AS INTEGER) AS fold FROM {src})"


def _split(df, id_col, label, test, val):
    return SP.stratified_split(df, id_col, label, Decimal(test), Decimal(val) if val else None)


def _r6(*cols):
    return [F.round(F.col(c), 6).alias(c) for c in cols]


RATES = ["accuracy", "precision", "recall", "f1"]


def _rates_sql(tp="tp", fp="fp", tn="tn", fn="fn") -> str:
    prec = f"coalesce(CAST({tp} AS DOUBLE) / nullif({tp} + {fp}, 0), 0)"
    rec = f"coalesce(CAST({tp} AS DOUBLE) / nullif({tp} + {fn}, 0), 0)"
    return (f"round(coalesce(CAST({tp} + {tn} AS DOUBLE) / nullif({tp} + {fp} + {tn} + {fn}, 0), 0), 6) AS accuracy, "
            f"round({prec}, 6) AS precision, round({rec}, 6) AS recall, "
            f"round(coalesce(2 * {prec} * {rec} / nullif({prec} + {rec}, 0), 0), 6) AS f1")


CONF_SQL = ("count(*) FILTER (WHERE actual = 1 AND p > 0.5) AS tp, count(*) FILTER (WHERE actual = 0 AND p > 0.5) AS fp, "
            "count(*) FILTER (WHERE actual = 0 AND NOT coalesce(p > 0.5, false)) AS tn, "
            "count(*) FILTER (WHERE actual = 1 AND NOT coalesce(p > 0.5, false)) AS fn")


def _confusion_long(df, by):
    d = df.withColumn("_pred", F.coalesce(F.col("p") > 0.5, F.lit(False)))
    return MT.confusion(d, "actual", "_pred", by=by)


# ------------------------------------------------------------ splits (I)

@query("stratified_split", headline=True, sql=f"""
SELECT patch_id, accepted, split FROM {split_sql(PV, 'patch_id', 'accepted', '0.2', '0.25')}
""")
def stratified_split(spark, sf_dir):
    pv = patch_view(spark, sf_dir).select("patch_id", "accepted")
    return _split(pv, "patch_id", "accepted", "0.2", "0.25")


@query("stratified_split_70_30", sql=f"""
SELECT event_id, actual, split FROM {split_sql(SCORES_SQL, 'event_id', 'actual', '0.3', None)}
""")
def stratified_split_70_30(spark, sf_dir):
    s = event_scores(spark, sf_dir).select("event_id", "actual")
    return _split(s, "event_id", "actual", "0.3", None)


@query("stratified_kfold", sql=f"""
SELECT patch_id, accepted, fold FROM {fold_sql(PV, 'patch_id', 'accepted', 3)}
""")
def stratified_kfold(spark, sf_dir):
    pv = patch_view(spark, sf_dir).select("patch_id", "accepted")
    return SP.stratified_kfold(pv, "patch_id", "accepted", k=3)


@query("kfold", sql=f"SELECT event_id, fold FROM {fold_sql('events', 'event_id', None, 5)}")
def kfold(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id")
    return SP.kfold(e, "event_id", k=5)


@query("sample_cap", sql="""
SELECT l_orderkey, l_linenumber FROM (
  SELECT l_orderkey, l_linenumber, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS line_id FROM lineitem)
ORDER BY md5(line_id || '|42'), line_id LIMIT 10000
""")
def sample_cap(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("line_id"))
    return SP.sample_cap(li, "line_id", 10000).select("l_orderkey", "l_linenumber")


# ------------------------------------------------------------ metrics (D)

@query("confusion_metrics", sql=f"""
SELECT model, tp, fp, tn, fn, {_rates_sql()} FROM (SELECT model, {CONF_SQL} FROM {LONG_SQL} GROUP BY model)
""")
def confusion_metrics(spark, sf_dir):
    m = _confusion_long(long_scores(event_scores(spark, sf_dir)), ["model"])
    return m.select("model", "tp", "fp", "tn", "fn", *_r6(*RATES))


AUC_SQL_BODY = """
  SELECT {by}, CASE WHEN sum(actual) = 0 OR sum(1 - actual) = 0 THEN 0.5 ELSE
         (sum(ar) FILTER (WHERE actual = 1) - sum(actual) * (sum(actual) + 1) / 2.0) / (sum(actual) * sum(1 - actual)) END AS auc
  FROM (SELECT {by}, actual, rank() OVER (PARTITION BY {by} ORDER BY p)
               + (count(*) OVER (PARTITION BY {by}, p) - 1) / 2.0 AS ar FROM {src} WHERE p IS NOT NULL)
  GROUP BY {by}"""


@query("roc_auc", headline=True, sql="SELECT model, round(auc, 6) AS auc FROM (" + AUC_SQL_BODY.format(by="model", src=LONG_SQL) + ")")
def roc_auc(spark, sf_dir):
    a = MT.roc_auc(long_scores(event_scores(spark, sf_dir)), "p", "actual", by=["model"])
    return a.select("model", F.round("auc", 6).alias("auc"))


@query("regression_metrics", sql=f"""
WITH s AS (SELECT actual, p1, p2, p3, (p1 + p2 + p3) / 3 AS ens_mean FROM {SCORES_SQL}),
l AS (SELECT 'p1' AS model, actual, p1 AS p FROM s UNION ALL SELECT 'p2', actual, p2 FROM s
      UNION ALL SELECT 'p3', actual, p3 FROM s UNION ALL SELECT 'ens_mean', actual, ens_mean FROM s)
SELECT model, round(avg((actual - p) * (actual - p)), 6) AS mse,
       round(1 - sum((actual - p) * (actual - p)) / nullif(sum(actual * actual) - sum(actual) * sum(actual) / count(actual), 0), 6) AS r2
FROM l GROUP BY model
""")
def regression_metrics(spark, sf_dir):
    s = event_scores(spark, sf_dir).withColumn("ens_mean", (F.col("p1") + F.col("p2") + F.col("p3")) / 3)
    m = MT.mse_r2(long_scores(s, MODELS + ["ens_mean"]), "actual", "p", by=["model"])
    return m.select("model", *_r6("mse", "r2"))


@query("class_weights", sql=f"""
SELECT accepted, n_class, round(n * 1.0 / (k * n_class), 6) AS balanced_weight,
       round(neg * 1.0 / greatest(pos, 1), 6) AS scale_pos_weight
FROM (SELECT accepted, n_class, sum(n_class) OVER () AS n, count(*) OVER () AS k,
             sum(CASE WHEN accepted = 0 THEN n_class ELSE 0 END) OVER () AS neg,
             sum(CASE WHEN accepted = 1 THEN n_class ELSE 0 END) OVER () AS pos
      FROM (SELECT accepted, count(*) AS n_class FROM {PV} GROUP BY accepted))
""")
def class_weights(spark, sf_dir):
    w = MT.class_weights(patch_view(spark, sf_dir), "accepted")
    return w.select("accepted", "n_class", *_r6("balanced_weight", "scale_pos_weight"))


@query("batch_summary", sql=f"""
SELECT e.event_type, count(*) AS n, round(avg(e.value), 2) AS mean_quality, round(stddev_pop(e.value), 2) AS std_quality,
       round(avg(s.p1), 4) AS mean_confidence, round(stddev_pop(s.p1), 4) AS std_confidence
FROM events e JOIN {SCORES_SQL} s ON e.event_id = s.event_id GROUP BY e.event_type
""")
def batch_summary(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    d = e.select("event_type", "value", F.try_divide(F.col("value"), F.col("value") + 100).alias("p1"))
    return d.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("value"), 2).alias("mean_quality"), F.round(F.stddev_pop("value"), 2).alias("std_quality"),
        F.round(F.avg("p1"), 4).alias("mean_confidence"), F.round(F.stddev_pop("p1"), 4).alias("std_confidence"))


# ------------------------------------------- per-model evaluation

SPLIT_SCORES_SQL = split_sql(SCORES_SQL, "event_id", "actual", "0.2", "0.25")
SPLIT_LONG_SQL = f"""(SELECT event_id, actual, split, 'p1' AS model, p1 AS p FROM {SPLIT_SCORES_SQL}
  UNION ALL SELECT event_id, actual, split, 'p2', p2 FROM {SPLIT_SCORES_SQL}
  UNION ALL SELECT event_id, actual, split, 'p3', p3 FROM {SPLIT_SCORES_SQL})"""


def split_scores(spark, sf_dir):
    return _split(event_scores(spark, sf_dir), "event_id", "actual", "0.2", "0.25")


def split_long(spark, sf_dir):
    return long_scores(split_scores(spark, sf_dir), keep=("event_id", "actual", "split"))


@query("evaluate_models", sql=f"""
WITH c AS (SELECT model, split, {CONF_SQL} FROM {SPLIT_LONG_SQL} WHERE split IN ('val', 'test') GROUP BY model, split),
a AS ({AUC_SQL_BODY.format(by="model, split", src=f"(SELECT * FROM {SPLIT_LONG_SQL} WHERE split IN ('val', 'test'))")})
SELECT c.model, c.split, {_rates_sql('c.tp', 'c.fp', 'c.tn', 'c.fn')}, round(a.auc, 6) AS auc
FROM c JOIN a ON c.model = a.model AND c.split = a.split
""")
def evaluate_models(spark, sf_dir):
    lg = split_long(spark, sf_dir).filter(F.col("split").isin("val", "test"))
    # one pass over the scored rows; the collapsed counts are checkpointed to the shared
    # checkpoint folder so the confusion counts, the bucket bounds and the AUC all read it
    counts = MT.score_counts(lg, "p", "actual", by=["model", "split"]).checkpoint(eager=True)
    conf = MT.confusion_from_counts(counts, ["model", "split"])
    auc = MT.roc_auc(None, "p", "actual", by=["model", "split"], counts=counts)
    return conf.join(auc, ["model", "split"]).select("model", "split", *_r6(*RATES, "auc"))


def _val_f1_sql() -> str:
    return f"""(SELECT model, coalesce(2 * prec * rec / nullif(prec + rec, 0), 0) AS f1 FROM (
      SELECT model, coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS prec,
             coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS rec
      FROM (SELECT model, {CONF_SQL} FROM {SPLIT_LONG_SQL} WHERE split = 'val' GROUP BY model)))"""


@query("weighted_ensemble", sql=f"""
WITH f AS {_val_f1_sql()},
w AS (SELECT model, f1 / coalesce(nullif((SELECT sum(f1) FROM f), 0), 1) AS w FROM f),
t AS (SELECT * FROM {SPLIT_SCORES_SQL} WHERE split = 'test')
SELECT event_id, actual, round(ens_proba, 6) AS ens_proba, CAST(ens_proba > 0.5 AS INTEGER) AS ens_class
FROM (SELECT event_id, actual,
             (SELECT w FROM w WHERE model = 'p1') * p1 + (SELECT w FROM w WHERE model = 'p2') * p2
             + (SELECT w FROM w WHERE model = 'p3') * p3 AS ens_proba FROM t)
""")
def weighted_ensemble(spark, sf_dir):
    s = split_scores(spark, sf_dir)
    lg = long_scores(s, keep=("event_id", "actual", "split"))
    weights = MT.ensemble_weights(lg.filter(F.col("split") == "val"), "model", "actual", "p")
    out = MT.weighted_ensemble(s.filter(F.col("split") == "test"), {m: weights.get(m, 0.0) for m in MODELS})
    return out.select("event_id", "actual", F.round("ens_proba", 6).alias("ens_proba"), "ens_class")


@query("best_model", sql=f"""
WITH f AS {_val_f1_sql()},
r AS (SELECT model, avg((actual - p) * (actual - p)) AS mse FROM {SPLIT_LONG_SQL} WHERE split = 'val' GROUP BY model)
SELECT (SELECT model FROM f ORDER BY f1 DESC, model LIMIT 1) AS best_model,
       (SELECT round(max(f1), 6) FROM f) AS best_f1,
       (SELECT model FROM r ORDER BY mse, model LIMIT 1) AS best_mse_model,
       (SELECT round(min(mse), 6) FROM r) AS best_mse
""")
def best_model(spark, sf_dir):
    """argmax F1 and argmin validation MSE over the per-model metric table."""
    lg = split_long(spark, sf_dir).filter(F.col("split") == "val")
    f1 = _confusion_long(lg, ["model"]).select("model", "f1")
    mse = lg.groupBy("model").agg(F.avg((F.col("actual") - F.col("p")) ** 2).alias("mse"))
    m = f1.join(mse, "model")
    # min over (-f1, name): highest F1, ties -> alphabetically first name
    return m.agg(
        F.min_by("model", F.struct(-F.col("f1"), F.col("model"))).alias("best_model"),
        F.round(F.max("f1"), 6).alias("best_f1"),
        F.min_by("model", F.struct("mse", "model")).alias("best_mse_model"),
        F.round(F.min("mse"), 6).alias("best_mse"),
    )


def fold_metrics(spark, sf_dir):
    """Per (model, fold) confusion rates over a 5-fold split of the events."""
    folds = SP.kfold(event_scores(spark, sf_dir), "event_id", k=5)
    lg = long_scores(folds, keep=("event_id", "actual", "fold"))
    return _confusion_long(lg, ["model", "fold"])


FOLD_METRICS_SQL = f"""(SELECT model, fold, {_rates_sql()} FROM (
  SELECT model, fold, {CONF_SQL} FROM (
    SELECT l.*, f.fold FROM {LONG_SQL} l JOIN {fold_sql('events', 'event_id', None, 5)} f ON l.event_id = f.event_id)
  GROUP BY model, fold))"""


@query("cv_summary", sql=f"""
SELECT model, round(avg(f1), 6) AS mean_f1, round(stddev_pop(f1), 6) AS std_f1, count(*) AS n_folds
FROM (SELECT model, fold, CAST(f1 AS DOUBLE) AS f1 FROM {FOLD_METRICS_SQL}) GROUP BY model
""")
def cv_summary(spark, sf_dir):
    m = fold_metrics(spark, sf_dir).withColumn("f1", F.round("f1", 6))
    return m.groupBy("model").agg(F.round(F.avg("f1"), 6).alias("mean_f1"), F.round(F.stddev_pop("f1"), 6).alias("std_f1"),
                                  F.count(F.lit(1)).alias("n_folds"))


@query("model_status", sql=f"""
SELECT model, round(avg(accuracy), 6) AS mean_accuracy,
       CASE WHEN avg(accuracy) > 0.8 THEN 'Success' WHEN avg(accuracy) > 0.6 THEN 'Fine' ELSE 'Failed' END AS status,
       count(*) FILTER (WHERE accuracy > 0.8) AS n_good_folds
FROM (SELECT model, fold, CAST(accuracy AS DOUBLE) AS accuracy FROM {FOLD_METRICS_SQL}) GROUP BY model
""")
def model_status(spark, sf_dir):
    m = fold_metrics(spark, sf_dir).withColumn("accuracy", F.round("accuracy", 6))
    g = m.groupBy("model").agg(F.avg("accuracy").alias("a"), F.count_if(F.col("accuracy") > 0.8).alias("n_good_folds"))
    status = F.when(F.col("a") > 0.8, "Success").when(F.col("a") > 0.6, "Fine").otherwise("Failed")
    return g.select("model", F.round("a", 6).alias("mean_accuracy"), status.alias("status"), "n_good_folds")


@query("compare_models", sql=f"""
SELECT day, round(trad, 6) AS trad_mse, round(att, 6) AS att_mse,
       round((trad - att) / nullif(trad, 0) * 100, 6) AS improvement_pct, CAST(att < trad AS INTEGER) AS attention_wins
FROM (SELECT CAST(day AS VARCHAR) AS day, avg((p1 - actual) * (p1 - actual)) AS trad,
             avg(((p1 + p2 + p3) / 3 - actual) * ((p1 + p2 + p3) / 3 - actual)) AS att
      FROM {SCORES_SQL} GROUP BY day)
""")
def compare_models(spark, sf_dir):
    """Per day: single-model vs mean-ensemble MSE, improvement % and who wins."""
    s = event_scores(spark, sf_dir)
    ens = (F.col("p1") + F.col("p2") + F.col("p3")) / 3
    g = s.groupBy(F.col("day").cast("string").alias("day")).agg(
        F.avg((F.col("p1") - F.col("actual")) ** 2).alias("trad"), F.avg((ens - F.col("actual")) ** 2).alias("att"))
    return g.select("day", F.round("trad", 6).alias("trad_mse"), F.round("att", 6).alias("att_mse"),
                    F.round(F.try_divide(F.col("trad") - F.col("att"), F.col("trad")) * 100, 6).alias("improvement_pct"),
                    (F.col("att") < F.col("trad")).cast("int").alias("attention_wins"))


_LINE_SQL = ("(SELECT l_orderkey, l_linenumber, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS line_id "
             "FROM lineitem)")


@query("random_subset", sql=" UNION ALL ".join(
    f"(SELECT {it} AS iteration, l_orderkey, l_linenumber FROM {_LINE_SQL} ORDER BY md5(line_id || '|{it}'), line_id LIMIT 8000)"
    for it in (1, 2, 3)))
def random_subset(spark, sf_dir):
    """Per improvement cycle, a capped subset without replacement, seeded by the cycle number."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("line_id"))
    parts = [SP.sample_cap(li, "line_id", 8000, seed=it).select(F.lit(it).alias("iteration"), "l_orderkey", "l_linenumber")
             for it in (1, 2, 3)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
