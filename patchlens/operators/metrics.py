"""Classification and regression metrics as grouped aggregations.

Every metric is computed by one partial aggregation (optionally grouped by a
model column), so millions of scored rows reduce map-side before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.ml.feature import Bucketizer

from patchlens.operators.stats import bucket_bounds


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(a: Column, b: Column) -> Column:
    """a / b, 0 when the denominator is 0 (ANSI-safe)."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def confusion_aggs(actual, predicted) -> list[Column]:
    a, p = _c(actual).cast("boolean"), _c(predicted).cast("boolean")
    return [
        F.count_if(a & p).alias("tp"),
        F.count_if(~a & p).alias("fp"),
        F.count_if(~a & ~p).alias("tn"),
        F.count_if(a & ~p).alias("fn"),
    ]


def with_rates(df: DataFrame) -> DataFrame:
    """accuracy, precision, recall, F1 from tp/fp/tn/fn; 0 on zero denominators."""
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    prec = safe_div(tp, tp + fp)
    rec = safe_div(tp, tp + fn)
    return df.withColumns({
        "accuracy": safe_div(tp + tn, tp + fp + tn + fn),
        "precision": prec,
        "recall": rec,
    }).withColumn("f1", safe_div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def confusion(df: DataFrame, actual, predicted, by: list[str] | None = None) -> DataFrame:
    g = df.groupBy(*(by or []))
    return with_rates(g.agg(*confusion_aggs(actual, predicted), F.count(F.lit(1)).alias("total")))


def score_counts(df: DataFrame, score: str, label: str, by: list[str] | None = None) -> DataFrame:
    """Collapse scored rows to (by..., _s, _pos, _neg): one partial aggregation.

    Every rank metric and every thresholded confusion count is a function of
    this table, so a raw scored table is read once for all of them.  Null
    scores are kept (as _s = null) for the confusion counts; rows without a
    label are left out.
    """
    y = _c(label).cast("int")
    return df.filter(y.isNotNull()).groupBy(*(by or []), F.col(score).alias("_s")).agg(
        F.sum(F.when(y == 1, 1).otherwise(0)).cast("double").alias("_pos"),
        F.sum(F.when(y == 1, 0).otherwise(1)).cast("double").alias("_neg"),
    )


def confusion_from_counts(c: DataFrame, by: list[str] | None = None, threshold: float = 0.5) -> DataFrame:
    """tp/fp/tn/fn for predicted = score > threshold (null -> negative), plus rates."""
    pred = F.coalesce(F.col("_s") > threshold, F.lit(False))
    g = c.groupBy(*(by or [])).agg(
        F.sum(F.when(pred, F.col("_pos")).otherwise(0.0)).cast("bigint").alias("tp"),
        F.sum(F.when(pred, F.col("_neg")).otherwise(0.0)).cast("bigint").alias("fp"),
        F.sum(F.when(pred, 0.0).otherwise(F.col("_neg"))).cast("bigint").alias("tn"),
        F.sum(F.when(pred, 0.0).otherwise(F.col("_pos"))).cast("bigint").alias("fn"),
    )
    return with_rates(g)


def roc_auc(df: DataFrame | None, score: str, label: str, by: list[str] | None = None, n_buckets: int | None = None,
            counts: DataFrame | None = None) -> DataFrame:
    """Exact rank AUC (Mann-Whitney, ties averaged); 0.5 for a single class.

    1. collapse to (group, score) -> (pos, neg) counts (partial aggregation),
       or take them from ``counts`` (see ``score_counts``);
    2. bucket distinct scores by approximate quantile bounds (exactness does
       not depend on the bounds, only balance does);
    3. negatives below each score = prefix over buckets (small table) +
       prefix inside the bucket (window per (group, bucket));
    4. AUC = sum(pos * (neg_below + neg_tied / 2)) / (P * N).
    """
    by = by or []
    c = counts if counts is not None else score_counts(df, score, label, by)
    c = c.filter(F.col("_s").isNotNull())
    c = Bucketizer(splits=bucket_bounds(c, "_s", n_buckets), inputCol="_s", outputCol="_b", handleInvalid="keep").transform(
        c.withColumn("_s", F.col("_s").cast("double")))
    bt = c.groupBy(*by, "_b").agg(F.sum("_neg").alias("_bneg"))
    wb = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    bt = bt.withColumn("_boff", F.coalesce(F.sum("_bneg").over(wb), F.lit(0.0))).drop("_bneg")
    wi = Window.partitionBy(*by, "_b").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    c = c.withColumn("_inb", F.coalesce(F.sum("_neg").over(wi), F.lit(0.0)))
    j = c.join(bt, [*by, "_b"], "inner")
    agg = j.groupBy(*by).agg(
        F.sum(F.col("_pos") * (F.col("_boff") + F.col("_inb") + F.col("_neg") / 2.0)).alias("_u"),
        F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n"),
    )
    auc = F.when((F.col("_p") == 0) | (F.col("_n") == 0), F.lit(0.5)).otherwise(F.col("_u") / (F.col("_p") * F.col("_n")))
    return agg.select(*by, auc.alias("auc"))


def mse_r2(df: DataFrame, y: str, yhat, by: list[str] | None = None) -> DataFrame:
    """MSE and R^2 = 1 - SSE/SST (SST = 0 -> null) in one pass."""
    yy, yh = F.col(y).cast("double"), _c(yhat).cast("double")
    g = df.groupBy(*(by or [])).agg(
        F.avg((yy - yh) * (yy - yh)).alias("mse"),
        F.sum((yy - yh) * (yy - yh)).alias("_sse"),
        (F.sum(yy * yy) - F.sum(yy) * F.sum(yy) / F.count(yy)).alias("_sst"),
    )
    return g.withColumn("r2", F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("_sst"))).drop("_sse", "_sst")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Per class: count, 'balanced' weight n/(k*n_c) and scale_pos_weight = neg/max(pos,1)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    w = Window.partitionBy()  # over the per-class table: a handful of rows
    n = F.sum("n_class").over(w)
    k = F.count(F.lit(1)).over(w)
    neg = F.sum(F.when(F.col(label) == 0, F.col("n_class")).otherwise(0)).over(w)
    pos = F.sum(F.when(F.col(label) == 1, F.col("n_class")).otherwise(0)).over(w)
    return counts.select(
        label, "n_class",
        (n / (k * F.col("n_class"))).alias("balanced_weight"),
        (neg / F.greatest(pos, F.lit(1))).alias("scale_pos_weight"),
    )


def weight_column(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Attach the 'balanced' class weight to each row (for MLlib ``weightCol``).

    The per-class table has one row per class; how it is joined is left to the planner.
    """
    w = class_weights(df, label).select(F.col(label).alias("_w_label"), F.col("balanced_weight").alias(out))
    # null-safe: rows with a null label get the weight of the null class
    return df.join(w, F.col(label).eqNullSafe(F.col("_w_label")), "left").drop("_w_label")


def ensemble_weights(val_scores: DataFrame, model: str, actual: str, score: str, threshold: float = 0.5) -> dict:
    """Validation F1 per model, normalised to sum 1 (sum 0 -> divide by 1).

    Returns a small {model: weight} dict (one entry per model).
    """
    m = confusion(val_scores.withColumn("_pred", F.col(score) > threshold), actual, "_pred", by=[model])
    rows = m.select(model, "f1").collect()
    total = sum(r["f1"] for r in rows) or 1.0
    return {r[model]: r["f1"] / total for r in rows}


def weighted_ensemble(wide: DataFrame, weights: dict, threshold: float = 0.5, out: str = "ens") -> DataFrame:
    """Sum of w * p over the model score columns; class = p > threshold (strict)."""
    if len(weights) < 2:
        raise ValueError("an ensemble needs at least two models")
    p = None
    for m, w in weights.items():
        e = F.lit(float(w)) * F.col(m)
        p = e if p is None else p + e
    return wide.withColumn(f"{out}_proba", p).withColumn(f"{out}_class", (F.col(f"{out}_proba") > threshold).cast("int"))
