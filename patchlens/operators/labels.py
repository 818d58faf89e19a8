"""Label join, subject filters and repeatable limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patchlens import config
from patchlens.functions.text import keyword_pattern, rlike_ci


def attach_label(patches: DataFrame, links: DataFrame, key: str, dedup: bool = False,
                 label: str = "accepted") -> DataFrame:
    """patches ⟕ links on ``key``; label = 1 when a link matched.

    A patch linked to k commits yields k rows unless ``dedup``.  The link
    side is reduced to its key column before the join (column pruning), and
    with ``dedup`` it is made distinct first: a partial aggregation, so a hot
    key is combined map-side before the shuffle.  Join strategy is left to
    AQE (broadcast only when the measured link side is small; skewed keys are
    split by the skew-join rule).
    """
    right = links.select(F.col(key).alias("__link_key"))
    if dedup:
        right = right.dropDuplicates(["__link_key"])
    j = patches.join(right, patches[key] == right["__link_key"], "left")
    return j.withColumn(label, F.when(F.col("__link_key").isNotNull(), 1).otherwise(0)).drop("__link_key")


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull())


def keyword_filter(df: DataFrame, col: str, keywords=None) -> DataFrame:
    """OR-joined regex, case-insensitive substring search; null excluded."""
    keywords = keywords or config.SCHEDULING_KEYWORDS
    return df.filter(rlike_ci(col, keyword_pattern(keywords)))


def regexp_min_length(df: DataFrame, col: str, pattern: str = config.GENERATOR_SUBJECT_REGEXP,
                      min_bytes: int = config.GENERATOR_MIN_SUBJECT_BYTES) -> DataFrame:
    """SQL-side filter of the generator loader: regexp and byte length > n."""
    c = F.col(col)
    return df.filter(c.isNotNull() & rlike_ci(c, pattern) & (F.octet_length(c) > min_bytes))


TOP_N_GROUPS = 64


def top_n(df: DataFrame, n: int, order_col: str, descending: bool = False, tiebreak: list[str] | None = None,
          groups: int = TOP_N_GROUPS) -> DataFrame:
    """The first ``n`` rows by (``order_col`` [desc], *tiebreak``), exactly, for any column type.

    A plain ``orderBy(...).limit(n)`` merges n rows from every input
    partition in one task.  Here the partitions are dealt to ``groups``
    groups: each partition hands on at most n rows (the window's limit is
    applied before the shuffle), each group keeps n, and the last step merges
    ``groups * n`` rows, whatever the number of partitions.  Nulls come first
    in ascending and last in descending order, as in a plain sort.
    """
    order = [F.desc(order_col) if descending else F.asc(order_col)] + [F.asc(t) for t in (tiebreak or [])]
    dealt = df.withColumn("_group", F.spark_partition_id() % groups)
    first = dealt.withColumn("_place", F.row_number().over(Window.partitionBy("_group").orderBy(*order)))
    return first.filter(F.col("_place") <= n).drop("_group", "_place").orderBy(*order).limit(n)


def limit_rows(df: DataFrame, n: int, order_by: str) -> DataFrame:
    """LIMIT n made repeatable by a total order on ``order_by`` (see ``top_n``)."""
    return top_n(df, n, order_by)


def add_constant(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def trainable_groups(df: DataFrame, group_col: str, target_cols: list[str], min_rows: int = 50,
                     min_classes: int = 2) -> DataFrame:
    """Per (group, target): rows, distinct values and whether a model can be fit.

    One partial aggregation over the data; ``count_distinct`` per target is
    expanded by Catalyst into a single Expand + two-phase aggregate.
    """
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for t in target_cols:
        aggs.append(F.count_distinct(F.col(t)).alias(f"nd_{t}"))
    g = df.groupBy(group_col).agg(*aggs)
    stack = ", ".join(f"'{t}', nd_{t}" for t in target_cols)
    long = g.selectExpr(group_col, "n_rows", f"stack({len(target_cols)}, {stack}) AS (target, n_distinct)")
    return long.withColumn(
        "trainable",
        ((F.col("n_rows") >= min_rows) & (F.col("n_distinct") >= min_classes)).cast("int"),
    )
