"""ML matrix construction from a feature frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchlens.operators.labels import top_n

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)

DEFAULT_EXCLUDE = ("accepted", "patchwork_id", "patch_id", "send_time")


def ml_columns(df: DataFrame, exclude=DEFAULT_EXCLUDE, include_bool: bool = True, exclude_prefix: str | None = None) -> list[str]:
    """Number (+ bool) columns in schema order, minus exclusions."""
    out = []
    for f in df.schema.fields:
        ok = isinstance(f.dataType, NUMERIC) or (include_bool and isinstance(f.dataType, T.BooleanType))
        if not ok or f.name in exclude:
            continue
        if exclude_prefix and f.name.startswith(exclude_prefix):
            continue
        out.append(f.name)
    return out


def fill_zero(df: DataFrame, cols: list[str]) -> DataFrame:
    """Bool -> int, then null -> 0 (``fillna`` alone skips booleans)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    sel = []
    for c in df.columns:
        if c not in cols:
            sel.append(F.col(c))
        elif isinstance(types[c], T.BooleanType):
            sel.append(F.coalesce(F.col(c).cast("int"), F.lit(0)).alias(c))
        else:
            sel.append(F.coalesce(F.col(c), F.lit(0).cast(types[c])).alias(c))
    return df.select(*sel)


def ml_matrix(df: DataFrame, id_col: str, target: str, exclude=DEFAULT_EXCLUDE, include_bool: bool = True) -> DataFrame:
    """id, features (nulls -> 0, bools as 0/1) and the target."""
    cols = ml_columns(df, exclude=tuple(exclude) + (id_col, target), include_bool=include_bool)
    m = fill_zero(df.select(id_col, *cols, target), cols)
    return m


def align_columns(df: DataFrame, names: list[str], fill=0, keep: list[str] | None = None) -> DataFrame:
    """Reorder to ``names``, add missing ones as ``fill``, drop the rest."""
    have = set(df.columns)
    sel = [F.col(k) for k in (keep or [])]
    sel += [F.col(n) if n in have else F.lit(fill).alias(n) for n in names]
    return df.select(*sel)


def name_difference(names: list[str], exclude) -> list[str]:
    """Ordered set difference of names (schema-level; no data touched)."""
    ex = set(exclude)
    return [n for n in names if n not in ex]


def detect_text_column(df: DataFrame, candidates: list[str], order_by: str, sample: int = 10,
                       min_mean_len: float = 20.0, min_unique_ratio: float = 0.7) -> DataFrame:
    """Per candidate: mean length and unique ratio of its first ``sample``
    non-null values (by ``order_by``), and whether it qualifies.

    Each candidate's head is an exact top-k (``labels.top_n``), so neither a
    full sort nor a one-task merge of k rows per input partition is needed.
    """
    parts = []
    for i, c in enumerate([c for c in candidates if c in df.columns]):
        head = top_n(df.filter(F.col(c).isNotNull()).select(order_by, F.col(c).cast("string").alias("v")), sample, order_by)
        s = head.agg(
            F.avg(F.length("v")).alias("mean_len"),
            (F.count_distinct("v") / F.count("v")).alias("unique_ratio"),
        ).select(F.lit(i).alias("position"), F.lit(c).alias("candidate"), "mean_len", "unique_ratio")
        parts.append(s)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.withColumn(
        "qualifies", ((F.col("mean_len") > min_mean_len) & (F.col("unique_ratio") > min_unique_ratio)).cast("int"))
    # chosen: first qualifying candidate, else the frame's first string column
    # (window over the per-candidate table: one row per candidate)
    first_string = next((f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)), None)
    w = Window.partitionBy()
    first_ok = F.min(F.when(F.col("qualifies") == 1, F.col("position"))).over(w)
    return out.withColumn("chosen", F.when(first_ok.isNotNull(), F.col("position") == first_ok)
                          .otherwise(F.col("candidate") == F.lit(first_string)).cast("int"))
