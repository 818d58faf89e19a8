"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patchlens.session import ensure_checkpoint_dir

#: A word is a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Side tables are broadcast up to this many bytes; beyond it the join is left to the planner.
BROADCAST_BYTES = 64 * 1024 * 1024


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the cluster's shared ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Cut lineage: compute ``df`` once into the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def bounded_broadcast(df: DataFrame, n_bytes: int) -> DataFrame:
    """Broadcast hint only for a table whose measured size is within the bound."""
    return F.broadcast(df) if n_bytes <= BROADCAST_BYTES else df


def tasks_for(spark: SparkSession, units: int) -> int:
    """Partitions for work that its bytes do not show: one per unit, and no fewer than a shuffle has or the cores."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism, units)


def word_count(text: Column) -> Column:
    """Number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def preceding_sum(df: DataFrame, parts: list[str], bucket: str, order: list, amount: str, out: str,
                  totals: DataFrame | None = None) -> DataFrame:
    """Add ``out``: the sum of ``amount`` over the rows before this one, within ``parts``.

    Rows are ordered by (``bucket``, ``order``).  Only the rows of one (parts,
    bucket) pair meet in a window; the pairs' totals are summed apart, so a hot
    part is spread over its buckets.  ``parts`` and ``bucket`` hold no nulls.
    ``totals`` may come from a narrower copy of the same rows.
    """
    keys = [*parts, bucket]
    if totals is None:
        totals = df.groupBy(*keys).agg(F.sum(amount).alias("_t"))
    before = Window.partitionBy(*parts).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = df.withColumn("_in", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    return ranked.join(offsets, keys, "left").withColumn(out, F.col("_off") + F.col("_in")).drop("_off", "_in")


def row_hash(docs: DataFrame, row: str | None = None) -> Column:
    """Hash of all columns of ``docs`` (inside its struct column ``row``, if given); columns that hold maps count as JSON."""
    prefix = f"{row}." if row else ""
    fields = {f.name: F.col(f"{prefix}`{f.name}`") for f in docs.schema.fields}
    maps = [f.name for f in docs.schema.fields if "map<" in f.dataType.simpleString()]
    if row and not maps:
        return F.xxhash64(row)
    return F.xxhash64(F.struct(*[F.to_json(F.struct(c)).alias(n) if n in maps else c.alias(n) for n, c in fields.items()]))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
