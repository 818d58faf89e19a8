"""Co-partitioned storage layout for id joins.

Documents, events and labels are joined on the patch id in almost every
query.  Written once as bucketed tables with the same bucket count on that
id, each side is already hash-partitioned and sorted by it, so the joins run
as sort-merge joins with no exchange on either side: the wide text side is
never shuffled again.  Tables go to the catalog's warehouse (a shared folder
on a cluster).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PATCH_LAYOUT = {"documents": "doc_id", "events": "event_id", "labels": "doc_id"}


BUCKET_BYTES = 256 * 1024 * 1024


def buckets_for(df: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Bucket count for about ``bucket_bytes`` of input per bucket, at least one per shuffle partition of a small table."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(8, -(-size // bucket_bytes))


def write_bucketed(df: DataFrame, name: str, key: str, n_buckets: int) -> None:
    df.write.mode("overwrite").bucketBy(n_buckets, key).sortBy(key).saveAsTable(name)


def build_patch_layout(spark: SparkSession, sf_dir: str, db: str, n_buckets: int) -> dict[str, str]:
    """Write documents/events/labels bucketed by their id into database ``db``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    out = {}
    for name, key in PATCH_LAYOUT.items():
        fq = f"{db}.{name}"
        write_bucketed(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"), fq, key, n_buckets)
        out[name] = fq
    return out


def bucketed_patch_tables(spark: SparkSession, names: dict[str, str]) -> dict[str, DataFrame]:
    return {k: spark.table(v) for k, v in names.items()}

