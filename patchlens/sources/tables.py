"""Parquet tables and the patch-review views derived from them.

The analysed tool reads a relational patch corpus (patch, commit_to_patch,
author tables).  Here the same shapes are derived from the test tables:

* ``patch_view``: one row per document - patch_id, subject (the whole text),
  author_email and send_time (epoch ms) from the matching event.
* ``commit_links``: the label side of the left join (documents that have a
  ``labels`` row count as linked).

All views are lazy DataFrames; Catalyst prunes the columns a caller does not
use down to the parquet scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
]

# --- fixed values: author domains of the binding (user_id % 5 picks one) ---
AUTHOR_DOMAINS = ["kernel.org", "example.com", "redhat.com", "gmail.com", "intel.com"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def register_views(spark: SparkSession, sf_dir: str) -> None:
    for name in TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def author_email_expr(user_id: str = "user_id"):
    domains = F.array(*[F.lit(d) for d in AUTHOR_DOMAINS])
    idx = (F.col(user_id) % len(AUTHOR_DOMAINS) + 1).cast("int")
    return F.concat(F.lit("u"), F.col(user_id).cast("string"), F.lit("@"), F.element_at(domains, idx))


def patch_source(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None,
                 events: DataFrame | None = None) -> DataFrame:
    """The ``patch`` table: patch_id, subject, author_email, send_time (ms).

    documents ⟕ events on doc_id = event_id.  Both sides grow with the data,
    so no broadcast is forced; AQE picks broadcast at runtime only when the
    measured event side is small.
    """
    docs = (docs if docs is not None else table(spark, sf_dir, "documents")).select(
        F.col("doc_id").alias("patch_id"), F.col("text").alias("subject"))
    ev = (events if events is not None else table(spark, sf_dir, "events")).select(
        F.col("event_id").alias("patch_id"),
        author_email_expr("user_id").alias("author_email"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("send_time"),
    )
    return docs.join(ev, "patch_id", "left")


def commit_links(spark: SparkSession, sf_dir: str, labels: DataFrame | None = None) -> DataFrame:
    """``commit_to_patch``: one row per link (patch_id)."""
    return (labels if labels is not None else table(spark, sf_dir, "labels")).select(F.col("doc_id").alias("patch_id"))


def patch_view(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None, events: DataFrame | None = None,
               labels: DataFrame | None = None) -> DataFrame:
    """Labelled patch frame: the five columns of the label query.

    ``docs``/``events``/``labels`` may be given as (e.g. bucketed) tables;
    by default the parquet files under ``sf_dir`` are read.
    """
    from patchlens.operators.labels import attach_label

    return attach_label(patch_source(spark, sf_dir, docs, events), commit_links(spark, sf_dir, labels), "patch_id")


# SQL text of the same view, for DuckDB oracle queries.
PATCH_VIEW_SQL = """
(SELECT d.doc_id AS patch_id, d.text AS subject,
        concat('u', e.user_id, '@',
               ['kernel.org','example.com','redhat.com','gmail.com','intel.com'][e.user_id % 5 + 1]) AS author_email,
        epoch_us(e.ts) // 1000 AS send_time,
        CASE WHEN l.doc_id IS NOT NULL THEN 1 ELSE 0 END AS accepted
 FROM documents d
 LEFT JOIN events e ON d.doc_id = e.event_id
 LEFT JOIN labels l ON d.doc_id = l.doc_id)
"""
