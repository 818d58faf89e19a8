"""Structured Streaming form of a stateless operator (quality score over pages)."""

from __future__ import annotations

import os
import uuid

from patchlens.plans.catalog_generate import sql_quality
from patchlens.plans.registry import query
from patchlens.session import ensure_checkpoint_dir
from patchlens.streaming.quality import stream_quality


@query("stream_page_quality", sql=f"SELECT page_id, round({sql_quality('html')}, 6) AS quality FROM pages")
def stream_page_quality(spark, sf_dir):
    """pages.html scored as a stream (availableNow trigger, checkpointed parquet sink)."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/patchlens-stream/pages-{uuid.uuid4().hex[:10]}"
    src = os.path.join(sf_dir, "pages.parquet")
    schema = spark.read.parquet(src).schema
    # a streaming file source reads a folder: point it at the folder holding pages.parquet,
    # restricted to that file by a glob
    return stream_quality(spark, os.path.join(sf_dir, "pages*.parquet"), schema, "html", "page_id",
                          f"{base}/out", f"{base}/chk")
