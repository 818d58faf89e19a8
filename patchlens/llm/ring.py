"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points of the 64-bit ring.  A row's key hashes to a
ring position and the row belongs to the shard of the next point clockwise; a
shard that is full passes the row on to the next point clockwise whose shard
has room.  Capacities are exact: ``n // shards`` rows each, and one more for
the ``n % shards`` shards with the largest home load, so shard counts differ by
one at most (law ``rows``) and only overflowing rows leave their home shard.

Spark does the work on rows: one narrow scan, a count per arc, and a rank
inside (arc, sub-bucket).  The walk around the ring needs only the counts per
arc, a table of ``shards * vnodes`` rows whatever the input, and yields
segments (arc, from, to, shard, first slot), which are joined back by
broadcast: at most one segment per arc and vnode passed.
"""

from __future__ import annotations

import bisect
import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchlens.llm.common import preceding_sum, settle

VNODES = 128
#: Rows that meet in one rank window.
BUCKET_ROWS = 20_000
_TOP = float(2**63)


def ring_points(n_shards: int, vnodes: int = VNODES, seed: int = 0) -> list[tuple[int, int]]:
    """(position, shard) of all virtual nodes, by position (signed 64 bits)."""
    points = []
    for shard in range(n_shards):
        for v in range(vnodes):
            digest = hashlib.blake2b(f"{seed}/{shard}/{v}".encode(), digest_size=8).digest()
            points.append((int.from_bytes(digest, "big", signed=True), shard))
    return sorted(points)


def capacities(homes: list[int], n_rows: int) -> list[int]:
    """Rows each shard may hold: equal, the remainder to the largest home loads."""
    k = len(homes)
    caps = [n_rows // k] * k
    for shard in sorted(range(k), key=lambda s: (-homes[s], s))[: n_rows % k]:
        caps[shard] += 1
    return caps


def walk(points: list[tuple[int, int]], counts: dict[int, int], n_shards: int) -> list[tuple[int, int, int, int, int]]:
    """Segments (arc, from, to, shard, first slot) of the bounded-load walk.

    In each round every arc's waiting rows, in ring order, enter the shard of
    the vnode they stand at, as far as it has room; the rest step to the next
    vnode.  A full shard never gets room again, so after one trip round the
    ring every row is placed.
    """
    homes = [0] * n_shards
    for arc, n in counts.items():
        homes[points[arc][1]] += n
    room = capacities(homes, sum(counts.values()))
    placed = [0] * n_shards
    waiting = {arc: (0, n) for arc, n in sorted(counts.items()) if n}
    segments = []
    step = 0
    while waiting:
        rest = {}
        for arc, (start, n) in waiting.items():
            shard = points[(arc + step) % len(points)][1]
            take = min(n, room[shard])
            if take:
                segments.append((arc, start, start + take, shard, placed[shard]))
                placed[shard] += take
                room[shard] -= take
            if n > take:
                rest[arc] = (start + take, n - take)
        waiting = rest
        step += 1
    return segments


def shard_rows(keys: DataFrame, n_shards: int = 8, vnodes: int = VNODES, seed: int = 0) -> DataFrame:
    """Add ``shard``, ``slot``, ``home_shard`` to (doc_id, size, text_crc32).

    A null doc_id hashes by its text's size and checksum.  Rows equal in all
    three columns are interchangeable and get neighbouring slots.  An empty
    table yields an empty result.
    """
    spark = keys.sparkSession
    points = ring_points(n_shards, vnodes, seed)
    positions = np.array([p for p, _ in points], dtype=np.int64)

    @F.pandas_udf(T.IntegerType())
    def arc_of(position: pd.Series) -> pd.Series:
        return pd.Series((np.searchsorted(positions, position.to_numpy(), side="left") % len(positions)).astype(np.int32))

    own = F.xxhash64(F.lit(seed), F.col("doc_id"))
    anonymous = F.xxhash64(F.lit(seed), F.lit("text"), F.col("text_crc32"), F.col("size"))
    base = settle(keys.select("doc_id", "size", "text_crc32")
                  .withColumn("arc", arc_of(F.when(F.col("doc_id").isNull(), anonymous).otherwise(own)))
                  .withColumn("place", F.xxhash64(F.lit(seed + 1), "doc_id", "size", "text_crc32")))
    counts = {r["arc"]: r["n"] for r in base.groupBy("arc").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= shards * vnodes rows
    segments = walk(points, counts, n_shards)
    seg = spark.createDataFrame(segments, "arc int, seg_from long, seg_to long, shard int, first_slot long")
    table = F.broadcast(seg.groupBy("arc").agg(F.collect_list(F.struct("seg_from", "seg_to", "shard", "first_slot")).alias("segs")))

    n_sub = max(1, -(-max(counts.values(), default=0) // BUCKET_ROWS))
    # place in [-2^63, 2^63) -> n_sub equal ranges, so sub-bucket order agrees with place order
    sub = F.least(F.floor((F.col("place").cast("double") / _TOP + 1) / 2 * n_sub), F.lit(n_sub - 1)).cast("int")
    ranked = preceding_sum(base.withColumn("sub", sub).withColumn("one", F.lit(1).cast("bigint")), ["arc"], "sub",
                           ["place", "doc_id", "size", "text_crc32"], "one", "pos")
    home = F.element_at(F.array(*[F.lit(s) for _, s in points]), F.col("arc") + 1)
    joined = ranked.join(table, "arc").withColumn(
        "seg", F.filter("segs", lambda s: (s["seg_from"] <= F.col("pos")) & (F.col("pos") < s["seg_to"]))[0])
    return joined.select("doc_id", "size", "text_crc32", F.col("seg.shard").alias("shard"),
                         (F.col("seg.first_slot") + F.col("pos") - F.col("seg.seg_from")).cast("bigint").alias("slot"),
                         home.alias("home_shard"))


def shard_documents(docs: DataFrame, n_shards: int = 8, vnodes: int = VNODES, seed: int = 0) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, home_shard.

    size is the text's UTF-8 bytes plus 1 and text_crc32 its unsigned CRC-32 (a
    null text counts as empty).  Slots of a shard run from 0 without a gap.
    """
    text = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    keys = docs.select("doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"))
    out = shard_rows(keys, n_shards, vnodes, seed)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "home_shard")


def place_of_key(position: int, points: list[tuple[int, int]]) -> int:
    """Arc of one ring position (the rule that ``shard_rows`` applies in bulk)."""
    return bisect.bisect_left([p for p, _ in points], position) % len(points)
