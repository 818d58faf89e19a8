"""SimHash near-dedup by tiled exact comparison.

1. A vectorised Python stage turns each whole text into a 64-bit fingerprint:
   ASCII lower case, words, word shingles with repeats, XXH64 with seed 42, and
   a bit per position set in more than half of the hashes.
2. Distinct fingerprints (copies collapse here, by partial aggregation) are cut
   into tiles by the population counts of their two halves, and a full cell
   into several tiles by hash, so a tile holds about TILE_ROWS.
3. Two tiles meet only if their counts differ by no more than the radius:
   |pop(a) - pop(b)| per half, summed, is a lower bound of the bit distance.
   Inside a tile pair the same test on the quarters skips blocks; what is left
   is compared exactly with numpy's xor and bit count.
4. A tile pair reports only a spanning forest of its links (at most one edge a
   fingerprint), never all pairs of a group; components join the forests.

No link is lost: every pair within the radius is compared, and an edge left out
joins two fingerprints that its forest joins already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchlens.llm.common import bounded_broadcast, free_name, row_hash, settle, tasks_for
from patchlens.llm.components import components

SHINGLE = 4
RADIUS = 4
SEED = 42
TILE_ROWS = 16_384
#: Shingles hashed at a time, so a very long text needs bounded memory.
_CHUNK = 1 << 16
_SIDE = 1024


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a whole text (no words or null: 0)."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest, n = xxhash.xxh64_digest, max(1, len(words) - shingle + 1)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _CHUNK):
        part = words[at: at + _CHUNK + shingle - 1]
        shifted = [part[i: i + n - at] for i in range(min(shingle, len(part)))]
        raw = b"".join([digest(b" ".join(s), SEED) for s in zip(*shifted)])
        ones += np.unpackbits(np.frombuffer(raw, dtype=np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, keep: list, shingle: int = SHINGLE) -> DataFrame:
    """The columns ``keep`` and the text's fingerprint ``fp`` (as a signed long)."""
    narrow = docs.select(*keep, F.col("text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = pa.array([_signed(fingerprint(t.as_py(), shingle)) for t in b.column("_text")], type=pa.int64())
            kept = [b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, fps], names=[*b.schema.names[:-1], "fp"])

    schema = T.StructType([*narrow.schema.fields[:-1], T.StructField("fp", T.LongType())])
    return narrow.mapInArrow(run, schema)


def _links(a: np.ndarray, b: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i of a, j of b) within ``radius`` bits, a bounded block at a time."""
    quarters = [(x.view(np.uint16).reshape(-1, 4), x) for x in (a, b)]
    counts = [np.bitwise_count(q).astype(np.int16) for q, _ in quarters]
    blocks = []
    for c in counts:
        order = np.lexsort(c.T)
        edges = np.flatnonzero(np.any(np.diff(c[order], axis=0) != 0, axis=1)) + 1
        starts = np.concatenate([[0], edges])
        blocks.append((order, starts, np.concatenate([edges, [len(order)]]), c[order[starts]]))
    (oa, sa, ea, ka), (ob, sb, eb, kb) = blocks
    for i in range(len(sa)):
        near = np.flatnonzero(np.abs(kb - ka[i]).sum(axis=1) <= radius)
        if not len(near):
            continue
        cols = np.concatenate([ob[sb[j]: eb[j]] for j in near])
        rows = oa[sa[i]: ea[i]]
        for r in range(0, len(rows), _SIDE):
            for c in range(0, len(cols), _SIDE):
                rr, cc = rows[r: r + _SIDE], cols[c: c + _SIDE]
                x, y = np.nonzero(np.bitwise_count(a[rr][:, None] ^ b[cc][None, :]) <= radius)
                if len(x):
                    yield rr[x], cc[y]


def spanning_edges(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Edges (fingerprint, root) that join all fingerprints linked across two tiles.

    ``a`` and ``b`` are uint64 arrays of distinct values; they may be the same tile.
    """
    nodes, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    ia, ib = where[: len(a)], where[len(a):]
    label = np.arange(len(nodes))
    for i, j in _links(a, b, radius):
        x, y = ia[i], ib[j]
        while True:
            low = np.minimum(label[x], label[y])
            if np.array_equal(low, label[x]) and np.array_equal(low, label[y]):
                break
            # hook the roots of both ends to the lower one, then point every node at its root
            np.minimum.at(label, label[x], low)
            np.minimum.at(label, label[y], low)
            while True:
                up = label[label]
                if np.array_equal(up, label):
                    break
                label = up
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return np.stack([nodes[moved], nodes[label[moved]]], axis=1).view(np.int64) if len(moved) else np.empty((0, 2), np.int64)


def tile_links(fps: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Edges (u, v) over the distinct values of ``fp`` that connect all pairs within ``radius`` bits."""
    low32 = F.lit(0xFFFFFFFF).cast("bigint")
    cells = settle(fps.select("fp", F.bit_count(F.shiftrightunsigned("fp", 32)).alias("hi"),
                              F.bit_count(F.col("fp").bitwiseAND(low32)).alias("lo")))
    sizes = settle(cells.groupBy("hi", "lo").agg(F.ceil(F.count(F.lit(1)) / tile_rows).cast("int").alias("subs")))
    n_tasks = tasks_for(fps.sparkSession, (sizes.agg(F.sum("subs")).first()[0] or 0) // 8)
    sizes = F.broadcast(sizes)  # at most 33 * 33 rows
    tiles = (cells.join(sizes, ["hi", "lo"]).withColumn("sub", F.pmod(F.xxhash64("fp"), F.col("subs")).cast("int"))
             .groupBy("hi", "lo", "sub").agg(F.collect_list("fp").alias("tile")))
    steps = [(x, y) for x in range(0, radius + 1) for y in range(-radius, radius + 1)
             if abs(x) + abs(y) <= radius and (x, y) >= (0, 0)]
    left = tiles.select("hi", "lo", F.col("sub").alias("sub_a"), F.col("tile").alias("a"), F.explode(F.array(*[
        F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in steps])).alias("step"))
    # the partner tile's own key, so that all its partners are dealt tile by tile
    left = (left.select("sub_a", "a", (F.col("hi") + F.col("step.x")).alias("hi"), (F.col("lo") + F.col("step.y")).alias("lo"),
                        ((F.col("step.x") == 0) & (F.col("step.y") == 0)).alias("same_cell"))
            .join(sizes, ["hi", "lo"]).withColumn("sub", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)))
            .filter(~F.col("same_cell") | (F.col("sub_a") <= F.col("sub"))))
    # few bytes but much work: a given number of partitions, which adaptive execution does not merge
    pairs = left.repartition(n_tasks, "hi", "lo", "sub").join(tiles, ["hi", "lo", "sub"]).select("a", F.col("tile").alias("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for i in range(batch.num_rows):
                a, b = (batch.column(k)[i].values.to_numpy().view(np.uint64) for k in (0, 1))
                found.append(spanning_edges(a, b, radius))
            edges = np.concatenate(found) if found else np.empty((0, 2), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(edges[:, 0]), pa.array(edges[:, 1])], names=["u", "v"])

    return pairs.mapInArrow(run, "u long, v long")


def classes(rows: DataFrame, representative, radius: int = RADIUS) -> DataFrame:
    """(fp, rep) per distinct fingerprint: the least ``representative`` of all rows its component holds."""
    own = settle(rows.groupBy("fp").agg(F.min(representative).alias("own")))
    roots = settle(components(tile_links(own, radius)))
    rooted = own.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "own", F.coalesce("root", "fp").alias("root"))
    reps = rooted.groupBy("root").agg(F.min("own").alias("rep"))
    return rooted.join(reps, "root").select("fp", "rep")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, fingerprint (hex), component_id.

    component_id is the smallest doc_id of the component.  Null and wordless
    texts have fingerprint zero and link like any other.  Null doc_ids never
    name a component that has another id; repeated rows stay as they are.  An
    empty table gives an empty result.
    """
    rows = settle(fingerprints(docs, ["doc_id"], shingle))
    found = classes(rows, F.col("doc_id"), radius)
    return rows.join(found, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                         F.col("rep").alias("component_id"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id (null ids last).

    Rows with the same id are told apart by a hash of all their columns; of rows
    equal in all columns one stays.
    """
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), row_hash(docs).alias("row"))
    rows = settle(fingerprints(docs, [key.alias("key")], shingle))
    kept = classes(rows, F.col("key"), radius).select(F.col("rep").alias("key")).distinct()
    kept = settle(rows.join(kept, "key", "left_semi").groupBy("key").agg(F.count(F.lit(1)).alias("n")))
    size = 48 * kept.count()
    name = free_name(docs, "_key")
    keyed = docs.withColumn(name, key)

    def matching(which):
        reps = bounded_broadcast(kept.filter(which).select(F.col("key").alias(name)), size)
        return keyed.join(reps, name, "left_semi")

    # only rows repeated in full need a shuffle to leave one of them
    return matching("n = 1").unionByName(matching("n > 1").dropDuplicates([name])).drop(name)
