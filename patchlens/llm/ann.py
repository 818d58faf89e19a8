"""Nearest neighbours by a block matrix join over int8 tiles.

1. Vectors are packed into blocks: ids, original values and an int8 code each
   (one scale per vector), with the norm of what the code leaves over.
2. Queries form stripes of blocks, candidates stripes of blocks; a cell is one
   query stripe against one candidate stripe.  Both have a bounded number of
   bytes, so a task's memory does not grow with the table, and every cell is a
   task's group of its own.
3. In a cell, a tile is the product of two int8 blocks (exact in single
   precision: sums stay under 2^24).  For x = x' + r and y = y' + s with codes
   x', y':  |<x, y> - <x', y'>| <= |r| |y| + |x'| |s|.  Pairs whose product
   plus bound cannot reach the query's current k-th score are dropped; the rest
   are recomputed in double precision from the original vectors and pushed onto
   the query's heap of k.
4. Heaps of all cells are merged per query by a window that keeps k rows.

The bound makes the search exact, so recall is 1.  Of equal vectors only the
k + 1 smallest ids of a block can appear in any answer, so a vector repeated
many times costs k + 1 rows a block.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patchlens.llm.common import settle, tasks_for

K = 20
QUERY_EVERY = 20
#: Bytes of original values (as doubles) that one block holds at most, and a stripe at most and at least.
BLOCK_BYTES = 1 << 19
STRIPE_BYTES = 1 << 26
LEAST_STRIPE_BYTES = 1 << 20
QUERY_STRIPE_BYTES = 1 << 24
#: Values multiplied at a time, so that sums of 127 * 127 stay exact in single precision.
_EXACT_DIM = 1024

_BLOCK = "is_query boolean, dim int, n int, ids binary, keys binary, vectors binary, codes binary, scales binary, left binary, part binary"


def quantise(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes and scales of the rows of ``v``; norms of the rest and of the coded part."""
    top = np.abs(v).max(axis=1)
    scale = np.maximum(top / 127.0, np.finfo(np.float64).tiny)
    codes = np.clip(np.rint(v / scale[:, None]), -127, 127).astype(np.int8)
    coded = codes * scale[:, None]
    return codes, scale, np.linalg.norm(v - coded, axis=1), np.linalg.norm(coded, axis=1)


def int8_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of int8 rows, as doubles."""
    out = np.zeros((len(a), len(b)))
    for d in range(0, a.shape[1], _EXACT_DIM):
        out += a[:, d: d + _EXACT_DIM].astype(np.float32) @ b[:, d: d + _EXACT_DIM].astype(np.float32).T
    return out


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products in double precision, summed from the first component to the last."""
    return np.cumsum(a * b, axis=1)[:, -1]


class Block:
    """One packed block, as numpy views."""

    def __init__(self, row: dict):
        n, dim = row["n"], row["dim"]
        self.dim = dim
        self.ids, self.keys = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["keys"], np.int64)
        self.v = np.frombuffer(row["vectors"], np.float64).reshape(n, dim)
        self.codes = np.frombuffer(row["codes"], np.int8).reshape(n, dim)
        self.scale, self.left, self.part = (np.frombuffer(row[k], np.float64) for k in ("scales", "left", "part"))
        self.norm = np.linalg.norm(self.v, axis=1)


class Heaps:
    """The k best (score, smaller id first) of every query of a stripe."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(n)]
        self.floor = np.full(n, -np.inf)

    def push(self, q: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        for i, s, c in zip(q.tolist(), scores.tolist(), ids.tolist()):
            heap, item = self.heaps[i], (s, -c)
            if len(heap) < self.k:
                heapq.heappush(heap, item)
            elif item > heap[0]:
                heapq.heapreplace(heap, item)
            else:
                continue
            if len(heap) == self.k:
                self.floor[i] = heap[0][0]


def compare(q: Block, c: Block, heaps: Heaps, base: int) -> None:
    """Push the pairs of one tile that may be among a query's best; ``base`` is the block's first heap."""
    approx = int8_product(q.codes, c.codes) * q.scale[:, None] * c.scale[None, :]
    bound = q.left[:, None] * c.norm[None, :] + q.part[:, None] * c.left[None, :]
    # room for the rounding of norms, products and the double-precision sums themselves
    bound = bound * (1 + 1e-9) + (q.norm[:, None] * c.norm[None, :]) * (1e-12 + 4e-16 * q.dim) + 1e-300
    low = approx - bound
    own = q.keys[:, None] == c.keys[None, :]
    low[own] = -np.inf
    rows = slice(base, base + len(q.ids))
    floor = heaps.floor[rows]
    if len(c.ids) > heaps.k:
        floor = np.maximum(floor, -np.partition(-low, heaps.k - 1, axis=1)[:, heaps.k - 1])
    i, j = np.nonzero((approx + bound >= floor[:, None]) & ~own)
    for at in range(0, len(i), 1 << 15):
        ii, jj = i[at: at + (1 << 15)], j[at: at + (1 << 15)]
        heaps.push(ii + base, inner(q.v[ii], c.v[jj]), c.ids[jj])


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): the rows with an id, without vectors that are null, zero or hold null or non-finite values."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    d = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), v.alias("v")).filter("vec_id is not null and v is not null")
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return d.filter(sound)


def pack(rows: DataFrame, every: int, k: int) -> DataFrame:
    """Blocks of candidates and, again, of the queries among them.

    A row's key (its task and place in it) tells it from others with its id; both of its copies carry it.
    """

    def packed(is_query, dim, ids, keys, v):
        if not is_query:
            order = np.argsort(ids, kind="stable")
            ids, keys, v = ids[order], keys[order], v[order]
            same = np.unique(v, axis=0, return_inverse=True)[1].reshape(-1)
            by_value = np.lexsort((ids, same))
            starts = np.flatnonzero(np.diff(same[by_value], prepend=-1))
            rank = np.arange(len(ids)) - np.repeat(starts, np.diff(np.append(starts, len(ids))))
            keep = np.sort(by_value[rank <= k])
            ids, keys, v = ids[keep], keys[keep], v[keep]
        v = np.ascontiguousarray(v)
        codes, scale, left, part = quantise(v)
        return {"is_query": is_query, "dim": dim, "n": len(ids), "ids": ids.tobytes(), "keys": keys.tobytes(), "vectors": v.tobytes(), "codes": codes.tobytes(),
                "scales": scale.tobytes(), "left": left.tobytes(), "part": part.tobytes()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[bool, int], list] = {}
        first = TaskContext.get().partitionId() << 40

        def flush(key):
            parts = held.pop(key)
            row = packed(*key, *(np.concatenate(c) for c in zip(*parts)))
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        for b in batches:
            ids, lists = b.column(0).to_numpy(), b.column(1)
            keys = first + np.arange(len(ids))
            first += len(ids)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            flat, ends = lists.flatten().to_numpy(), np.cumsum(sizes)
            for dim in map(int, np.unique(sizes)):
                room = max(1, BLOCK_BYTES // (8 * dim))
                for is_query in (False, True):
                    mine = np.flatnonzero((sizes == dim) & ((ids % every == 0) | (not is_query)))
                    for at in range(0, len(mine), room):
                        part = mine[at: at + room]
                        v = flat[(ends[part] - dim)[:, None] + np.arange(dim)[None, :]]
                        held.setdefault((is_query, dim), []).append((ids[part], keys[part], v))
                        if sum(len(x[0]) for x in held[is_query, dim]) >= room:
                            yield flush((is_query, dim))
        for key in list(held):
            yield flush(key)

    kinds = {"boolean": pa.bool_(), "int": pa.int32(), "binary": pa.binary()}
    arrow = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in _BLOCK.split(", ")])
    return rows.mapInArrow(run, _BLOCK)


def nearest(vectors: DataFrame, k: int = K, every: int = QUERY_EVERY, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of every row whose id is divisible by ``every``.

    Candidates are all other rows of the query's dimension.  Vectors that are
    null, zero, or hold null or non-finite components take no part, nor do rows
    without an id.  Rows that repeat an id are rows of their own: each is a
    candidate of the others, and each is a query with its own ranks.  Ties go to the smaller id.  With fewer than k candidates all are
    listed; an empty table gives an empty result.
    """
    blocks = settle(pack(usable(vectors, id_col, vector_col), every, k).withColumn("block", F.xxhash64("keys")))
    # the order of the blocks only deals them to cells; one narrow row a block
    size = F.col("n").cast("bigint") * F.col("dim") * 8
    everyone = Window.partitionBy("is_query", "dim")
    before = F.coalesce(F.sum("bytes").over(everyone.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # every query gets k rows from each candidate stripe, so there are no more stripes than tasks or their size asks for
    share = F.sum("bytes").over(everyone) / (2 * vectors.sparkSession.sparkContext.defaultParallelism)
    width = F.when(F.col("is_query"), F.lit(float(QUERY_STRIPE_BYTES))).otherwise(
        F.greatest(F.lit(float(LEAST_STRIPE_BYTES)), F.least(F.lit(float(STRIPE_BYTES)), share)))
    facts = blocks.select("is_query", "dim", "block", size.alias("bytes"))
    facts = settle(facts.select("is_query", "dim", "block", F.floor(before / width).cast("int").alias("stripe")))
    stripes = facts.groupBy("dim").agg(F.max(F.when(F.col("is_query"), F.col("stripe"))).alias("q"),
                                       F.max(F.when(~F.col("is_query"), F.col("stripe"))).alias("c")).filter("q is not null")
    other = F.explode(F.sequence(F.lit(0), F.when(F.col("is_query"), F.col("c")).otherwise(F.col("q"))))
    dealt = (blocks.join(facts, ["is_query", "dim", "block"])
             .join(stripes, "dim").withColumn("other", other)
             .withColumn("q_stripe", F.when(F.col("is_query"), F.col("stripe")).otherwise(F.col("other")))
             .withColumn("c_stripe", F.when(F.col("is_query"), F.col("other")).otherwise(F.col("stripe"))))
    cell = ["dim", "q_stripe", "c_stripe"]
    names = [c.split()[0] for c in _BLOCK.split(", ")]

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        queries = [Block(r) for r in rows if r["is_query"]]
        heaps = Heaps(sum(len(q.ids) for q in queries), k)
        for r in rows:
            if not r["is_query"]:
                c, base = Block(r), 0
                for q in queries:
                    compare(q, c, heaps, base)
                    base += len(q.ids)
        ids = np.concatenate([q.ids for q in queries]) if queries else np.empty(0, np.int64)
        keys = np.concatenate([q.keys for q in queries]) if queries else np.empty(0, np.int64)
        found = [(key, qid, -c, s) for key, qid, heap in zip(keys.tolist(), ids.tolist(), heaps.heaps) for s, c in heap]
        cols = list(zip(*found)) if found else [[], [], [], []]
        return pa.table([pa.array(c, type=t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.float64()))],
                        names=["query_key", "query_id", "vec_id", "score"])

    n_cells = stripes.agg(F.sum((F.col("q") + 1) * (F.col("c") + 1))).first()[0] or 1
    # a cell's work does not show in its bytes: a given number of partitions, which adaptive execution does not merge
    dealt = dealt.select(*cell, *[c for c in names if c != "dim"]).repartition(tasks_for(vectors.sparkSession, n_cells), *cell)
    best = dealt.groupBy(*cell).applyInArrow(run, "query_key long, query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_key").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
