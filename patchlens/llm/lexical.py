"""Ranked lexical search: term at a time, with a limited number of accumulators.

1. One scan counts the terms of every document and keeps, per document, the
   terms that some query holds with their occurrences (the postings).
2. The postings give every query term's document frequency; with the number of
   documents and of terms that fixes all weights.
3. Every task turns its postings, a bounded block at a time, into lists by
   term and runs each query over them, rarest term first.  A document that a
   list reaches gets an accumulator.  Once the sum of the largest
   contributions that the remaining terms can make is below the k-th best
   partial score, no document without an accumulator can reach the answer: no
   more are created, and the remaining terms only update those that exist, exactly.
   The k-th best complete score of the task's earlier blocks bounds later ones.
4. The tasks' k best per query are merged in two steps, so that no window holds
   all of a query's candidates.

Queries are taken in blocks of bounded size, each with a scan of its own, so
what is broadcast does not grow with the query table.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patchlens.llm.common import settle

K = 20
#: Characters of query text that are searched with one scan.
QUERY_CHARS = 1 << 22
#: Postings that a task holds at a time, and that one task searches in all.
BLOCK_POSTINGS = 1 << 21
TASK_POSTINGS = 1 << 23
#: Groups of tasks that the first merge works on.
MERGE = 32
# --- fixed values of the score ---
UNIT, TF_UNIT, TF_PLAIN, LENGTH_PART = 1_000_000_000, 1000, 12, 25

_POSTINGS = "doc_id long, n long, terms array<int>, tfs array<int>"
_HITS = "query int, doc_id long, score long, task int"


def _separators() -> bytes:
    """A table that lowers A-Z and makes every ASCII character but letters and digits a space."""
    return bytes(c if c > 0x7F or chr(c).isalnum() else 0x20 for c in range(256)).lower()


_TABLE = _separators()


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text: runs of ASCII letters, digits and characters beyond ASCII; A-Z are lowered."""
    return text.translate(_TABLE).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_norm(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of documents with ``n`` terms."""
    if n.size and int(n.max()) * n_docs * LENGTH_PART >= 1 << 63:
        n = n.astype(object)
    return (100 - LENGTH_PART + (LENGTH_PART * n * n_docs) // max(1, n_terms)).astype(np.int64)


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, number of terms, and the vocabulary's terms with their occurrences, per document."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8").alias("_text"))
    kinds = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = shared.value.get
        for b in batches:
            ns, sizes, terms, tfs = [], [0], [], []
            for text in b.column(1):
                words = terms_of(text.as_py())
                counts = Counter(map(get, words))
                counts.pop(None, None)
                ns.append(len(words))
                sizes.append(len(counts))
                terms.extend(counts)
                tfs.extend(counts.values())
            ends = pa.array(np.cumsum(sizes), pa.int32())
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(ns, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int32()))], schema=kinds)

    return narrow.mapInArrow(run, _POSTINGS)


class Best:
    """The k best (score, smaller doc_id first, null last) of one query."""

    def __init__(self, k: int):
        self.k = k
        self.scores = np.empty(0, np.int64)
        self.ids = np.empty(0, np.int64)
        self.null = np.empty(0, bool)

    def floor(self) -> int:
        """Documents that score less cannot enter."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        s, i, z = (np.concatenate(p) for p in ((self.scores, scores), (self.ids, ids), (self.null, null)))
        order = np.lexsort((i, z, -s))[: self.k]
        self.scores, self.ids, self.null = s[order], i[order], z[order]


class Block:
    """Postings of some documents as lists by term, with each posting's contribution."""

    def __init__(self, ids, null, n, sizes, terms, tfs, weights, n_docs, n_terms):
        self.ids, self.null = ids, null
        doc = np.repeat(np.arange(len(ids)), sizes)
        tfs = tfs.astype(np.int64)
        points = weights[terms] * ((UNIT * tfs) // (TF_UNIT * tfs + TF_PLAIN * length_norm(n, n_docs, n_terms)[doc]))
        order = np.argsort(terms, kind="stable")  # documents stay in order inside a list
        self.docs, self.points = doc[order], points[order]
        self.ends = np.cumsum(np.bincount(terms, minlength=len(weights)))
        self.most = np.zeros(len(weights), np.int64)
        np.maximum.at(self.most, terms, points)
        self.scores = np.zeros(len(ids), np.int64)

    def list_of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(int(self.ends[term - 1]) if term else 0, int(self.ends[term]))
        return self.docs[part], self.points[part]

    def search(self, query: list[tuple[int, int]], best: Best) -> int:
        """Add the block's answers to ``best``; ``query`` has (term, repeats), rarest first.  Returns accumulators made."""
        scores, k = self.scores, best.k
        scores[:] = 0
        bounds = [int(self.most[t]) * r for t, r in query]
        left = sum(bounds)
        live = None  # the documents with an accumulator, once no more are created
        for (term, repeats), bound in zip(query, bounds):
            if live is None and left:
                kth = best.floor()
                made = scores[scores > 0]
                if len(made) >= k:
                    kth = max(kth, int(np.partition(made, len(made) - k)[len(made) - k]))
                if left < kth:
                    live = np.flatnonzero(scores)
            docs, points = self.list_of(term)
            if live is not None and len(live) * 8 < len(docs):
                at = np.minimum(np.searchsorted(docs, live), len(docs) - 1)
                hit = docs[at] == live
                scores[live[hit]] += repeats * points[at[hit]]
            elif live is not None:
                hit = scores[docs] > 0
                scores[docs[hit]] += repeats * points[hit]
            else:
                scores[docs] += repeats * points
            left -= bound
        found = np.flatnonzero(scores) if live is None else live
        good = found[scores[found] >= best.floor()]
        best.add(scores[good], self.ids[good], self.null[good])
        return len(found)


def query_blocks(queries: DataFrame, chars: int = QUERY_CHARS) -> Iterator[list[tuple[int | None, str]]]:
    """The distinct queries, in blocks whose size is bounded whatever the table's size."""
    items = queries.select(F.col("item_id").cast("bigint").alias("item_id"), "text").filter(F.col("text").isNotNull()).distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-total // chars))
    for k in range(n):
        block = items if n == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        rows = [(r["item_id"], r["text"]) for r in block.collect()]
        if rows:
            yield sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def search_block(docs: DataFrame, items: list[tuple[int | None, str]], k: int) -> DataFrame:
    """The k best of each item: query (its place in ``items``), rank, doc_id, score."""
    spark = docs.sparkSession
    vocabulary: dict[bytes, int] = {}
    counts = [Counter(vocabulary.setdefault(t, len(vocabulary)) for t in terms_of(text.encode())) for _, text in items]
    held = settle(postings(docs, vocabulary))
    stats = held.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms"), F.sum(F.size("terms")).alias("postings")).first()
    n_docs, n_terms = stats["docs"], stats["terms"] or 0
    df = np.zeros(len(vocabulary), np.int64)
    # one row a query term
    for r in held.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[r["term"]] = r["count"]
    weights = np.array([weight(n_docs, int(d)) for d in df], np.int64)
    plan = [sorted(c.items(), key=lambda x: (df[x[0]], x[0])) for c in counts]
    plan = [[(t, r) for t, r in q if df[t]] for q in plan]
    shared = spark.sparkContext.broadcast((weights, plan))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, plan = shared.value
        best = [Best(k) for _ in plan]
        parts: list[tuple] = []

        def flush():
            block = Block(*[np.concatenate(c) for c in zip(*parts)], weights, n_docs, n_terms)
            for query, b in zip(plan, best):
                if query:
                    block.search(query, b)

        n_held = 0
        for b in batches:
            ids = b.column(0)
            terms, tfs = b.column(2), b.column(3)
            sizes = terms.value_lengths().to_numpy(zero_copy_only=False)
            columns = (ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), b.column(1).to_numpy(), sizes)
            flat_terms, flat_tfs, ends = terms.flatten().to_numpy(), tfs.flatten().to_numpy(), np.cumsum(sizes)
            at = 0
            while at < len(sizes):
                # as many documents as fill the block; one document alone has no more postings than the queries have terms
                done = int(ends[at - 1]) if at else 0
                to = max(at + 1, int(np.searchsorted(ends, done + BLOCK_POSTINGS - n_held, side="right")))
                parts.append((*[c[at:to] for c in columns], flat_terms[done: int(ends[to - 1])], flat_tfs[done: int(ends[to - 1])]))
                n_held += int(ends[to - 1]) - done
                at = to
                if n_held >= BLOCK_POSTINGS:
                    flush()
                    parts, n_held = [], 0
        if parts:
            flush()
        kinds = pa.schema([("query", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64()), ("task", pa.int32())])
        task = TaskContext.get().partitionId()
        for q, b in enumerate(best):
            if len(b.ids):
                yield pa.RecordBatch.from_arrays([
                    pa.array([q] * len(b.ids), pa.int32()), pa.array(b.ids, mask=b.null), pa.array(b.scores),
                    pa.array([task] * len(b.ids), pa.int32())], schema=kinds)

    # a task's answers do not grow with its postings, so tasks take many
    tasks = max(spark.sparkContext.defaultParallelism, -(-(stats["postings"] or 0) // TASK_POSTINGS))
    hits = held.coalesce(tasks).mapInArrow(run, _HITS).withColumn("group", F.pmod("task", F.lit(MERGE)))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    first = F.row_number().over(Window.partitionBy("query", "group").orderBy(*order))
    hits = hits.withColumn("rank", first).filter(F.col("rank") <= k)
    last = F.row_number().over(Window.partitionBy("query").orderBy(*order))
    return hits.withColumn("rank", last).filter(F.col("rank") <= k).select("query", "rank", "doc_id", "score")


def search(docs: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents with a score above 0 of every query (item_id, text).

    Ties go to the smaller doc_id, a null one last.  Repeated document rows are
    ranked each; repeated queries once; rows of one item_id with different
    texts are queries of their own.  Null, empty and term-less texts match
    nothing, and such documents do not count among all documents.  Very long
    texts are read whole.  Further columns are ignored; empty tables give an empty result.
    """
    spark = docs.sparkSession
    out = None
    for items in query_blocks(queries):
        found = search_block(docs, items, k)
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(items)], "query int, item_id long")
        # no more rows than one block of queries has
        found = found.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out
