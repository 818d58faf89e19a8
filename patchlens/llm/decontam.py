"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are read as sequences of lower-case words.  An item of m
words is leaked in a text if some run of the text's words is within e edits
(insert, delete or replace a word) of it, e = floor(m * (1 - SIMILARITY)).

Cut into e + 1 pieces, at least one piece of the item survives e edits as it
is, so every leak holds an exact piece hit.  Hits are found with rolling hashes
over the text's word ids (one sorted probe per piece length) and confirmed word
by word; hits of one item on nearby diagonals are merged, and each window that
such hits allow is verified with Myers' bit-parallel distance, which also gives
the place and the number of edits.

Items travel to the tasks in blocks of at most BLOCK_WORDS words, one pass over
the documents per block, so no broadcast grows with the item table.  Documents
are neither joined nor shuffled.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A leak keeps at least this share of the item's words (in edits).
SIMILARITY = 0.8
#: Most words of test items that one pass carries.
BLOCK_WORDS = 2_000_000
_TOKEN = re.compile(r"\w+")
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def item_words(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


def budget(n_words: int, similarity: float = SIMILARITY) -> int:
    """Most edits that still count as a leak of an item of ``n_words`` words."""
    return int(n_words * (1 - similarity) + 1e-9)


def pieces(n_words: int, n_pieces: int) -> list[tuple[int, int]]:
    """(start, end) of the item's pieces, as equal as possible."""
    return [(n_words * i // n_pieces, n_words * (i + 1) // n_pieces) for i in range(n_pieces)]


def myers(pattern: np.ndarray | list, text: Iterable[int], limit: int) -> tuple[int, int] | None:
    """(edits, end) of the best match of ``pattern`` inside ``text``, the earliest end first; None above ``limit``.

    Myers' bit vectors for approximate search: one bit per pattern word, held in
    one integer of any length.
    """
    m = len(pattern)
    masks: dict[int, int] = defaultdict(int)
    for i, w in enumerate(pattern):
        masks[int(w)] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = full, 0, m, None
    for end, w in enumerate(text, 1):
        eq = masks.get(int(w), 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = (minus | ~(xh | plus)) & full
        mh = plus & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = (ph << 1) & full, (mh << 1) & full  # a match may start anywhere: no carry in
        plus = (mh | ~(xv | ph)) & full
        minus = ph & xv
        if score <= limit and (best is None or score < best[0]):
            best = (score, end)
    return best


class Matcher:
    """Leaks of one block of test items in whole texts."""

    def __init__(self, items: list[tuple[int, str]], similarity: float = SIMILARITY):
        self.vocabulary: dict[str, int] = {}
        self.items = []
        by_length: dict[int, dict[tuple, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for item_id, text in items:
            words = item_words(text)
            if not words:
                continue
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            edits = budget(len(ids), similarity)
            index = len(self.items)
            self.items.append((item_id, ids, edits))
            for start, end in pieces(len(ids), edits + 1):
                by_length[end - start][tuple(ids[start:end])].append((index, start))
        self.tables = []
        for length, found in sorted(by_length.items()):
            grams = list(found)
            hashes = self._roll(np.array(grams, dtype=np.uint64).reshape(-1), length)[::length]
            order = np.argsort(hashes, kind="stable")
            self.tables.append((length, hashes[order], [(grams[i], found[grams[i]]) for i in order]))

    @staticmethod
    def _roll(ids: np.ndarray, length: int) -> np.ndarray:
        """A 64-bit hash of each run of ``length`` ids (wrapping arithmetic)."""
        n = len(ids) - length + 1
        out = np.zeros(max(0, n), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for i in range(length):
                out = (out ^ ids[i: i + n]) * _PRIME
                out ^= out >> np.uint64(29)
        return out

    def word_ids(self, text: str | None) -> np.ndarray:
        """Ids of all words of a text; words that no item has are 0."""
        get = self.vocabulary.get
        return np.fromiter((get(m.group(), 0) for m in _TOKEN.finditer((text or "").lower())), dtype=np.uint64)

    def hits(self, ids: np.ndarray) -> dict[int, list[int]]:
        """Per item the diagonals (text position minus item position) of its exact piece hits."""
        out: dict[int, list[int]] = defaultdict(list)
        known = np.concatenate([[0], np.cumsum(ids != 0)])
        for length, hashes, grams in self.tables:
            if len(ids) < length:
                continue
            rolled = self._roll(ids, length)
            at = np.flatnonzero(known[length:] - known[:-length] == length)
            slot = np.searchsorted(hashes, rolled[at])
            good = slot < len(hashes)
            good[good] = hashes[slot[good]] == rolled[at][good]
            for pos, first in zip(at[good].tolist(), slot[good].tolist()):
                here = tuple(ids[pos: pos + length].tolist())
                k = first
                while k < len(hashes) and hashes[k] == hashes[first]:
                    if grams[k][0] == here:
                        for index, start in grams[k][1]:
                            out[index].append(pos - start)
                    k += 1
        return out

    def leaks(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item_id, edits, first word, past the last word searched) of each leaked item's best match."""
        ids = self.word_ids(text)
        found = []
        for index, diagonals in sorted(self.hits(ids).items()):
            item_id, pattern, edits = self.items[index]
            best = None
            windows: list[list[int]] = []
            for d in sorted(set(diagonals)):
                lo, hi = max(0, d - edits), min(len(ids), d + len(pattern) + edits)
                if windows and lo <= windows[-1][1]:
                    windows[-1][1] = max(windows[-1][1], hi)
                else:
                    windows.append([lo, hi])
            for lo, hi in windows:
                match = myers(pattern, ids[lo:hi].tolist(), edits)
                if match and (best is None or match[0] < best[0]):
                    best = (match[0], lo, lo + match[1])
            if best:
                found.append((item_id, *best))
        return found


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[int, str]]]:
    """The distinct items, in blocks whose size is bounded whatever the table's size."""
    items = benchmark.select(F.col("item_id").cast("bigint"), "text").filter(F.col("text").isNotNull()).distinct()
    words = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-words // (4 * block_words)))
    for k in range(n):
        block = items if n == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        rows = sorted(((r["item_id"], r["text"]) for r in block.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        if rows:
            yield rows


def find_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per (document, leaked item): doc_id, item_id, edits, first_word, end_word.

    [first_word, end_word) is a run of the document's words that holds the best
    match.  Null, empty or wordless texts and items match nothing; items of
    fewer than 1 / (1 - similarity) words must occur exactly.  Repeated
    documents are reported each; repeated items once.  Empty tables give an
    empty result.
    """
    schema = "doc_id long, item_id long, edits int, first_word long, end_word long"
    spark = docs.sparkSession
    out = spark.createDataFrame([], schema)
    narrow = docs.select(F.col("doc_id").cast("bigint"), F.col("text").alias("_text"))
    for k, items in enumerate(item_blocks(benchmark)):
        shared = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, similarity)
            for b in batches:
                rows = [(d.as_py(), *leak) for d, t in zip(b.column(0), b.column(1)) for leak in matcher.leaks(t.as_py())]
                cols = list(zip(*rows)) if rows else [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, kinds)],
                                                 names=["doc_id", "item_id", "edits", "first_word", "end_word"])

        found = narrow.mapInArrow(run, schema)
        out = found if k == 0 else out.unionByName(found)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without the rows that hold a leaked item; everything else is passed on as it is."""
    spark = docs.sparkSession
    out = docs
    at = docs.columns.index("text")
    for items in item_blocks(benchmark):
        shared = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, similarity)
            for b in batches:
                clean = pa.array([not matcher.leaks(t.as_py()) for t in b.column(at)], type=pa.bool_())
                yield b.filter(clean)

        out = out.mapInArrow(run, docs.schema)
    return out
