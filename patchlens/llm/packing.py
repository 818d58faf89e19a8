"""Packing token sequences: concatenate and cut, by prefix sums over partition totals.

1. First pass: every task encodes its documents whole and writes their ids with
   the number of ids before them in the partition, once, as Parquet in a shared
   folder.  The files fix the order: nothing later depends on how a scan is split.
2. The partitions' totals (one narrow row a partition) give, by an exclusive
   prefix sum, each partition's global offset, and so each document's.
3. Second pass: every task cuts its documents where a fixed window of the
   concatenation ends.  A document that crosses windows yields one boundary
   record per window it touches, so neither long documents nor hot sources meet in a task.

Only the last sequence can hold fewer ids than a window.

Encoding works on units: stretches of text between places where the byte-level
split pattern cuts in any context.  A worker keeps the ids of the units that it
has seen, up to a bound, and looks the rest up in the tokenizer.
"""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patchlens.llm.common import bounded_broadcast

SEQUENCE = 2048
END_ID = 1
TOKENIZER = "byte_bpe_50k.json"
#: Units that a worker remembers before it starts anew.
UNITS = 500_000
#: Characters encoded at a time, and ids that one output batch holds before it is sent.
CHARS = 1 << 21
BATCH_IDS = 1 << 20

_LETTERS = r"A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
# --- fixed value: the characters of Unicode's White_Space property ---
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A space and letters that end before an ASCII character or the text's end; else white space and what follows it.
_UNIT = re.compile(rf" [{_LETTERS}]++(?![^\x00-\x7f])|[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")

_HELD = "doc_id long, part int, at long, n long, ids binary"
_PIECE = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, boundary boolean, ids binary"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Known(dict):
    """The number of every unit, given out in order of appearance; ``new`` lists those not learnt yet."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        self.new.append(unit)
        n = self[unit] = len(self)
        return n


class UnitEncoder:
    """Ids of whole texts, as the tokenizer gives them without special tokens added."""

    def __init__(self, path: str, units: int = UNITS):
        # a task has one core, so the library's own threads would only compete with other tasks
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.units = units
        vocabulary = self.tokenizer.get_vocab()
        self.size = max(vocabulary.values()) + 1
        # a byte-level token is spelt with one character a byte
        self.token_bytes = np.zeros(self.size, np.int64)
        for token, i in vocabulary.items():
            self.token_bytes[i] = len(token)
        self._forget()

    def _forget(self) -> None:
        self.known = _Known()
        self.ids = np.empty(0, np.uint32)
        self.starts = np.empty(0, np.int64)
        self.lengths = np.empty(0, np.int64)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts``, one text after another, and their numbers."""
        got = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, got), np.int64, len(got))
        return np.concatenate([np.empty(0, np.uint32), *[np.array(i, np.uint32) for i in got]]), sizes

    def _learn(self, new: list[str]) -> None:
        """Ids of the units numbered last, in their order."""
        # the pattern cuts before a space and a visible character wherever they stand: such units are encoded as one text
        joins = np.fromiter((u[0] == " " and u[1:2].isalnum() for u in new), bool, len(new))
        words = [u for u, j in zip(new, joins) if j]
        ids, _ = self._encode(["".join(words[i: i + 1000]) for i in range(0, len(words), 1000)])
        ends = np.cumsum(np.fromiter((len(u.encode()) for u in words), np.int64, len(words)))
        last = np.searchsorted(np.cumsum(self.token_bytes[ids]), ends, side="right")
        more, their = self._encode([u for u, j in zip(new, joins) if not j])
        sizes, starts = np.empty(len(new), np.int64), np.empty(len(new), np.int64)
        sizes[joins], starts[joins] = np.diff(last, prepend=0), np.concatenate([[0], last])[:-1]
        sizes[~joins], starts[~joins] = their, len(ids) + np.cumsum(their) - their
        self.starts = np.concatenate([self.starts, len(self.ids) + starts])
        self.lengths = np.concatenate([self.lengths, sizes])
        self.ids = np.concatenate([self.ids, ids, more])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts``, one text after another, and their numbers."""
        if len(self.known) > self.units:
            self._forget()
        per_text = [_UNIT.findall(t) for t in texts]
        cuts = np.cumsum(np.fromiter(map(len, per_text), np.int64, len(per_text)))
        units = itertools.chain.from_iterable(per_text)
        at = np.fromiter(map(self.known.__getitem__, units), np.int64, int(cuts[-1]) if len(cuts) else 0)
        if self.known.new:
            self._learn(self.known.new)
            self.known.new = []
        sizes = self.lengths[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(self.starts[at] - (ends - sizes), sizes) + np.arange(total)]
        return ids, np.diff(np.concatenate([[0], ends])[cuts], prepend=0)


_ENCODERS: dict[str, UnitEncoder] = {}


def encoder(path: str) -> UnitEncoder:
    """The worker's encoder; Spark hands one Python worker many tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = UnitEncoder(path)
    return _ENCODERS[path]


def _groups(texts: list[str]) -> Iterator[list[str]]:
    """Runs of texts of about CHARS characters; a longer text is a run of its own."""
    held, n = [], 0
    for t in texts:
        if held and n + len(t) > CHARS:
            yield held
            held, n = [], 0
        held.append(t)
        n += len(t)
    if held:
        yield held


def write_ids(docs: DataFrame, folder: str, path: str, end_id: int = END_ID) -> DataFrame:
    """First pass: encode ``docs`` into ``folder``; doc_id, part, ids before it in the part, number and ids with ``end_id``."""
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    arrow = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("at", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        kind = np.uint16 if max(enc.size, end_id + 1) <= 1 << 16 else np.uint32
        part, before = TaskContext.get().partitionId(), 0
        for b in batches:
            at = 0
            for texts in _groups(b.column(1).to_pylist()):
                ids, sizes = enc.encode(texts)
                ends = np.cumsum(sizes)
                whole = np.insert(ids, ends, end_id).astype(kind)  # the end id after each document
                n = sizes + 1
                starts = np.cumsum(n) - n
                data = [whole[s: s + k].tobytes() for s, k in zip(starts.tolist(), n.tolist())]
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(at, len(texts)), pa.array([part] * len(texts), pa.int32()),
                    pa.array(before + starts), pa.array(n), pa.array(data, pa.binary())], schema=arrow)
                at += len(texts)
                before += int(n.sum())

    narrow.mapInArrow(run, _HELD).write.parquet(folder)
    return docs.sparkSession.read.schema(_HELD).parquet(folder)


def pack(docs: DataFrame, folder: str, length: int = SEQUENCE, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, boundary, ids.

    ``ids`` are the piece's ids as little-endian unsigned 32-bit numbers;
    ``boundary`` says that the document is cut at the piece's start or end.
    Pieces with one sequence_id fill the offsets from 0 without gaps; all
    sequences but the last hold ``length`` ids.  Null and empty texts are one
    end id; null ids of documents stay null; repeated rows are packed each;
    very long texts are encoded whole and cut into many pieces; further columns
    are ignored, whatever their names; an empty table gives no pieces.
    ``folder`` holds the ids as long as the result is read; ``drop`` removes it.
    """
    spark = docs.sparkSession
    path = path or tokenizer_path()
    held = write_ids(docs, folder, path, end_id)
    # one row a partition of the first pass, however many documents it has
    totals = held.groupBy("part").agg(F.sum("n").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    offsets = bounded_broadcast(offsets, 16 * totals.count())
    placed = held.join(offsets, "part").select("doc_id", (F.col("base") + F.col("at")).alias("first"), "n", "ids")
    arrow = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("start", "length", "doc_tokens", "sequence_id", "offset")],
                       ("boundary", pa.bool_()), ("ids", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        n_ids = 0

        def flush():
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow)], schema=arrow)

        for b in batches:
            for doc_id, first, n, data in zip(*[b.column(i) for i in range(4)]):
                doc_id, first, n, data = doc_id.as_py(), first.as_py(), n.as_py(), data.as_buffer()
                ids = np.frombuffer(data, np.uint16 if len(data) == 2 * n else np.uint32).astype("<u4")
                start = 0
                while start < n:
                    sequence, offset = divmod(first + start, length)
                    end = min(n, start + length - offset)
                    rows.append((doc_id, start, end - start, n, sequence, offset, start > 0 or end < n, ids[start:end].tobytes()))
                    n_ids += end - start
                    start = end
                    if n_ids >= BATCH_IDS:
                        yield flush()
                        rows, n_ids = [], 0
        if rows:
            yield flush()

    return placed.mapInArrow(cut, _PIECE)


def drop(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
