"""Token counts as delta-maintained rollups.

A rollup folder holds signed entries (document, source, language, tokenizer,
documents, tokens, characters) and their totals, one sub-folder per committed
batch.  An insert adds entries, a delete adds the negative of what the folder
holds for the document, a revision does both; so totals are sums and a batch
costs work for its own rows alone, plus one pass over the entries of documents
it deletes or revises.

Commits are idempotent: entries and totals are written under a name of the
attempt, and a commit file, created atomically and naming the attempt, makes
them count.  Repeating a batch finds its commit file and changes nothing; an
attempt that dies leaves files that no commit names.
"""

from __future__ import annotations

import base64
import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchlens.llm.common import word_count

#: Folder of the public vocabulary files.
TOKENIZERS = "/opt/tokenizers"
WORDS = "words-v1"
BPE = "byte_bpe_50k"
# --- fixed value: the split pattern of the byte-level vocabulary ---
BPE_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
TOTAL_KEYS = ["source", "lang", "tokenizer"]
_ENTRY = "doc_id long, source string, lang string, tokenizer string, n_docs long, n_tokens long, n_chars long"
_CHUNK = 1 << 16


def load_ranks(folder: str = TOKENIZERS, name: str = BPE) -> dict[bytes, int]:
    with open(f"{folder}/{name}.tiktoken", "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f)}


def encoder(ranks: dict[bytes, int]):
    import tiktoken

    return tiktoken.Encoding("rollup", pat_str=BPE_PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(encoding, text: str | None) -> int:
    """Tokens of a whole text; long texts are cut where the pattern splits anyway (between a word and a line end)."""
    text, n, at = text or "", 0, 0
    while len(text) - at > _CHUNK:
        cut = text.find("\n", at + _CHUNK)
        while 0 < cut and not (text[cut - 1].isalnum() and text[cut + 1: cut + 2].isalnum()):
            cut = text.find("\n", cut + 1)
        if cut < 0:
            break
        n += len(encoding.encode_ordinary(text[at:cut]))
        at = cut
    return n + len(encoding.encode_ordinary(text[at:]))


def token_entries(rows: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """Positive entries of each row, one per tokenizer version."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(ranks)  # one vocabulary
    narrow = rows.select(F.col("doc_id").cast("bigint"), "source", "lang", F.col("text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(shared.value)
        for b in batches:
            texts = b.column(3)
            counts = pa.array([count_tokens(encoding, t.as_py()) for t in texts], type=pa.int64())
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(4)], counts],
                                             names=["doc_id", "source", "lang", "_text", "bpe"])

    counted = narrow.mapInArrow(run, "doc_id long, source string, lang string, _text string, bpe long")
    versions = F.inline(F.array(F.struct(F.lit(WORDS).alias("tokenizer"), word_count(F.col("_text")).alias("n_tokens")),
                                F.struct(F.lit(BPE).alias("tokenizer"), F.col("bpe").alias("n_tokens"))))
    chars = F.length(F.coalesce(F.col("_text"), F.lit(""))).cast("bigint").alias("n_chars")
    return counted.select("doc_id", "source", "lang", chars, versions).select(
        "doc_id", "source", "lang", "tokenizer", F.lit(1).cast("bigint").alias("n_docs"), "n_tokens", "n_chars")


class Rollup:
    """A rollup folder in a file system that Spark reads and writes."""

    def __init__(self, spark: SparkSession, folder: str, tokenizers: str = TOKENIZERS):
        self.spark, self.folder, self.tokenizers = spark, folder.rstrip("/"), tokenizers

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def commits(self) -> dict[str, str]:
        """batch -> attempt of every committed batch."""
        fs, out = self._fs(), {}
        if fs.exists(self._path("commits")):
            for status in fs.listStatus(self._path("commits")):
                name = status.getPath().getName()
                if name.endswith(".json"):
                    note = json.loads(self.spark.read.text(f"{self.folder}/commits/{name}").first()[0])
                    out[note["batch"]] = note["attempt"]
        return out

    def _committed(self, kind: str, schema: str) -> DataFrame:
        paths = [f"{self.folder}/{kind}/{attempt}" for attempt in self.commits().values()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def entries(self) -> DataFrame:
        return self._committed("entries", _ENTRY)

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens, n_chars of what the committed batches leave (null is a value)."""
        t = self._committed("totals", _ENTRY.removeprefix("doc_id long, "))
        summed = t.groupBy(*TOTAL_KEYS).agg(*[F.sum(c).alias(c) for c in ("n_docs", "n_tokens", "n_chars")])
        return summed.filter("n_docs <> 0 or n_tokens <> 0 or n_chars <> 0")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch of (op, doc_id, source, lang, text); False if it was committed before.

        op is insert, delete or revise.  Inserts add, also when they repeat a
        row.  A delete takes away all that earlier batches hold for the doc_id
        (nothing, if they hold nothing), a revise does so and adds the row.
        Null ids match nothing, so for them a delete does nothing.  Null texts
        count as empty.  An empty batch is committed without entries.
        """
        name = base64.urlsafe_b64encode(batch.encode()).decode()
        fs = self._fs()
        if fs.exists(self._path("commits", f"{name}.json")):
            return False
        attempt = f"{name}-{uuid.uuid4().hex}"
        added = token_entries(changes.filter("op in ('insert', 'revise')"), load_ranks(self.tokenizers))
        gone = changes.filter("op in ('delete', 'revise')").select("doc_id").distinct()
        before = self.entries().join(gone, "doc_id", "left_semi").groupBy("doc_id", *TOTAL_KEYS).agg(
            *[(-F.sum(c)).alias(c) for c in ("n_docs", "n_tokens", "n_chars")]).filter("n_docs <> 0")
        added.unionByName(before).write.parquet(f"{self.folder}/entries/{attempt}")
        entries = self.spark.read.schema(_ENTRY).parquet(f"{self.folder}/entries/{attempt}")
        entries.groupBy(*TOTAL_KEYS).agg(*[F.sum(c).alias(c) for c in ("n_docs", "n_tokens", "n_chars")]) \
            .write.parquet(f"{self.folder}/totals/{attempt}")
        return self._publish(fs, name, {"batch": batch, "attempt": attempt})

    def _publish(self, fs, name: str, note: dict) -> bool:
        """Create the commit file; of two attempts of one batch the first to rename its file wins."""
        draft = self._path("commits", f"_{note['attempt']}")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(note).encode()))
        out.close()
        goal = self._path("commits", f"{name}.json")
        won = not fs.exists(goal) and fs.rename(draft, goal)
        if not won:
            fs.delete(draft, False)
        return bool(won)

    def drop(self) -> None:
        self._fs().delete(self._path(), True)
