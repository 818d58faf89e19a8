"""Toxicity: a convolutional text classifier over hashed word embeddings.

A word's vector is the mean of hashed embeddings of the word, its prefixes and
its suffixes, so inflected forms of one stem share features.  Filters of widths
1, 2 and 3 run over the whole text, are max-pooled, and feed a logistic output.
Training is plain numpy (Adam) on the driver, over a bounded sample of labelled
rows; every other step covers all rows.

Fit: labelled documents whose crc32(doc_id) mod 5 is 1, 2 or 3.  Remainder 4 is
kept for calibration, over all its labelled rows: it places the score so that
0.5 is the best single threshold, and gives each language with enough toxic rows
a threshold of its own.  Scores use the text alone.

Score: a projected word costs one row of a lookup table (filters applied to its
vector), so a text is a gather, shifted sums and a running maximum.  Long texts
go through in chunks that overlap by the widest filter; nothing is cut off.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchlens.llm.common import bounded_broadcast, free_name, preceding_sum, settle

WIDTHS = (1, 2, 3)
FILTERS = 16
DIM = 16
BUCKETS = 1 << 16
#: The fit reads at most this many labelled rows (in hash order) and this many characters of text (whole rows, the
#: longest of those left out first, so a long text displaces no other).
MAX_ROWS = 6_000
MAX_CHARS = 32_000_000
EPOCHS = 6
BATCH = 32
#: A language with fewer toxic calibration rows takes the common threshold.
MIN_TOXIC = 20
#: Fifths of the labelled rows by crc32(doc_id): for the fit and for calibration; 0 is held out.
FIT_FOLDS, CALIBRATION_FOLDS = (1, 2, 3), (4,)
#: Score ranges among which the rows of a language are dealt when its threshold is sought.
BINS = 256
PREFIXES, SUFFIXES = (3, 4, 5, 6), (3, 4, 5)
N_FEATURES = 1 + len(PREFIXES) + len(SUFFIXES)
_TOKEN = re.compile(r"\w+")
_NOT_WORD = re.compile(r"\W")
#: Characters tokenized at a time, and words whose projections a task keeps.
_CHUNK = 1 << 18
_CACHE_WORDS = 1 << 17
_OFFSETS = sum(WIDTHS)


def word_features(words: list[str]) -> np.ndarray:
    """(words, N_FEATURES) buckets: the word, its prefixes and suffixes shorter than it; BUCKETS where one is missing."""
    out = np.full((len(words), N_FEATURES), BUCKETS, dtype=np.int64)
    out[:, 0] = [zlib.crc32(w.encode("utf-8", "surrogatepass")) % BUCKETS for w in words]
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = [w[: max(PREFIXES)] + w[-max(SUFFIXES):][::-1] for w in words]
    width = max(PREFIXES) + max(SUFFIXES)
    codes = np.array(ends, dtype=f"U{width}").view(np.uint32).reshape(len(words), width).astype(np.uint64)
    for first, kinds, salt in ((np.zeros_like(sizes), PREFIXES, 1), (np.minimum(sizes, max(PREFIXES)), SUFFIXES, 2)):
        h = np.full(len(words), salt, dtype=np.uint64)
        for k in range(max(kinds)):
            h = (h ^ codes[np.arange(len(words)), np.minimum(first + k, width - 1)]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            if k + 1 in kinds:
                column = 1 + (salt - 1) * len(PREFIXES) + kinds.index(k + 1)
                out[:, column] = np.where(sizes > k + 1, (h % np.uint64(BUCKETS)).astype(np.int64), BUCKETS)
    return out


class Vocabulary(dict):
    """Word -> id in order of first sight (0 is padding); ``new`` holds the words not yet looked up elsewhere."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = i = len(self) + 1
        return i

    def encode(self, text: str | None) -> Iterator[np.ndarray]:
        """Word ids of a whole text in chunks, each starting with the end of the one before."""
        low, at, carried, first = (text or "").lower(), 0, [], True
        while first or at < len(low):
            end = at + _CHUNK
            if end < len(low):  # cut between words
                gap = _NOT_WORD.search(low, end)
                end = gap.end() if gap else len(low)
            ids = carried + list(map(self.__getitem__, _TOKEN.findall(low[at:end])))
            at = end
            if len(ids) > len(carried) or first:
                yield np.array(ids + [0] * (max(WIDTHS) - len(ids)), dtype=np.int64)
                carried = ids[-(max(WIDTHS) - 1):]
            first = False


@dataclass
class Model:
    embedding: np.ndarray
    filters: np.ndarray  # DIM x (_OFFSETS * FILTERS): one block per width and offset
    bias: np.ndarray  # len(WIDTHS) * FILTERS
    out: np.ndarray
    out_bias: float
    centre: float = 0.0
    slope: float = 1.0
    constant: float | None = None
    thresholds: dict[str, float] = field(default_factory=dict)

    def vectors(self, features: np.ndarray) -> np.ndarray:
        """Mean embedding of the features that each word has."""
        counts = (features < BUCKETS).sum(axis=1, keepdims=True)
        return self.embedding[features].sum(axis=1) / np.maximum(counts, 1).astype(np.float32)

    def pooled(self, table: np.ndarray, ids: np.ndarray, where: bool = False):
        """Max over positions of each filter, before bias and rectifier (and the positions)."""
        tops, spots, at = [], [], 0
        rows = table[ids]
        for w in WIDTHS:
            n = len(ids) - w + 1
            z = rows[:n, at * FILTERS: (at + 1) * FILTERS]
            for j in range(1, w):
                z = z + rows[j: j + n, (at + j) * FILTERS: (at + j + 1) * FILTERS]
            if where:
                spot = z.argmax(axis=0)
                spots.append(spot)
                tops.append(z[spot, np.arange(FILTERS)])
            else:
                tops.append(z.max(axis=0))
            at += w
        return np.concatenate(tops), spots

    def logit(self, top: np.ndarray) -> float:
        return float(np.maximum(top + self.bias, 0) @ self.out + self.out_bias)

    def score(self, logit: float) -> float:
        if self.constant is not None:
            return self.constant
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * (logit - self.centre), -60, 60))))


class Scorer:
    """Scores whole texts; the table of projected words is rebuilt when it is full."""

    def __init__(self, model: Model):
        self.model = model
        self._reset()

    def _reset(self):
        self.words = Vocabulary()
        self.table = np.zeros((1024, _OFFSETS * FILTERS), dtype=np.float32)

    def logit(self, text: str | None) -> float:
        if len(self.words) > _CACHE_WORDS:
            self._reset()
        best = None
        for ids in self.words.encode(text):
            if self.words.new:
                n = len(self.words) + 1
                if n > len(self.table):
                    grown = np.zeros((2 * n, self.table.shape[1]), dtype=np.float32)
                    grown[: len(self.table)] = self.table
                    self.table = grown
                self.table[n - len(self.words.new): n] = self.model.vectors(word_features(self.words.new)) @ self.model.filters
                self.words.new.clear()
            top, _ = self.model.pooled(self.table, ids)
            best = top if best is None else np.maximum(best, top)
        return self.model.logit(best)

    def score(self, text: str | None) -> float:
        return self.model.score(self.logit(text))


def class_odds(features: np.ndarray, encoded: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Log odds of each feature's presence in toxic against other texts, drawn to 0 where few texts hold it."""
    held = np.zeros((2, BUCKETS + 1))
    for ids, y in zip(encoded, labels):
        held[int(y > 0)][np.unique(features[np.unique(ids)])] += 1
    n = np.array([(labels <= 0).sum(), (labels > 0).sum()])
    odds = np.log((held[1] + 1) / (n[1] + 2)) - np.log((held[0] + 1) / (n[0] + 2))
    seen = held.sum(axis=0)
    odds = (odds * seen / (seen + 5.0)).astype(np.float32)
    odds[BUCKETS] = 0  # the missing feature
    return odds


def train(texts: list[str], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Fit on whole texts; the loss weighs both classes alike."""
    rng = np.random.default_rng(seed)
    n_top = len(WIDTHS) * FILTERS
    words = Vocabulary()
    encoded = []
    for t in texts:
        chunks = list(words.encode(t))
        encoded.append(np.concatenate([chunks[0], *[c[max(WIDTHS) - 1:] for c in chunks[1:]]]).astype(np.int32))
    features = np.concatenate([np.full((1, N_FEATURES), BUCKETS), word_features(words.new)])
    odds = class_odds(features, encoded, labels)
    # a feature that the sample lacks stays at zero, so unknown words say nothing
    embedding = rng.normal(0, 0.05, (BUCKETS + 1, DIM)).astype(np.float32) * (odds != 0)[:, None]
    embedding[:, 0] = odds
    filters = rng.normal(0, 0.1, (DIM, _OFFSETS * FILTERS)).astype(np.float32)
    filters[0] = np.abs(filters[0]) + 0.2
    model = Model(embedding, filters, np.zeros(n_top, np.float32), rng.uniform(0, 0.1, n_top).astype(np.float32), 0.0)
    weight = np.where(labels > 0, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9))
    params = {"filters": model.filters, "bias": model.bias, "out": model.out, "out_bias": np.zeros(1, np.float32)}
    first = {k: np.zeros_like(v) for k, v in params.items()} | {"embedding": np.zeros_like(model.embedding)}
    second = {k: np.zeros_like(v) for k, v in first.items()}
    step, rate, b1, b2 = 0, 0.01, 0.9, 0.99

    def move(name, value, grad, rows=slice(None)):
        m, v = first[name], second[name]
        m[rows] = b1 * m[rows] + (1 - b1) * grad
        v[rows] = b2 * v[rows] + (1 - b2) * grad * grad
        value[rows] -= rate * (m[rows] / (1 - b1**step)) / (np.sqrt(v[rows] / (1 - b2**step)) + 1e-6)

    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            batch = order[at: at + BATCH]
            used, local = np.unique(np.concatenate([encoded[i] for i in batch]), return_inverse=True)
            x = model.vectors(features[used])
            table = x @ model.filters
            g_table = np.zeros_like(table)
            g_bias, g_out, g_out_bias = np.zeros_like(model.bias), np.zeros_like(model.out), 0.0
            start = 0
            for i in batch:
                ids = local[start: start + len(encoded[i])]
                start += len(encoded[i])
                top, spots = model.pooled(table, ids, where=True)
                h = np.maximum(top + model.bias, 0)
                p = 1 / (1 + np.exp(-np.clip(h @ model.out + params["out_bias"][0], -60, 60)))
                g = (p - labels[i]) * weight[i] / len(batch)
                g_out += g * h
                g_out_bias += g
                g_top = g * model.out * (h > 0)
                g_bias += g_top
                off = 0
                for k, w in enumerate(WIDTHS):
                    part = g_top[k * FILTERS: (k + 1) * FILTERS]
                    for j in range(w):
                        np.add.at(g_table, (ids[spots[k] + j], (off + j) * FILTERS + np.arange(FILTERS)), part)
                    off += w
            step += 1
            live = np.flatnonzero(g_table.any(axis=1))
            g_x = g_table[live] @ model.filters.T
            move("filters", model.filters, x[live].T @ g_table[live])
            move("bias", model.bias, g_bias)
            move("out", model.out, g_out)
            move("out_bias", params["out_bias"], np.array([g_out_bias], np.float32))
            owner, column = np.nonzero(features[used[live]] < BUCKETS)
            share = g_x / np.maximum(np.bincount(owner, minlength=len(live)), 1)[:, None]
            rows, back = np.unique(features[used[live]][owner, column], return_inverse=True)
            g_e = np.zeros((len(rows), DIM), dtype=np.float32)
            np.add.at(g_e, back, share[owner].astype(np.float32))
            if len(rows):
                move("embedding", model.embedding, g_e, rows)
    model.out_bias = float(params["out_bias"][0])
    return model


def best_threshold(values: np.ndarray, labels: np.ndarray) -> float:
    """The cut with the highest F1 (values at or above it are toxic), in the middle of its gap."""
    order = np.argsort(-values, kind="stable")
    v, y = values[order], labels[order]
    hits = np.cumsum(y)
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    f1[:-1][v[:-1] == v[1:]] = -1  # equal values fall on one side
    k = int(f1.argmax())
    return float((v[k] + v[k + 1]) / 2) if k + 1 < len(v) else float(v[k] - 1.0)


def remainder(doc_id) -> F.Column:
    """crc32 of the id's text, modulo 5 (a null id counts as the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(5))


def labelled(labels: DataFrame, folds: tuple) -> DataFrame:
    """doc_id, _toxic and _fold of the labelled documents of ``folds``."""
    return (labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
            .withColumn("_fold", remainder("doc_id")).filter(F.col("_fold").isin(*folds)))


def training_sample(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_chars: int = MAX_CHARS,
                    folds: tuple = FIT_FOLDS) -> list:
    """(fold, lang, text, toxic) of a bounded sample of the labelled rows of ``folds``; an error if every picked text is too long."""
    known = labelled(labels, folds)
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow_columns = [F.length(text).alias("_chars"), F.crc32(text.cast("binary")).alias("_crc")]
    narrow = docs.select("doc_id", *narrow_columns)
    picked = (narrow.join(known, "doc_id").withColumn("_h", F.xxhash64(F.lit(11), "doc_id"))
              .orderBy("_h", "doc_id", "_crc").limit(max_rows))  # a bounded table from here on
    upto = F.sum("_chars").over(Window.orderBy("_chars", "_h", "doc_id", "_crc").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ids = picked.withColumn("_upto", upto).filter(F.col("_upto") <= max_chars).select("doc_id", "_chars", "_crc", "_fold", "_toxic").distinct()
    texts = docs.select("doc_id", "lang", "text", *narrow_columns)
    rows = texts.join(F.broadcast(ids), ["doc_id", "_chars", "_crc"]).select("doc_id", "_fold", "lang", "text", "_toxic").collect()
    if not rows and not picked.isEmpty():
        raise ValueError(f"no labelled text fits the training sample of {max_chars} characters")
    rows.sort(key=lambda r: (r["doc_id"], r["text"] or "", r["lang"] or ""))
    return [(r["_fold"], r["lang"], r["text"], int(r["_toxic"] > 0)) for r in rows]


def best_cuts(rows: DataFrame, centre: float, spread: float) -> list:
    """Per ``_group``: cut, toxic, total.  ``cut`` is the best_threshold() of all its rows (_group, _logit, _toxic).

    Distinct values are counted first and dealt to score ranges, so no task sees a whole group.
    """
    bins = F.floor(F.lit(BINS) / (1 + F.exp((F.col("_logit") - centre) / spread))).cast("int")  # high values first
    values = settle(rows.groupBy("_group", "_logit").agg(F.sum("_toxic").alias("_toxic"), F.count(F.lit(1)).alias("_n"))
                    .withColumn("_bin", bins))
    totals = values.groupBy("_group").agg(F.sum("_toxic").alias("toxic"), F.sum("_n").alias("total"))
    size = 200 * totals.count()
    above = preceding_sum(values, ["_group"], "_bin", [F.desc("_logit")], "_toxic", "_toxic_above")
    above = preceding_sum(above, ["_group"], "_bin", [F.desc("_logit")], "_n", "_n_above")
    hits = F.col("_toxic_above") + F.col("_toxic")
    f1 = 2 * hits / (F.col("_n_above") + F.col("_n") + F.col("toxic"))
    best = above.join(bounded_broadcast(totals, size), "_group").groupBy("_group", "toxic", "total").agg(F.max(F.struct(f1.alias("f1"), "_logit"))["_logit"].alias("_at"))
    under = values.join(bounded_broadcast(best, size), "_group").groupBy("_group", "toxic", "total", "_at").agg(
        F.max(F.when(F.col("_logit") < F.col("_at"), F.col("_logit"))).alias("_under"))
    cut = F.coalesce((F.col("_at") + F.col("_under")) / 2, F.col("_at") - 1.0)
    return under.select("_group", cut.alias("cut"), "toxic", "total").collect()


def calibrate(model: Model, docs: DataFrame, labels: DataFrame, folds: tuple) -> bool:
    """Put the common threshold at score 0.5 and fit one threshold per language, on all labelled rows of ``folds``.

    Says whether the rows hold both classes; if not, the model stays as it is.
    """
    mine = docs.select("doc_id", "lang", "text").filter(remainder("doc_id").isin(*folds))
    logits = with_score(mine, model, "_logit", logit=True).select("doc_id", F.coalesce("lang", F.lit("")).alias("_lang"), "_logit")
    rows = settle(logits.join(labelled(labels, folds), "doc_id").select("_lang", "_logit", (F.col("_toxic") > 0).cast("long").alias("_toxic")))
    sums = rows.agg(F.sum("_toxic"), F.count(F.lit(1)), F.avg("_logit"), F.stddev_pop("_logit")).first()
    if not 0 < (sums[0] or 0) < sums[1]:
        return False
    spread = max(sums[3], 1e-6)
    # the empty group holds all rows, each other group one language
    groups = F.explode(F.array(F.lit(""), F.concat(F.lit("="), "_lang"))).alias("_group")
    found = {r["_group"]: r for r in best_cuts(rows.select(groups, "_logit", "_toxic"), sums[2], spread)}
    model.centre, model.slope = found.pop("")["cut"], 4.0 / spread
    for name, r in sorted(found.items()):
        if r["toxic"] >= MIN_TOXIC and r["total"] - r["toxic"] >= MIN_TOXIC:
            model.thresholds[name[1:]] = model.score(r["cut"])
    return True


def fit(docs: DataFrame, labels: DataFrame, epochs: int = EPOCHS, max_rows: int = MAX_ROWS, max_chars: int = MAX_CHARS) -> Model:
    """The calibrated model.  Without labels of both classes every score is the share of toxic labels."""
    learn = training_sample(docs, labels, max_rows, max_chars) or training_sample(docs, labels, max_rows, max_chars, CALIBRATION_FOLDS)
    y = np.array([r[3] for r in learn], dtype=np.float32)
    if not len(y) or y.min() == y.max():
        empty = np.zeros
        return Model(empty((BUCKETS + 1, DIM), np.float32), empty((DIM, _OFFSETS * FILTERS), np.float32),
                     empty(len(WIDTHS) * FILTERS, np.float32), empty(len(WIDTHS) * FILTERS, np.float32), 0.0,
                     constant=float(y.mean()) if len(y) else 0.0)
    model = train([r[2] for r in learn], y, epochs)
    del learn
    if not calibrate(model, docs, labels, CALIBRATION_FOLDS):
        calibrate(model, docs, labels, FIT_FOLDS + CALIBRATION_FOLDS)
    return model


def _threshold(model: Model, lang: F.Column) -> F.Column:
    if not model.thresholds:
        return F.lit(0.5)
    pairs = [F.lit(x) for kv in model.thresholds.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.coalesce(lang, F.lit(""))), F.lit(0.5))


def with_score(docs: DataFrame, model: Model, name: str, logit: bool = False) -> DataFrame:
    """``docs`` and the score (or logit) of its text, null and empty texts included."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            score = scorer.logit if logit else scorer.score
            scores = pa.array([score(t.as_py()) for t in b.column(at)], type=pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns, scores], names=[*b.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def score_documents(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, threshold, rejected.

    ``threshold`` is the language's own; ``rejected`` says whether the score
    reaches it.  Null texts score as empty ones.  Repeated rows stay.
    """
    model = fit(docs, labels, **params)
    scored = with_score(docs.select("doc_id", "lang", "text"), model, "score")
    limit = _threshold(model, F.col("lang"))
    return scored.select("doc_id", (remainder("doc_id") == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), limit.alias("threshold"),
                         (F.col("score") >= limit).alias("rejected"))


def drop_toxic(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """``docs`` without the rows whose score reaches the threshold of their language."""
    model = fit(docs, labels, **params)
    name = free_name(docs, "_score")
    return with_score(docs, model, name).filter(F.col(name) < _threshold(model, F.col("lang"))).drop(name)
