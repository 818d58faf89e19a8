"""Feature frames: the preparation features and the generator features.

A subject is a whole text, so ``scan_subject`` folds it once and turns all keyword
patterns into one bit set, in generators, which Catalyst neither duplicates nor
evaluates a second time for a filter.

``map_counts`` is the only step that needs data from other rows.  Its rows are
written once, without the text; the counts of the most frequent keys are broadcast
to their rows, and only the other rows are shuffled to theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchlens import config
from patchlens.functions import author as A
from patchlens.functions import subsystem as S
from patchlens.functions import temporal as T
from patchlens.functions import text as X
from patchlens.functions.multimatch import PatternSet, fold

HOT_KEYS = 64
#: A key is hot when it holds more than this share of the rows.
HOT_SHARE = 0.001
KEPT = "_kept"  # the keyword filter's name in a pattern set


def hot_keys(df: DataFrame, key: str, most: int = HOT_KEYS, share: float = HOT_SHARE) -> list:
    """At most ``most`` keys that a frequent-items sketch puts above ``share`` of the rows."""
    r = df.filter(F.col(key).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(`{key}`, {int(most)}, {max(1000, 16 * int(most))})").alias("top")).first()
    return [t["item"] for t in r["top"] or [] if t["count"] > share * r["n"]]


def map_counts(df: DataFrame, key: str, out: str = "author_patch_count") -> DataFrame:
    """value_counts mapped back on ``key``; a null key gets a null count.

    ``df`` is written once to the checkpoint folder, so it should be narrow.
    The sketch only chooses the path: hot keys' rows meet their exact counts in a
    broadcast of at most HOT_KEYS rows and are not shuffled; the rest is joined
    as AQE sees fit; rows without a key join nothing.
    """
    df = df.checkpoint(eager=True)
    hot = hot_keys(df, key)
    known = df.filter(F.col(key).isNotNull())
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    counts = known.groupBy(key).agg(F.count(F.lit(1)).alias(out))
    none = df.filter(F.col(key).isNull()).withColumn(out, F.lit(None).cast("bigint"))
    cold = known.filter(~is_hot).join(counts.filter(~is_hot), key, "left")
    parts = [cold, none]
    if hot:
        parts.append(known.filter(is_hot).join(F.broadcast(counts.filter(is_hot)), key, "left"))
    got = parts[0]
    for p in parts[1:]:
        got = got.unionByName(p)
    return got.select(*df.columns, out)


def scan_subject(df: DataFrame, patterns: PatternSet, subject: str = "subject") -> DataFrame:
    """Add ``_bits``, the bit set of the patterns that the subject holds; the text is folded and searched once."""
    def once(d: DataFrame, value: Column, name: str) -> DataFrame:
        # a generator's output is computed once; a projection's would be repeated in every filter and flag on it
        return d.select("*", F.inline(F.array(F.struct(value.alias(name)))))

    return once(once(df, fold(F.col(subject)), "_low"), patterns.bits(F.col("_low")), "_bits").drop("_low")


def text_features(df: DataFrame, subject: str = "subject", keywords: list[str] | None = None,
                  flags: list[tuple[str, str]] = config.SUBJECT_FLAGS) -> DataFrame:
    """Length, words and the keyword flags; with ``keywords`` only the rows whose subject holds one (B4), in the same pass."""
    extra = [(KEPT, X.keyword_pattern(keywords))] if keywords else []
    patterns = PatternSet([*flags, *extra])
    d = scan_subject(df, patterns, subject)
    if keywords:
        d = d.filter(patterns.flag(F.col("_bits"), KEPT))
    return d.select("*", X.char_length(subject).alias("subject_length"), X.word_count(subject).alias("word_count"),
                    *[patterns.flag(F.col("_bits"), n).alias(n) for n, _ in flags]).drop("_bits")


def author_features(df: DataFrame, email: str = "author_email") -> DataFrame:
    df = map_counts(df, email)
    return df.select(
        "*",
        A.is_frequent_author("author_patch_count").alias("is_frequent_author"),
        A.is_scheduler_maintainer(email).alias("is_scheduler_maintainer"),
    )


def temporal_features(df: DataFrame, send_time: str = "send_time") -> DataFrame:
    ts = T.epoch_ms_to_ts(send_time)
    return df.withColumn("timestamp", ts).select("*", *T.calendar_parts("timestamp"))


def preparation_features(df: DataFrame, subject: str = "subject", keywords: list[str] | None = None) -> DataFrame:
    """Text, author and temporal features of the preparation stage, without the text.

    With ``keywords`` only the rows whose subject holds one are kept (and
    counted), as ``labels.keyword_filter`` does, in the pass that computes the flags.
    """
    return temporal_features(author_features(text_features(df, subject, keywords).drop(subject)))


def generator_features(df: DataFrame, subject: str = "subject", email: str = "author_email",
                       send_time: str | None = "send_time", keyword_sets=None) -> DataFrame:
    """Features + rule-derived targets of the generator stage (lower-cased subject)."""
    sets = keyword_sets or config.SUBSYSTEM_KEYWORDS
    low = F.lower(F.col(subject))
    email_c: Column = F.col(email) if email in df.columns else F.lit(config.DEFAULT_AUTHOR_EMAIL)
    base = df.select(
        "*",
        X.char_length(low).alias("subject_length"),
        X.word_count(low).alias("word_count"),
        X.has_colon(low).alias("has_colon"),
        X.has_brackets(low).alias("has_brackets"),
        X.count_char(low, "!").alias("exclamation_count"),
        X.count_char(low, "?").alias("question_count"),
        A.author_is_maintainer(email_c).alias("author_is_maintainer"),
        A.author_domain_length(email_c).alias("author_domain_length"),
        *S.subsystem_scores(low, sets),
    )
    names = [n for n, _ in sets]
    sub = S.primary_subsystem([f"{n}_score" for n in names], names)
    base = base.withColumn("target_subsystem", sub)
    base = base.select("*", *S.derived_targets("target_subsystem"),
                       S.complexity_label(low).alias("target_complexity"))
    if send_time and send_time in df.columns:
        ts = T.epoch_ms_to_ts(send_time)
        parts = T.calendar_parts_by_name(ts)
        base = base.select("*", *[parts[k] for k in ["hour", "day_of_week", "month", "is_weekend", "is_business_hours"]])
    return base


def generator_feature_names(keyword_sets=None, with_time: bool = True) -> list[str]:
    sets = keyword_sets or config.SUBSYSTEM_KEYWORDS
    names = [
        "subject_length", "word_count", "has_colon", "has_brackets", "exclamation_count",
        "question_count", "author_is_maintainer", "author_domain_length",
    ]
    for n, _ in sets:
        names += [f"{n}_score", f"has_{n}"]
    if with_time:
        names += ["hour", "day_of_week", "month", "is_weekend", "is_business_hours"]
    return names
