"""Text vectorisation queries over all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from patchlens.config import ENGLISH_STOP_WORDS
from patchlens.operators import textvec as TV
from patchlens.operators.tfidf import TfidfVectorizer, entries
from patchlens.plans.registry import query
from patchlens.sources.tables import table

MAX_FEATURES = 5000


def _sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def _toks_sql() -> str:
    stop = _sql_list(ENGLISH_STOP_WORDS)
    return (f"(SELECT doc_id, list_filter(string_split(regexp_replace(lower(text), '[^a-z0-9_]+', ' ', 'g'), ' '), "
            f"lambda t: t <> '' AND regexp_matches(t, '^[a-z_]') AND NOT list_contains({stop}, t)) AS toks "
            f"FROM documents)")


TERMS_SQL = f"""(SELECT doc_id, unnest(list_concat(toks, list_transform(range(1, len(toks)), lambda i: toks[i] || ' ' || toks[i + 1]))) AS term
  FROM {_toks_sql()})"""
TF_SQL = f"(SELECT doc_id, term, count(*) AS tf FROM {TERMS_SQL} GROUP BY doc_id, term)"
NDOCS_SQL = "(SELECT count(*) FROM documents)"
VOCAB_SQL = f"""(SELECT term, df, total, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_index FROM (
  SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total FROM {TF_SQL} GROUP BY term
  HAVING count(*) >= 2 AND count(*) <= 0.95 * {NDOCS_SQL}
  ORDER BY total DESC, term LIMIT {MAX_FEATURES}))"""


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def _term_stats(spark, sf_dir, bigrams=True):
    docs = _docs(spark, sf_dir)
    return TV.text_stats(docs, "text", bigrams, TV.text_parts(docs, "text"))


@query("token_counts", sql=f"""
SELECT term AS token, count(DISTINCT doc_id) AS n_docs, count(*) AS n_total FROM (
  SELECT doc_id, unnest(toks) AS term FROM {_toks_sql()}) GROUP BY term
""")
def token_counts(spark, sf_dir):
    stats = _term_stats(spark, sf_dir, bigrams=False)
    return stats.select(F.col("term").alias("token"), F.col("df").alias("n_docs"), F.col("total").alias("n_total"))


@query("bigram_counts", sql=f"""
SELECT term AS bigram, count(*) AS n_docs, CAST(sum(tf) AS BIGINT) AS n_total FROM {TF_SQL} WHERE contains(term, ' ') GROUP BY term
""")
def bigram_counts(spark, sf_dir):
    stats = _term_stats(spark, sf_dir).filter(F.col("term").contains(" "))
    return stats.select(F.col("term").alias("bigram"), F.col("df").alias("n_docs"), F.col("total").alias("n_total"))


def _vocab(spark, sf_dir):
    n = table(spark, sf_dir, "documents").count()
    return TV.vocabulary(_term_stats(spark, sf_dir), n, min_df=2, max_df=0.95, max_features=MAX_FEATURES), n


@query("vocabulary", sql=f"SELECT term, df, total, term_index FROM {VOCAB_SQL}")
def vocabulary(spark, sf_dir):
    v, _ = _vocab(spark, sf_dir)
    return v.select("term", "df", "total", "term_index")


@query("tfidf", headline=True, sql=f"""
WITH w AS (SELECT t.doc_id, t.term, t.tf * (ln((1 + {NDOCS_SQL}) / (1.0 + v.df)) + 1) AS raw
           FROM {TF_SQL} t JOIN {VOCAB_SQL} v ON t.term = v.term),
n AS (SELECT doc_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM w)
SELECT doc_id, count(*) AS n_terms, round(max(weight), 6) AS max_weight, round(sum(weight), 6) AS sum_weight,
       arg_min(term, (-round(weight, 9), term)) AS top_term
FROM n GROUP BY doc_id
""")
def tfidf(spark, sf_dir):
    """Per document: non-zero terms, largest and summed TF-IDF weight, top term."""
    d = _docs(spark, sf_dir)
    model = TfidfVectorizer(inputCol="text", maxFeatures=MAX_FEATURES, parts=TV.text_parts(d, "text")).fit(d)
    w = model.transform(d).select("doc_id", entries(F.col("features")).alias("w"))
    # terms are indexed alphabetically, so the least index is the first term
    best = F.array_min(F.transform("w", lambda e: F.struct((-F.round(e["weight"], 9)).alias("weight"), e["term_index"].alias("term_index"))))
    facts = F.struct(
        F.size("w").cast("bigint").alias("n_terms"), F.round(F.array_max(F.transform("w", lambda e: e["weight"])), 6).alias("max_weight"),
        F.round(F.aggregate("w", F.lit(0.0), lambda a, e: a + e["weight"]), 6).alias("sum_weight"),
        model.term(best["term_index"]).alias("top_term"))
    # documents without a term of the vocabulary give no row; a filter would be pushed down and compute the weights twice
    return w.select("doc_id", F.inline(F.filter(F.array(facts), lambda f: f["n_terms"] > 0)))
