"""Preparation stage: label join, subject filters, features, ML matrix, reports.

Every query reads the test tables through ``patchlens.sources.tables``.
Oracle SQL builds the same result in DuckDB from the raw views.  Flags are
returned as INT, counts as BIGINT, doubles rounded to 6 digits.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from patchlens import config
from patchlens.functions import author as A
from patchlens.functions import text as X
from patchlens.operators import features as FE
from patchlens.operators import labels as L
from patchlens.operators import matrix as M
from patchlens.plans.registry import query
from patchlens.sources.tables import PATCH_VIEW_SQL, patch_view, table

PV = PATCH_VIEW_SQL
KW = "|".join(config.SCHEDULING_KEYWORDS)


def _flags_sql(col: str = "subject") -> str:
    return ",\n".join(
        f"CAST(coalesce(regexp_matches({col}, '{pat}', 'i'), false) AS INTEGER) AS {name}"
        for name, pat in config.SUBJECT_FLAGS
    )


def _int_flags(df, names):
    return df.select(*[F.col(c).cast("int").alias(c) if c in names else F.col(c) for c in df.columns])


FLAG_NAMES = [n for n, _ in config.SUBJECT_FLAGS]
CAL_SQL = """
CAST(hour(ts) AS INTEGER) AS hour,
CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
CAST(month(ts) AS INTEGER) AS month,
CAST(year(ts) AS INTEGER) AS year,
CAST(coalesce(hour(ts) BETWEEN 9 AND 17, false) AS INTEGER) AS is_business_hours,
CAST(coalesce(isodow(ts) - 1 IN (5, 6), false) AS INTEGER) AS is_weekend"""
CAL_NAMES = ["hour", "day_of_week", "month", "year", "is_business_hours", "is_weekend"]


def scheduling_patches(spark, sf_dir):
    return L.keyword_filter(L.not_null(patch_view(spark, sf_dir), "subject"), "subject")


def scheduling_features(spark, sf_dir):
    """The features of the scheduling patches; every subject is read once for the filter, the flags and the words."""
    return FE.preparation_features(L.not_null(patch_view(spark, sf_dir), "subject"), keywords=config.SCHEDULING_KEYWORDS)


SCHED_SQL = f"(SELECT * FROM {PV} WHERE subject IS NOT NULL AND regexp_matches(subject, '{KW}', 'i'))"


# ---------------------------------------------------------------- flagship

@query("acceptance_by_year", headline=True, sql=f"""
WITH f AS (
  SELECT accepted, make_timestamp(send_time * 1000) AS ts,
         {_flags_sql()}
  FROM {SCHED_SQL})
SELECT CAST(year(ts) AS INTEGER) AS year,
       CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
       CAST(coalesce(hour(ts) BETWEEN 9 AND 17, false) AS INTEGER) AS is_business_hours,
       count(*) AS n_patches,
       round(avg(accepted), 6) AS acceptance_rate,
       CAST(sum(has_fix) AS BIGINT) AS n_fix,
       CAST(sum(has_realtime) AS BIGINT) AS n_realtime,
       CAST(sum(has_load_balance) AS BIGINT) AS n_load_balance
FROM f GROUP BY 1, 2, 3
""")
def acceptance_by_year(spark, sf_dir):
    """Flagship: label join -> keyword filter -> features -> acceptance by calendar slot.

    The filter is a regex, which Catalyst evaluates below the joins, so they carry only the matching texts.
    """
    used = [f for f in config.SUBJECT_FLAGS if f[0] in ("has_fix", "has_realtime", "has_load_balance")]
    f = FE.temporal_features(FE.text_features(scheduling_patches(spark, sf_dir), flags=used))
    return f.groupBy(
        F.col("year"), F.col("day_of_week"), F.col("is_business_hours").cast("int").alias("is_business_hours")
    ).agg(
        F.count(F.lit(1)).alias("n_patches"),
        F.round(F.avg("accepted"), 6).alias("acceptance_rate"),
        F.sum(F.col("has_fix").cast("int")).cast("bigint").alias("n_fix"),
        F.sum(F.col("has_realtime").cast("int")).cast("bigint").alias("n_realtime"),
        F.sum(F.col("has_load_balance").cast("int")).cast("bigint").alias("n_load_balance"),
    )


# ------------------------------------------------------------ joins

@query("label_join", headline=True, sql=f"""
SELECT patch_id, subject, author_email, send_time, accepted FROM {PV} WHERE subject IS NOT NULL
""")
def label_join(spark, sf_dir):
    return L.not_null(patch_view(spark, sf_dir), "subject").select(
        "patch_id", "subject", "author_email", "send_time", "accepted")


@query("label_join_fanout", sql="""
SELECT o.o_orderkey, o.o_totalprice,
       CASE WHEN l.l_orderkey IS NOT NULL THEN 1 ELSE 0 END AS accepted
FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey
""")
def label_join_fanout(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return L.attach_label(o, li, "o_orderkey")


@query("label_join_dedup", sql="""
SELECT o.o_orderkey, o.o_totalprice,
       CASE WHEN l.k IS NOT NULL THEN 1 ELSE 0 END AS accepted
FROM orders o LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem) l ON o.o_orderkey = l.k
""")
def label_join_dedup(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return L.attach_label(o, li, "o_orderkey", dedup=True)


# ------------------------------------------------------------- filters (B)

@query("keyword_filter", sql=f"SELECT patch_id, accepted FROM {SCHED_SQL}")
def keyword_filter(spark, sf_dir):
    return scheduling_patches(spark, sf_dir).select("patch_id", "accepted")


REGEXP_SQL = (f"(SELECT * FROM {PV} WHERE subject IS NOT NULL "
              f"AND regexp_matches(subject, '{config.GENERATOR_SUBJECT_REGEXP}', 'i') AND strlen(subject) > 10)")


@query("regexp_min_length", sql=f"SELECT patch_id, accepted, CAST(strlen(subject) AS BIGINT) AS subject_bytes FROM {REGEXP_SQL}")
def regexp_min_length(spark, sf_dir):
    df = L.regexp_min_length(patch_view(spark, sf_dir), "subject")
    return df.select("patch_id", "accepted", F.octet_length("subject").cast("bigint").alias("subject_bytes"))


@query("limit_rows", sql=f"""
SELECT patch_id, accepted, '' AS patch_content FROM {REGEXP_SQL} ORDER BY patch_id LIMIT 100
""")
def limit_rows(spark, sf_dir):
    df = L.regexp_min_length(patch_view(spark, sf_dir), "subject").select("patch_id", "accepted")
    return L.add_constant(L.limit_rows(df, 100, "patch_id"), "patch_content", "")


# ------------------------------------------------------------ features (H)

@query("text_features", sql=f"""
SELECT patch_id, CAST(length(subject) AS INTEGER) AS subject_length,
       CAST(coalesce(len(regexp_extract_all(subject, '\\S+')), 0) AS INTEGER) AS word_count
FROM {SCHED_SQL}
""")
def text_features(spark, sf_dir):
    return scheduling_patches(spark, sf_dir).select(
        "patch_id", X.char_length("subject").alias("subject_length"), X.word_count("subject").alias("word_count"))


@query("text_flags", sql=f"SELECT patch_id, {_flags_sql()} FROM {SCHED_SQL}")
def text_flags(spark, sf_dir):
    df = FE.text_features(L.not_null(patch_view(spark, sf_dir), "subject"), keywords=config.SCHEDULING_KEYWORDS)
    return _int_flags(df.select("patch_id", *FLAG_NAMES), FLAG_NAMES)


@query("author_counts", sql=f"""
SELECT patch_id, author_email,
       CASE WHEN author_email IS NULL THEN NULL ELSE count(*) OVER (PARTITION BY author_email) END AS author_patch_count,
       CAST(coalesce(count(*) OVER (PARTITION BY author_email) >= 10 AND author_email IS NOT NULL, false) AS INTEGER) AS is_frequent_author
FROM {SCHED_SQL}
""")
def author_counts(spark, sf_dir):
    df = FE.author_features(scheduling_patches(spark, sf_dir).select("patch_id", "author_email"))
    return df.select("patch_id", "author_email", "author_patch_count",
                     F.col("is_frequent_author").cast("int").alias("is_frequent_author"))


@query("membership_flag", sql=f"""
SELECT patch_id,
       CAST(coalesce(author_email IN ({", ".join("'" + a + "'" for a in config.SCHEDULER_MAINTAINERS)}), false) AS INTEGER) AS is_scheduler_maintainer,
       CAST(coalesce(author_email IN ('u1@example.com', 'u7@redhat.com', 'u12@redhat.com'), false) AS INTEGER) AS is_listed_author
FROM {SCHED_SQL}
""")
def membership_flag(spark, sf_dir):
    df = scheduling_patches(spark, sf_dir)
    return df.select(
        "patch_id",
        A.is_scheduler_maintainer("author_email").cast("int").alias("is_scheduler_maintainer"),
        A.is_member("author_email", ["u1@example.com", "u7@redhat.com", "u12@redhat.com"]).cast("int").alias("is_listed_author"),
    )


@query("author_features", sql=f"""
SELECT patch_id,
       CAST(coalesce(contains(lower(author_email), 'kernel.org') OR contains(lower(author_email), 'linux.org')
            OR contains(lower(author_email), 'redhat.com') OR contains(lower(author_email), 'intel.com'), false) AS INTEGER) AS author_is_maintainer,
       CAST(CASE WHEN contains(author_email, '@') THEN length(split_part(author_email, '@', -1)) ELSE 0 END AS INTEGER) AS author_domain_length
FROM {PV}
""")
def author_features(spark, sf_dir):
    df = patch_view(spark, sf_dir)
    return df.select(
        "patch_id",
        A.author_is_maintainer("author_email").cast("int").alias("author_is_maintainer"),
        A.author_domain_length("author_email").alias("author_domain_length"),
    )


@query("temporal_features", sql=f"""
SELECT patch_id, {CAL_SQL} FROM (SELECT patch_id, make_timestamp(send_time * 1000) AS ts FROM {SCHED_SQL})
""")
def temporal_features(spark, sf_dir):
    df = FE.temporal_features(scheduling_patches(spark, sf_dir))
    return _int_flags(df.select("patch_id", *CAL_NAMES), ["is_business_hours", "is_weekend"])


# ----------------------------------------------------------- matrix (B8..)

ML_SQL = f"""
WITH s AS (SELECT *, make_timestamp(send_time * 1000) AS ts FROM {SCHED_SQL}),
f AS (
  SELECT patch_id, accepted,
         CAST(length(subject) AS INTEGER) AS subject_length,
         CAST(coalesce(len(regexp_extract_all(subject, '\\S+')), 0) AS INTEGER) AS word_count,
         {_flags_sql()},
         CASE WHEN author_email IS NULL THEN NULL ELSE count(*) OVER (PARTITION BY author_email) END AS author_patch_count,
         CAST(coalesce(author_email IN ({", ".join("'" + a + "'" for a in config.SCHEDULER_MAINTAINERS)}), false) AS INTEGER) AS is_scheduler_maintainer,
         {CAL_SQL}
  FROM s)
"""


@query("ml_matrix", sql=ML_SQL + """
SELECT patch_id, subject_length, word_count, has_fix, has_performance, has_latency, has_numa, has_realtime,
       has_cfs, has_load_balance, has_runqueue, coalesce(author_patch_count, 0) AS author_patch_count,
       CAST(coalesce(author_patch_count >= 10, false) AS INTEGER) AS is_frequent_author, is_scheduler_maintainer,
       coalesce(hour, 0) AS hour, coalesce(day_of_week, 0) AS day_of_week, coalesce(month, 0) AS month,
       coalesce(year, 0) AS year, is_business_hours, is_weekend, accepted
FROM f
""")
def ml_matrix(spark, sf_dir):
    feats = scheduling_features(spark, sf_dir)
    return M.ml_matrix(feats, "patch_id", "accepted")


@query("numeric_only", sql=ML_SQL + """
SELECT patch_id, subject_length, word_count, coalesce(author_patch_count, 0) AS author_patch_count,
       coalesce(hour, 0) AS hour, coalesce(day_of_week, 0) AS day_of_week, coalesce(month, 0) AS month,
       coalesce(year, 0) AS year, accepted
FROM f
""")
def numeric_only(spark, sf_dir):
    feats = scheduling_features(spark, sf_dir)
    return M.ml_matrix(feats, "patch_id", "accepted", include_bool=False)


@query("exclude_prefix", sql="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(l_quantity, 0) AS l_quantity, coalesce(l_discount, 0) AS l_discount,
       coalesce(l_tax, 0) AS l_tax FROM lineitem
""")
def exclude_prefix(spark, sf_dir):
    """Number columns of line items beside their key, less those whose name starts with a prefix."""
    li = table(spark, sf_dir, "lineitem")
    keys = ("l_orderkey", "l_linenumber")
    cols = M.ml_columns(li, exclude=keys, exclude_prefix="l_extended")
    return M.fill_zero(li.select(*keys, *cols), cols)


@query("align_columns", sql=ML_SQL + """
SELECT patch_id, word_count, coalesce(hour, 0) AS hour, 0 AS commit_count, subject_length FROM f
""")
def align_columns(spark, sf_dir):
    m = ml_matrix(spark, sf_dir)
    return M.align_columns(m, ["word_count", "hour", "commit_count", "subject_length"], fill=0, keep=["patch_id"])


@query("align_rows", sql=f"""
SELECT f.patch_id, CAST(coalesce(len(regexp_extract_all(f.subject, '\\S+')), 0) AS INTEGER) AS word_count,
       l.quality AS quality
FROM {SCHED_SQL} f JOIN labels l ON f.patch_id = l.doc_id
""")
def align_rows(spark, sf_dir):
    x = scheduling_patches(spark, sf_dir).select("patch_id", X.word_count("subject").alias("word_count"))
    y = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("patch_id"), "quality")
    return x.join(y, "patch_id", "inner")


@query("clean_text", sql="""
SELECT conv_id, turn, CASE WHEN text IS NULL OR trim(text) = '' THEN 'unknown' ELSE text END AS text_clean
FROM conversations
""")
def clean_text(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", X.clean_text("text").alias("text_clean"))


@query("detect_text_column", sql="""
WITH h AS (
  SELECT 0 AS position, 'lang' AS candidate, v FROM (SELECT lang AS v FROM documents WHERE lang IS NOT NULL ORDER BY doc_id LIMIT 10)
  UNION ALL
  SELECT 1, 'source', v FROM (SELECT source AS v FROM documents WHERE source IS NOT NULL ORDER BY doc_id LIMIT 10)
  UNION ALL
  SELECT 2, 'text', v FROM (SELECT text AS v FROM documents WHERE text IS NOT NULL ORDER BY doc_id LIMIT 10))
, st AS (SELECT position, candidate, round(avg(length(v)), 6) AS mean_len,
                 round(count(DISTINCT v) / count(v), 6) AS unique_ratio,
                 CAST(avg(length(v)) > 20 AND count(DISTINCT v) / count(v) > 0.7 AS INTEGER) AS qualifies
          FROM h GROUP BY position, candidate)
SELECT position, candidate, mean_len, unique_ratio, qualifies,
       CAST(coalesce(position = (SELECT min(position) FROM st WHERE qualifies = 1), candidate = 'text') AS INTEGER) AS chosen
FROM st
""")
def detect_text_column(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    out = M.detect_text_column(d, ["subject", "lang", "source", "text"], order_by="doc_id")
    return out.select("position", "candidate", F.round("mean_len", 6).alias("mean_len"),
                      F.round("unique_ratio", 6).alias("unique_ratio"), "qualifies", "chosen")


# ----------------------------------------------------------- reports (D)

@query("dataset_report", sql=ML_SQL + """
, y AS (SELECT year, count(*) AS n FROM f GROUP BY year)
SELECT (SELECT count(*) FROM f) AS total_patches,
       19 AS n_features,
       (SELECT round(avg(accepted), 6) FROM f) AS acceptance_rate,
       (SELECT string_agg(coalesce(CAST(year AS VARCHAR), 'null') || ':' || n, ',' ORDER BY year) FROM y) AS yearly_distribution
""")
def dataset_report(spark, sf_dir):
    feats = scheduling_features(spark, sf_dir)
    n_features = len(M.ml_columns(feats, exclude=M.DEFAULT_EXCLUDE + ("patch_id",)))
    # one grouped pass, then a global aggregate over the (small) per-year table
    years = feats.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum("accepted").alias("acc"))
    return years.agg(
        F.sum("n").alias("total_patches"),
        F.round(F.sum("acc") / F.sum("n"), 6).alias("acceptance_rate"),
        F.concat_ws(",", F.transform(
            F.array_sort(F.collect_list(F.struct("year", "n"))),
            lambda s: F.concat(F.coalesce(s["year"].cast("string"), F.lit("null")), F.lit(":"), s["n"].cast("string")),
        )).alias("yearly_distribution"),
    ).select(F.col("total_patches").cast("bigint"), F.lit(n_features).alias("n_features"), "acceptance_rate",
             "yearly_distribution")


@query("yearly_distribution", sql="""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_orders FROM orders GROUP BY 1
""")
def yearly_distribution(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n_orders")).orderBy("year")


N_CHUNKS = 10


@query("chunked_union", sql="""
SELECT l_returnflag, l_linestatus, count(*) AS n_rows, round(sum(l_quantity), 6) AS sum_qty
FROM lineitem GROUP BY 1, 2
""")
def chunked_union(spark, sf_dir):
    """The table read in key ranges of about equal row counts, concatenated (UNION ALL)."""
    from patchlens.sources.io import chunked_scan, row_chunks

    li = table(spark, sf_dir, "lineitem")
    u = chunked_scan(li, "l_orderkey", row_chunks(li, "l_orderkey", N_CHUNKS), include_rest=True)
    return u.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("l_quantity"), 6).alias("sum_qty"))
