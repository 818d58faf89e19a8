"""One query per operator: each applies its operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchlens.llm import (ann, decontam, lexical, licenses, mixing, packing, ring, rollup, simhash, template, toxicity, warc,
                           whitening)
from patchlens.llm.common import read, settle, shared_folder, word_count

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


OP1_SQL = f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) AS size,
                  md5(concat(coalesce(CAST(doc_id AS VARCHAR), 'null'), '|0')) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             [3, 1, 2][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS w FROM d GROUP BY source),
o AS (SELECT *, {mixing.MAX_REPEAT} * source_size AS cap, sum(source_size) OVER () AS total,
             sum(w) OVER () - sum(w) OVER before AS w_left, sum({mixing.MAX_REPEAT} * source_size) OVER before AS cap_before
      FROM s WINDOW before AS (ORDER BY {mixing.MAX_REPEAT} * source_size / w, source IS NULL, source
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, 15 * total - 10 * coalesce(cap_before, 0) AS left10, coalesce(w_left, sum(w) OVER ()) AS w_open FROM o),
f AS (SELECT *, cap * 10 * w_open <= left10 * w AS stops FROM l),
t AS (SELECT source, source_size, stops, cap, w,
             first_value(left10) OVER open_first AS left10, first_value(w_open) OVER open_first AS w_open
      FROM f WINDOW open_first AS (ORDER BY stops, cap / w, source IS NULL, source
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
p AS (SELECT source, source_size, CASE WHEN stops THEN CAST(cap AS DOUBLE) ELSE w * CAST(left10 AS DOUBLE) / (CAST(w_open AS DOUBLE) * 10) END AS target,
             CAST(CASE WHEN stops THEN cap ELSE (w * left10 * 2 + w_open * 10) // (w_open * 20) END AS BIGINT) AS take FROM t),
r AS (SELECT d.doc_id, d.size, p.source_size, p.target, p.take,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(greatest(0, least(size, take - pos)) + greatest(0, least(size, take - source_size - pos)) AS BIGINT) AS taken FROM r
"""


@query("op1_mixing", sql=OP1_SQL)
def op1_mixing(spark, sf_dir):
    # three narrow columns: the texts are read once
    sizes = settle(read(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size")))
    m = mixing.draws_of_rows(sizes)
    taken = F.aggregate("mix.draws", F.lit(0).cast("bigint"), lambda a, d: a + d["words"])
    return m.select("_row.doc_id", "mix.size", "mix.source_size", "mix.target", taken.alias("taken"))


OP6_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS n, sha256(payload) AS digest FROM p),
f AS (SELECT *, CASE WHEN n >= {warc.REVISIT_BYTES} THEN min(page_id) OVER (PARTITION BY digest) ELSE page_id END AS first FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to FROM f
"""


@query("op6_warc", sql=OP6_SQL)
def op6_warc(spark, sf_dir):
    folder = shared_folder(spark, "warc")
    manifest = warc.write_archives(read(spark, sf_dir, "pages"), folder)
    rows = settle(warc.read_archives(manifest, folder))
    warc.drop_archives(folder)
    return rows


@query("op7_sharding")
def op7_sharding(spark, sf_dir):
    return ring.shard_documents(read(spark, sf_dir, "documents"))


OP2_SQL = """
WITH v AS (SELECT row_number() OVER () AS k, vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.k, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
      FROM v q JOIN v c ON q.k <> c.k AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""


@query("op2_nearest_neighbours", sql=OP2_SQL)
def op2_nearest_neighbours(spark, sf_dir):
    return ann.nearest(read(spark, sf_dir, "embeddings"))


@query("op3_toxicity")
def op3_toxicity(spark, sf_dir):
    return toxicity.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op4_token_counts")
def op4_token_counts(spark, sf_dir):
    """All documents arrive without a known source, then a batch revises every one to its own.

    The arrivals' totals are taken away by the revision's negative entries; both
    batches are sent twice, which changes nothing.  Documents without an id
    cannot be revised and arrive with their source.
    """
    table = rollup.Rollup(spark, shared_folder(spark, "rollup"))
    docs = read(spark, sf_dir, "documents")
    known = F.col("doc_id").isNotNull()
    arrivals = docs.withColumn("op", F.lit("insert")).withColumn("source", F.when(known, F.lit("unsorted")).otherwise(F.col("source")))
    for name, batch in (("arrivals", arrivals), ("revision", docs.filter(known).withColumn("op", F.lit("revise")))):
        table.commit(name, batch)
        table.commit(name, batch)
    totals = settle(table.totals())
    table.drop()
    return totals


@query("op5_simhash")
def op5_simhash(spark, sf_dir):
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


_NOTICES = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in licenses.NOTICES + licenses.SHORT_NOTICES)
_WORDS = "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\pL\\pN]+'), lambda w: w <> '')"
#: (position, shingle) of every run of k words; k is the template's shingle length, five words at most.
_GRAMS = "unnest(range(1, len(w) - k + 2)) AS i, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i+k-1], ' '))) AS s"
OP8_SQL = f"""
WITH t AS (SELECT template_id, w, least({licenses.SHINGLE}, len(w)) AS k
           FROM (SELECT template_id, {_WORDS} AS w FROM (VALUES {_NOTICES}) v(template_id, text)) WHERE len(w) > 0),
d AS (SELECT DISTINCT doc_id, text FROM documents),
dw AS (SELECT doc_id, text, k, w FROM (SELECT doc_id, text, {_WORDS} AS w FROM d), (SELECT DISTINCT k FROM t)),
ts AS (SELECT DISTINCT template_id, k, s FROM (SELECT template_id, k, {_GRAMS} FROM t)),
n AS (SELECT template_id, count(*) AS n FROM ts GROUP BY template_id),
ds AS (SELECT doc_id, text, k, {_GRAMS} FROM dw),
m AS (SELECT doc_id, text, template_id, CAST(count(DISTINCT s) AS INTEGER) AS matched, CAST(min(i) - 1 AS INTEGER) AS first_word
      FROM ds JOIN ts USING (k, s) GROUP BY doc_id, text, template_id)
SELECT doc_id, template_id, matched, matched / CAST(n AS DOUBLE) AS containment, first_word
FROM m JOIN n USING (template_id) WHERE matched / CAST(n AS DOUBLE) >= {licenses.CONTAINMENT}
"""


@query("op8_license_scan", sql=OP8_SQL)
def op8_license_scan(spark, sf_dir):
    return licenses.scan(read(spark, sf_dir, "documents"), licenses.notices(spark))


@query("op9_html_extraction")
def op9_html_extraction(spark, sf_dir):
    return template.extract(read(spark, sf_dir, "pages"))


@query("op10_decontamination")
def op10_decontamination(spark, sf_dir):
    return decontam.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op11_packing")
def op11_packing(spark, sf_dir):
    folder = shared_folder(spark, "packing")
    pieces = packing.pack(read(spark, sf_dir, "documents"), folder)
    rows = settle(pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"))
    packing.drop(spark, folder)
    return rows


@query("op12_whitening")
def op12_whitening(spark, sf_dir):
    rows = whitening.whiten(read(spark, sf_dir, "embeddings"))
    return rows.select("vec_id", "component", "n", F.expr("try_cast(deviation as bigint)").alias("deviation"), "whitened", "explained", "identity_error")


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id,
                  regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents WHERE text IS NOT NULL),
c AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
t AS (SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(w) AS term FROM d) GROUP BY k, term),
f AS (SELECT term, count(*) AS df FROM t GROUP BY term),
q AS (SELECT item_id, text, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
      FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)),
qt AS (SELECT item_id, text, term, count(*) AS r FROM (SELECT item_id, text, unnest(w) AS term FROM q) GROUP BY item_id, text, term),
s AS (SELECT qt.item_id, qt.text, d.k, any_value(d.doc_id) AS doc_id,
             CAST(sum(qt.r * CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2 * f.df + 1))) AS BIGINT)
                      * ((1000000000 * t.tf) // (1000 * t.tf + 12 * (75 + (25 * len(d.w) * n_docs) // n_terms)))) AS BIGINT) AS score
      FROM qt JOIN t USING (term) JOIN f USING (term) JOIN d USING (k) CROSS JOIN c GROUP BY qt.item_id, qt.text, d.k)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
WHERE rank <= 20
"""


@query("op13_lexical_search", sql=OP13_SQL)
def op13_lexical_search(spark, sf_dir):
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
