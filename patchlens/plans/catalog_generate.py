"""Generator features, rule-derived targets, templates, quality and batch evaluation.

Bindings: generator features on ``patch_view`` subjects (whole texts) with
the fixed keyword sets; evaluation prompts are derived one per ``documents``
row (base[i % 20] + modifier[i % 10] with i = doc_id), so the batch grows
with the table; quality scoring also runs over ``pages.html``.
"""

from __future__ import annotations

from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.sql import functions as F

from patchlens import config
from patchlens.functions import codegen as CG
from patchlens.functions import subsystem as S
from patchlens.functions import text as X
from patchlens.operators import features as FE
from patchlens.operators import generate as G
from patchlens.operators import labels as L
from patchlens.plans.catalog_eval import SCORES_SQL, event_scores
from patchlens.plans.registry import query
from patchlens.sources.tables import PATCH_VIEW_SQL, patch_view, table

PV = PATCH_VIEW_SQL


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# ------------------------------------------------------------ SQL builders

def sql_wc(x: str) -> str:
    return f"CAST(coalesce(len(regexp_extract_all({x}, '\\S+')), 0) AS INTEGER)"


def sql_scores(low: str, sets=None) -> list[str]:
    out = []
    for name, kws in sets or config.SUBSYSTEM_KEYWORDS:
        s = " + ".join(f"CAST(coalesce(contains({low}, {q(k)}), false) AS INTEGER)" for k in kws)
        out.append(f"({s})")
    return out


def sql_primary(low: str, sets=None) -> str:
    sets = sets or config.SUBSYSTEM_KEYWORDS
    arr = "[" + ", ".join(sql_scores(low, sets)) + "]"
    names = "[" + ", ".join(q(n) for n, _ in sets) + "]"
    return f"{names}[list_position({arr}, list_max({arr}))]"


def sql_complexity(low: str) -> str:
    simple = " OR ".join(f"contains({low}, {q(w)})" for w in config.SIMPLE_WORDS)
    cplx = " OR ".join(f"contains({low}, {q(w)})" for w in config.COMPLEX_WORDS)
    wc = sql_wc(low)
    return (f"CASE WHEN coalesce({simple}, false) AND {wc} <= {config.SIMPLE_MAX_WORDS} THEN 'simple' "
            f"WHEN coalesce({cplx}, false) OR {wc} > {config.COMPLEX_MIN_WORDS_EXCLUSIVE} THEN 'complex' ELSE 'medium' END")


def sql_lookup(sub: str, rows, i: int) -> str:
    default = [r for r in rows if r[0] == config.DEFAULT_SUBSYSTEM][0][i]
    whens = " ".join(f"WHEN {q(r[0])} THEN {q(r[i])}" for r in rows)
    return f"(CASE {sub} {whens} ELSE {q(default)} END)"


TARGET_FIELDS = ["primary_variable", "function", "condition", "action", "file_path"]
CONFIG_FIELDS = ["path", "type", "init", "secondary_decl", "ret_val", "lock_acquire", "lock_release"]


def sql_target(sub: str, field: str) -> str:
    return sql_lookup(sub, config.TARGET_DEFAULTS, TARGET_FIELDS.index(field) + 1)


def sql_config(sub: str, field: str) -> str:
    return sql_lookup(sub, config.TEMPLATE_CONFIG, CONFIG_FIELDS.index(field) + 1)


def sql_additional(sub: str, comp: str) -> str:
    whens = " ".join(f"WHEN {sub} = {q(s)} AND {comp} = {q(c)} THEN {q(v)}" for s, c, v in config.ADDITIONAL_LOGIC)
    return f"(CASE WHEN {comp} = 'simple' THEN '' {whens} ELSE '' END)"


def sql_truncate(x: str, n: int = config.DESCRIPTION_MAX_CHARS) -> str:
    return f"(CASE WHEN length({x}) > {n} THEN substr({x}, 1, {n}) || '...' ELSE {x} END)"


def sql_assemble(desc: str, sub: str, comp: str) -> str:
    t = config.TEMPLATES
    out = f"(CASE {comp} WHEN 'medium' THEN {q(t['medium'])} WHEN 'complex' THEN {q(t['complex'])} ELSE {q(t['simple'])} END)"
    values = [
        ("{path}", sql_config(sub, "path")),
        ("{function_signature}", sql_target(sub, "function")),
        ("{type}", sql_config(sub, "type")),
        ("{primary_var}", sql_target(sub, "primary_variable")),
        ("{init}", sql_config(sub, "init")),
        ("{secondary_decl}", sql_config(sub, "secondary_decl")),
        ("{condition}", sql_target(sub, "condition")),
        ("{action}", sql_target(sub, "action")),
        ("{ret_val}", sql_config(sub, "ret_val")),
        ("{additional_logic}", sql_additional(sub, comp)),
        ("{lock_acquire}", sql_config(sub, "lock_acquire")),
        ("{lock_release}", sql_config(sub, "lock_release")),
    ]
    for tok, v in values:
        out = f"replace({out}, {q(tok)}, {v})"
    return f"replace({out}, '{{description}}', {sql_truncate(desc)})"


def sql_quality_parts(c: str) -> dict[str, str]:
    def cnt(ch):
        return f"(length({c}) - length(replace({c}, {q(ch)}, '')))"
    lines = f"string_split({c}, chr(10))"
    syntax = (f"(CAST({cnt('{')} = {cnt('}')} AS INTEGER) * 10 + CAST({cnt('(')} = {cnt(')')} AS INTEGER) * 10 "
              f"+ CAST(contains({c}, ';') AS INTEGER) * 5)")
    style = (f"(CAST(len(list_filter({lines}, lambda l: starts_with(l, chr(9)))) > len(list_filter({lines}, lambda l: starts_with(l, '    '))) AS INTEGER) * 15 "
             f"+ CAST(len(list_filter({lines}, lambda l: length(l) < 100)) > 0 AS INTEGER) * 10)")
    words = " + ".join(f"CAST(contains({c}, {q(w)}) AS INTEGER)" for w in config.QUALITY_WORDS)
    kernel = f"(CAST({words} AS DOUBLE) / {len(config.QUALITY_WORDS)} * 25.0)"
    patch = (f"(CAST(contains({c}, '--- a/') AS INTEGER) * 10 + CAST(contains({c}, '+++ b/') AS INTEGER) * 10 "
             f"+ CAST(contains({c}, '@@') AS INTEGER) * 5)")
    empty = f"({c} IS NULL OR {c} = '')"
    return {
        "syntax_score": f"CASE WHEN {empty} THEN 0 ELSE {syntax} END",
        "style_score": f"CASE WHEN {empty} THEN 0 ELSE {style} END",
        "kernel_score": f"CASE WHEN {empty} THEN 0.0 ELSE {kernel} END",
        "patch_score": f"CASE WHEN {empty} THEN 0 ELSE {patch} END",
    }


def sql_quality(c: str) -> str:
    p = sql_quality_parts(c)
    return f"least(100.0, CAST(({p['syntax_score']}) + ({p['style_score']}) + ({p['kernel_score']}) + ({p['patch_score']}) AS DOUBLE))"


def sql_prompt(i: str) -> str:
    base = "[" + ", ".join(q(b) for b in config.BASE_ISSUES) + "]"
    mods = "[" + ", ".join(q(m) for m in config.MODIFIERS) + "]"
    return f"({base}[{i} % {len(config.BASE_ISSUES)} + 1] || {mods}[{i} % {len(config.MODIFIERS)} + 1])"


PROMPTS_SQL = f"(SELECT doc_id AS prompt_id, {sql_prompt('doc_id')} AS prompt FROM documents)"
LOW = "lower(subject)"
DOCS = config.DOCUMENT_KEYWORDS
GEN_SQL = f"""(SELECT prompt_id, prompt, sub AS subsystem, comp AS complexity, {sql_assemble('prompt', 'sub', 'comp')} AS code,
  (0.5 + 0.5 + 4 * 0.3) / 6 AS confidence,
  greatest(0.0, least(1.0, 1.0 + ((0.5 + 0.5 + 4 * 0.3) / 6 - 0.5) * 0.3)) AS accuracy_estimate
  FROM (SELECT prompt_id, prompt, {sql_primary('lower(prompt)')} AS sub, {sql_complexity('lower(prompt)')} AS comp FROM {PROMPTS_SQL}))"""


def _r6(*cols):
    return [F.round(F.col(c), 6).alias(c) for c in cols]


def _gen_features(spark, sf_dir):
    return FE.generator_features(patch_view(spark, sf_dir), keyword_sets=DOCS)


def _prompts(spark, sf_dir):
    return G.prompts_from_ids(table(spark, sf_dir, "documents"), "doc_id")


def _generated(spark, sf_dir):
    return G.generate(G.generation_features(_prompts(spark, sf_dir)))


# ------------------------------------------------------------ features

@query("subject_marks", sql=f"""
SELECT patch_id, CAST(coalesce(contains({LOW}, ':'), false) AS INTEGER) AS has_colon,
       CAST(coalesce(regexp_matches({LOW}, '[\\[\\](){{}}]'), false) AS INTEGER) AS has_brackets,
       CAST(length({LOW}) - length(replace({LOW}, '!', '')) AS INTEGER) AS exclamation_count,
       CAST(length({LOW}) - length(replace({LOW}, '?', '')) AS INTEGER) AS question_count
FROM {PV}
""")
def subject_marks(spark, sf_dir):
    f = _gen_features(spark, sf_dir)
    return f.select("patch_id", F.col("has_colon").cast("int").alias("has_colon"),
                    F.col("has_brackets").cast("int").alias("has_brackets"), "exclamation_count", "question_count")


@query("subsystem_scores", sql=f"""
SELECT patch_id, {', '.join(f'{s} AS {n}_score, CAST({s} > 0 AS INTEGER) AS has_{n}' for s, n in zip(sql_scores(LOW, DOCS), [n for n, _ in DOCS]))}
FROM {PV}
""")
def subsystem_scores(spark, sf_dir):
    f = _gen_features(spark, sf_dir)
    cols = []
    for n, _ in DOCS:
        cols += [F.col(f"{n}_score"), F.col(f"has_{n}").cast("int").alias(f"has_{n}")]
    return f.select("patch_id", *cols)


@query("primary_subsystem", sql=f"SELECT patch_id, {sql_primary(LOW, DOCS)} AS target_subsystem FROM {PV}")
def primary_subsystem(spark, sf_dir):
    return _gen_features(spark, sf_dir).select("patch_id", "target_subsystem")


@query("complexity_label", sql=f"SELECT patch_id, {sql_complexity(LOW)} AS target_complexity FROM {PV}")
def complexity_label(spark, sf_dir):
    return _gen_features(spark, sf_dir).select("patch_id", "target_complexity")


@query("derive_targets", sql=f"""
SELECT patch_id, sub AS target_subsystem, {', '.join(f'{sql_target("sub", t)} AS target_{t}' for t in TARGET_FIELDS)}
FROM (SELECT patch_id, {sql_primary(LOW, DOCS)} AS sub FROM {PV})
""")
def derive_targets(spark, sf_dir):
    return _gen_features(spark, sf_dir).select("patch_id", "target_subsystem", *[f"target_{t}" for t in TARGET_FIELDS])


@query("config_lookup", sql=f"""
SELECT patch_id, sub AS subsystem, {', '.join(f'{sql_config("sub", c)} AS {c}' for c in CONFIG_FIELDS)}
FROM (SELECT patch_id, {sql_primary(LOW, DOCS)} AS sub FROM {PV})
""")
def config_lookup(spark, sf_dir):
    f = _gen_features(spark, sf_dir)
    return f.select("patch_id", F.col("target_subsystem").alias("subsystem"),
                    *[S.template_config("target_subsystem", c).alias(c) for c in CONFIG_FIELDS])


@query("class_distribution", sql=f"SELECT {sql_primary(LOW, DOCS)} AS target_subsystem, count(*) AS n FROM {PV} GROUP BY 1")
def class_distribution(spark, sf_dir):
    return _gen_features(spark, sf_dir).groupBy("target_subsystem").agg(F.count(F.lit(1)).alias("n"))


_TG = ["target_primary_variable", "target_function", "target_condition", "target_action", "target_complexity"]


@query("trainable_groups", sql=f"""
WITH f AS (SELECT sub AS target_subsystem, {', '.join(f'{sql_target("sub", t)} AS target_{t}' for t in TARGET_FIELDS[:4])},
                  {sql_complexity(LOW)} AS target_complexity
           FROM (SELECT subject, {sql_primary(LOW, DOCS)} AS sub FROM {PV})),
g AS (SELECT target_subsystem, count(*) AS n_rows, {', '.join(f'count(DISTINCT {t}) AS nd_{t}' for t in _TG)} FROM f GROUP BY 1)
{' UNION ALL '.join(f"SELECT target_subsystem, n_rows, '{t}' AS target, nd_{t} AS n_distinct, CAST(n_rows >= 50 AND nd_{t} >= 2 AS INTEGER) AS trainable FROM g" for t in _TG)}
""")
def trainable_groups(spark, sf_dir):
    return L.trainable_groups(_gen_features(spark, sf_dir), "target_subsystem", _TG)


@query("label_encode", sql=f"""
SELECT patch_id, sub AS target_subsystem, CAST(dense_rank() OVER (ORDER BY sub) - 1 AS INTEGER) AS label_index, sub AS label_decoded
FROM (SELECT patch_id, {sql_primary(LOW, DOCS)} AS sub FROM {PV})
""")
def label_encode(spark, sf_dir):
    """Sorted distinct labels -> 0..k-1 and back (StringIndexer alphabetAsc / IndexToString)."""
    f = _gen_features(spark, sf_dir).select("patch_id", "target_subsystem")
    model = StringIndexer(inputCol="target_subsystem", outputCol="label_idx", stringOrderType="alphabetAsc").fit(f)
    enc = model.transform(f)
    dec = IndexToString(inputCol="label_idx", outputCol="label_decoded", labels=model.labels).transform(enc)
    return dec.select("patch_id", "target_subsystem", F.col("label_idx").cast("int").alias("label_index"), "label_decoded")


# ----------------------------------------------------------- prompts

@query("test_prompts", sql=f"SELECT prompt_id, prompt FROM {PROMPTS_SQL}")
def test_prompts(spark, sf_dir):
    return _prompts(spark, sf_dir)


@query("generation_features", sql=f"""
SELECT prompt_id, CAST(length(lower(prompt)) AS INTEGER) AS subject_length, {sql_wc('lower(prompt)')} AS word_count,
       CAST(contains(lower(prompt), ':') AS INTEGER) AS has_colon,
       CAST(regexp_matches(lower(prompt), '[\\[\\](){{}}]') AS INTEGER) AS has_brackets,
       0 AS author_is_maintainer, {len('example.com')} AS author_domain_length,
       {', '.join(f'{s} AS {n}_score' for s, n in zip(sql_scores('lower(prompt)'), config.SUBSYSTEMS))},
       {sql_primary('lower(prompt)')} AS target_subsystem, {sql_complexity('lower(prompt)')} AS target_complexity
FROM {PROMPTS_SQL}
""")
def generation_features(spark, sf_dir):
    f = G.generation_features(_prompts(spark, sf_dir))
    return f.select("prompt_id", "subject_length", "word_count", F.col("has_colon").cast("int").alias("has_colon"),
                    F.col("has_brackets").cast("int").alias("has_brackets"),
                    F.col("author_is_maintainer").cast("int").alias("author_is_maintainer"), "author_domain_length",
                    *[f"{n}_score" for n in config.SUBSYSTEMS], "target_subsystem", "target_complexity")


@query("truncate_text", sql=f"SELECT doc_id, {sql_truncate('text')} AS description FROM documents")
def truncate_text(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", X.truncate_text("text").alias("description"))


@query("assemble_code", sql=f"""
SELECT patch_id, sub AS subsystem, comp AS complexity, {sql_assemble('subject', 'sub', 'comp')} AS code
FROM (SELECT patch_id, subject, {sql_primary(LOW, DOCS)} AS sub, {sql_complexity(LOW)} AS comp FROM {PV})
""")
def assemble_code(spark, sf_dir):
    """Templates filled from patch subjects (descriptions truncated to 60 chars)."""
    f = _gen_features(spark, sf_dir)
    g = G.generate(f, text_col="subject")
    return g.select("patch_id", "subsystem", "complexity", "code")


EVENT_TEXT_SQL = "(SELECT e.event_id AS patch_id, d.text AS subject FROM events e LEFT JOIN documents d ON e.event_id = d.doc_id)"


@query("generate_patches", sql=f"""
SELECT patch_id, coalesce({sql_assemble('subject', 'sub', 'comp')}, '/* Error generating code for:  */') AS code,
       CASE WHEN subject IS NULL THEN 0.0 ELSE round((2 * {G.DEFAULT_LEVEL1_CONF} + 4 * {G.DEFAULT_LEVEL2_CONF}) / 6, 6) END::DOUBLE AS confidence,
       CAST(subject IS NULL AS INTEGER) AS failed
FROM (SELECT patch_id, subject, {sql_primary(LOW, DOCS)} AS sub, {sql_complexity(LOW)} AS comp FROM {EVENT_TEXT_SQL})
""")
def generate_patches(spark, sf_dir):
    """Code for the subject of every event; an event without a document fails and gives the error row with confidence 0."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id"), F.col("text").alias("subject"))
    ev = table(spark, sf_dir, "events").select(F.col("event_id").alias("patch_id"))
    subjects = ev.join(docs, F.col("patch_id") == F.col("doc_id"), "left").drop("doc_id")
    g = G.generate(FE.generator_features(subjects, keyword_sets=config.DOCUMENT_KEYWORDS, send_time=None), text_col="subject")
    return g.select("patch_id", "code", F.round("confidence", 6).alias("confidence"), F.col("subject").isNull().cast("int").alias("failed"))


@query("generate_rules", headline=True, sql=f"""
SELECT prompt_id, subsystem, complexity, code, round(confidence, 6) AS confidence,
       round(accuracy_estimate, 6) AS accuracy_estimate FROM {GEN_SQL}
""")
def generate_rules(spark, sf_dir):
    g = _generated(spark, sf_dir)
    return g.select("prompt_id", "subsystem", "complexity", "code", *_r6("confidence", "accuracy_estimate"))


# ----------------------------------------------------------- quality

@query("code_quality", sql=f"""
SELECT 'page' AS kind, page_id AS item_id, round({sql_quality('html')}, 6) AS quality FROM pages
UNION ALL SELECT 'document', doc_id, round({sql_quality('text')}, 6) FROM documents
UNION ALL SELECT 'generated', prompt_id, round({sql_quality('code')}, 6) FROM {GEN_SQL}
""")
def code_quality(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("item_id"),
                                                 F.round(CG.code_quality("html"), 6).alias("quality"))
    docs = table(spark, sf_dir, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("item_id"),
                                                    F.round(CG.code_quality("text"), 6).alias("quality"))
    gen = _generated(spark, sf_dir).select(F.lit("generated").alias("kind"), F.col("prompt_id").alias("item_id"),
                                           F.round(CG.code_quality("code"), 6).alias("quality"))
    return pages.unionByName(docs).unionByName(gen)


_QP = sql_quality_parts("html")


@query("code_quality_parts", sql=f"""
SELECT page_id, {', '.join(f'CAST({v} AS {"DOUBLE" if k == "kernel_score" else "INTEGER"}) AS {k}' for k, v in _QP.items())} FROM pages
""")
def code_quality_parts(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", *CG.quality_parts("html"))


@query("evaluate_batch", headline=True, sql=f"""
SELECT tp, fp, tn, fn, total_samples, {', '.join(f'round({c}, 6) AS {c}' for c in ['accuracy', 'precision', 'recall'])},
       round(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0), 6) AS f1,
       round(mean_quality, 6) AS mean_quality, round(std_quality, 6) AS std_quality,
       round(mean_confidence, 6) AS mean_confidence, round(std_confidence, 6) AS std_confidence,
       CAST(60.0 AS DOUBLE) AS quality_threshold, CAST(0.5 AS DOUBLE) AS confidence_threshold
FROM (SELECT *, coalesce(CAST(tp + tn AS DOUBLE) / nullif(total_samples, 0), 0) AS accuracy,
             coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS precision,
             coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS recall
      FROM (SELECT count(*) FILTER (WHERE quality >= 60 AND confidence >= 0.5) AS tp,
                   count(*) FILTER (WHERE quality < 60 AND confidence >= 0.5) AS fp,
                   count(*) FILTER (WHERE quality < 60 AND confidence < 0.5) AS tn,
                   count(*) FILTER (WHERE quality >= 60 AND confidence < 0.5) AS fn,
                   count(*) AS total_samples, avg(quality) AS mean_quality, stddev_pop(quality) AS std_quality,
                   avg(confidence) AS mean_confidence, stddev_pop(confidence) AS std_confidence
            FROM (SELECT {sql_quality('code')} AS quality, confidence FROM {GEN_SQL})))
""")
def evaluate_batch(spark, sf_dir):
    m = G.evaluate_batch(_generated(spark, sf_dir))
    return m.select("tp", "fp", "tn", "fn", "total_samples",
                    *_r6("accuracy", "precision", "recall", "f1", "mean_quality", "std_quality",
                         "mean_confidence", "std_confidence"), "quality_threshold", "confidence_threshold")


# ------------------------------------------------------- confidences

@query("accuracy_estimate", sql=f"""
WITH s AS {SCORES_SQL},
acc AS (SELECT avg(CAST(actual = CAST(p1 > 0.5 AS INTEGER) AS INTEGER)) AS a1,
               avg(CAST(actual = CAST(p2 > 0.5 AS INTEGER) AS INTEGER)) AS a2,
               avg(CAST(actual = CAST(p3 > 0.5 AS INTEGER) AS INTEGER)) AS a3 FROM s)
SELECT event_id, round((p1 + p2 + p3) / 3, 6) AS estimate_no_metrics,
       round(greatest(0.0, least(1.0, (a1 + a2 + a3) / 3 + ((p1 + p2 + p3) / 3 - 0.5) * 0.3)), 6) AS estimate
FROM s, acc
""")
def accuracy_estimate(spark, sf_dir):
    """Confidence-adjusted accuracy per event from three model scores and their accuracies."""
    s = event_scores(spark, sf_dir)
    accs = s.agg(*[F.avg((F.col("actual") == (F.col(m) > 0.5).cast("int")).cast("int")).alias(m)
                   for m in ("p1", "p2", "p3")]).first()
    conf = F.array("p1", "p2", "p3")
    acc = F.array(*[F.lit(float(accs[m])) for m in ("p1", "p2", "p3")])
    return s.select("event_id", F.round(CG.accuracy_estimate(conf), 6).alias("estimate_no_metrics"),
                    F.round(CG.accuracy_estimate(conf, acc), 6).alias("estimate"))


# ------------------------------------------------------- meta features (M5)

@query("meta_features", sql=f"""
WITH s AS (SELECT sc.event_id, sc.actual, sc.p1, sc.p2, sc.p3, e.value,
                  CAST(json_extract_string(e.props, '$.k') AS DOUBLE) AS k, CAST(hour(e.ts) AS DOUBLE) AS hr
           FROM {SCORES_SQL} sc JOIN events e ON sc.event_id = e.event_id),
m AS (SELECT *, (p1 + p2 + p3) / 3 AS mean FROM s),
v AS (SELECT *, ((p1 - mean) * (p1 - mean) + (p2 - mean) * (p2 - mean) + (p3 - mean) * (p3 - mean)) / 3 AS var FROM m)
SELECT event_id, round(abs(p1 - 0.5) * 2, 6) AS p1_conf, round(abs(p2 - 0.5) * 2, 6) AS p2_conf, round(abs(p3 - 0.5) * 2, 6) AS p3_conf,
       round(mean, 6) AS ens_mean, round(sqrt(var), 6) AS ens_std, round(list_sort([p1, p2, p3])[2], 6) AS ens_median,
       round(greatest(p1, p2, p3) - least(p1, p2, p3), 6) AS ens_range, round(1 - sqrt(var), 6) AS agreement,
       round(var, 6) AS variance,
       round((CAST(value = 0 AS INTEGER) + CAST(k = 0 AS INTEGER) + CAST(hr = 0 AS INTEGER)) / 3.0, 6) AS sparsity,
       round(sqrt(value * value + k * k + hr * hr), 6) AS magnitude,
       round(abs(mean - actual), 6) AS error, round((mean - actual) * (mean - actual), 6) AS sq_error
FROM v
""")
def meta_features(spark, sf_dir):
    """Per event: model confidences, ensemble statistics, feature-row statistics and the error targets."""
    from patchlens.plans.catalog_models import meta_frame

    d, _ = meta_frame(spark, sf_dir)
    cols = ["p1_conf", "p2_conf", "p3_conf", "ens_mean", "ens_std", "ens_median", "ens_range", "agreement", "variance",
            "sparsity", "magnitude", "error", "sq_error"]
    return d.select("event_id", *[F.round(c, 6).alias(c) for c in cols])
