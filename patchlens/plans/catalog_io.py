"""Sources and sinks (A1-A12, G2): JDBC, snapshots, CSV/JSON, model files, audit, ingest.

Files are written under the session's shared ``spark.checkpoint.dir`` (a
cluster-wide folder on a real deployment), in a fresh sub-folder per call.
"""

from __future__ import annotations

import uuid
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from patchlens.operators import boosting as B
from patchlens.operators import matrix as M
from patchlens.operators import models as MD
from patchlens.operators import split as SP
from patchlens.plans.catalog_eval import SPLIT_LONG_SQL, _confusion_long, split_long
from patchlens.plans.registry import query
from patchlens.session import ensure_checkpoint_dir
from patchlens.sources import io as IO
from patchlens.sources.tables import TABLES, table

# --- fixed values: import order of the table files (listed names first) ---
IMPORT_ORDER = ["src0", "src1", "src2", "src3", "src4"]


def scratch(spark, name: str) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/patchlens-io/{name}-{uuid.uuid4().hex[:10]}"


def released(spark, df, *folders: str, db: str | None = None):
    """``df`` computed once into the checkpoint folder, after which what it was read from is deleted."""
    out = df.checkpoint(eager=True)
    for folder in folders:
        p = spark._jvm.org.apache.hadoop.fs.Path(folder)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    if db:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    return out


# ------------------------------------------------------------- value-checked

@query("table_audit", sql="""
SELECT 'region' AS table_name, count(*) AS n_rows, 'ok' AS status FROM region
UNION ALL SELECT 'nation', count(*), 'ok' FROM nation
UNION ALL SELECT 'customer', count(*), 'ok' FROM customer
UNION ALL SELECT 'orders', count(*), 'ok' FROM orders
UNION ALL SELECT 'patch_set', NULL, 'missing'
UNION ALL SELECT 'TOTAL', (SELECT count(*) FROM region) + (SELECT count(*) FROM nation) + (SELECT count(*) FROM customer)
                 + (SELECT count(*) FROM orders), 'ok'
""")
def table_audit(spark, sf_dir):
    names = ["region", "nation", "customer", "orders", "patch_set"]
    return IO.audit_tables(spark, {n: (lambda n=n: table(spark, sf_dir, n)) for n in names})


_L = "lower(text)"


@query("classify_names", sql=f"""
SELECT doc_id, CASE WHEN contains({_L}, 'random') OR contains({_L}, 'forest') OR contains({_L}, 'rf') THEN 'random_forest'
                    WHEN contains({_L}, 'xgb') OR contains({_L}, 'xgboost') THEN 'xgboost'
                    WHEN contains({_L}, 'lgb') OR contains({_L}, 'lightgbm') OR contains({_L}, 'light') THEN 'lightgbm'
                    ELSE 'unknown' END AS model_kind,
       split_part(replace(lower(source), '_kernel_model', ''), '_', 1) AS short_name
FROM documents
""")
def classify_names(spark, sf_dir):
    """Name -> model kind by fragment; first match of forest / boosted / light wins."""
    low = F.lower(F.col("text"))

    def any_of(*ws):
        e = None
        for w in ws:
            e = low.contains(w) if e is None else e | low.contains(w)
        return e

    kind = (F.when(any_of("random", "forest", "rf"), "random_forest").when(any_of("xgb", "xgboost"), "xgboost")
            .when(any_of("lgb", "lightgbm", "light"), "lightgbm").otherwise("unknown"))
    # short model name: strip the '_kernel_model' suffix, keep the part before the first '_'
    short = F.split(F.replace(F.lower(F.col("source")), F.lit("_kernel_model"), F.lit("")), "_", -1)[0]
    return table(spark, sf_dir, "documents").select("doc_id", kind.alias("model_kind"), short.alias("short_name"))


_ORDER_SQL = "[" + ", ".join(f"'{n}'" for n in IMPORT_ORDER) + "]"


@query("name_difference", sql=f"""
WITH s AS (SELECT DISTINCT source AS name FROM documents WHERE source IS NOT NULL)
SELECT CAST(CASE WHEN list_position({_ORDER_SQL}, name) IS NOT NULL THEN list_position({_ORDER_SQL}, name) - 1
            ELSE {len(IMPORT_ORDER)} + row_number() OVER (PARTITION BY list_position({_ORDER_SQL}, name) IS NULL ORDER BY name) - 1
       END AS INTEGER) AS position,
       name, CAST(list_position({_ORDER_SQL}, name) IS NOT NULL AS INTEGER) AS listed
FROM s
""")
def name_difference(spark, sf_dir):
    """Present names in import order: listed ones first (list order), then the rest (ordered set difference)."""
    names = table(spark, sf_dir, "documents").select(F.col("source").alias("name")).filter(F.col("name").isNotNull()).distinct()
    listed = spark.createDataFrame([(i, n) for i, n in enumerate(IMPORT_ORDER)], "pos int, name string")
    rest = names.join(F.broadcast(listed), "name", "left_anti")  # the difference
    first = names.join(F.broadcast(listed), "name", "inner").select(F.col("pos").alias("position"), "name", F.lit(1).alias("listed"))
    # distinct names: a small table (one row per name)
    w = F.row_number().over(Window.orderBy("name"))
    rest = rest.select((F.lit(len(IMPORT_ORDER)) + w - 1).cast("int").alias("position"), "name", F.lit(0).alias("listed"))
    return first.unionByName(rest)


@query("report_lines", sql=f"""
WITH c AS (SELECT model, split, count(*) FILTER (WHERE actual = 1 AND p > 0.5) AS tp, count(*) FILTER (WHERE actual = 0 AND p > 0.5) AS fp,
                  count(*) FILTER (WHERE actual = 1 AND NOT coalesce(p > 0.5, false)) AS fn
           FROM {SPLIT_LONG_SQL} WHERE split IN ('val', 'test') GROUP BY model, split),
m AS (SELECT model, split, coalesce(2 * prec * rec / nullif(prec + rec, 0), 0) AS f1, prec, rec FROM (
        SELECT model, split, coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS prec,
               coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS rec FROM c))
SELECT CAST(0 AS INTEGER) AS line_no, '| model | split | f1 | precision | recall |' AS line
UNION ALL SELECT CAST(1 AS INTEGER), '|---|---|---|---|---|'
UNION ALL SELECT CAST(1 + row_number() OVER (ORDER BY f1 DESC, model, split) AS INTEGER),
  '| ' || model || ' | ' || split || ' | ' || format('{{:.4f}}', f1) || ' | ' || format('{{:.4f}}', prec) || ' | ' || format('{{:.4f}}', rec) || ' |'
FROM m
""")
def report_lines(spark, sf_dir):
    """Markdown table of per-model metrics, best F1 first."""
    lg = split_long(spark, sf_dir).filter(F.col("split").isin("val", "test"))
    m = _confusion_long(lg, ["model", "split"])  # one row per (model, split): small
    body = m.select(
        (F.lit(1) + F.row_number().over(Window.orderBy(F.desc("f1"), "model", "split"))).alias("line_no"),
        F.concat(F.lit("| "), "model", F.lit(" | "), "split", F.lit(" | "), F.format_number("f1", 4), F.lit(" | "),
                 F.format_number("precision", 4), F.lit(" | "), F.format_number("recall", 4), F.lit(" |")).alias("line"))
    # a global aggregate yields exactly one row: the header lines
    one = m.agg(F.count(F.lit(1)).alias("_n"))
    head = one.select(F.lit(0).alias("line_no"), F.lit("| model | split | f1 | precision | recall |").alias("line"))
    sep = one.select(F.lit(1).alias("line_no"), F.lit("|---|---|---|---|---|").alias("line"))
    return head.unionByName(sep).unionByName(body.select(F.col("line_no").cast("int"), "line"))


@query("label_join_bucketed", sql="""
SELECT d.doc_id AS patch_id, d.text AS subject,
       concat('u', e.user_id, '@', ['kernel.org','example.com','redhat.com','gmail.com','intel.com'][e.user_id % 5 + 1]) AS author_email,
       epoch_us(e.ts) // 1000 AS send_time, CASE WHEN l.doc_id IS NOT NULL THEN 1 ELSE 0 END AS accepted
FROM documents d LEFT JOIN events e ON d.doc_id = e.event_id LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE d.text IS NOT NULL
""")
def label_join_bucketed(spark, sf_dir, n_buckets: int | None = None):
    """The label join over a bucketed layout: documents, events and labels written once with the same
    bucket count on their id, so both joins run without shuffling either side."""
    from patchlens.sources.layout import bucketed_patch_tables, buckets_for, build_patch_layout
    from patchlens.sources.tables import patch_view

    n_buckets = n_buckets or buckets_for(table(spark, sf_dir, "documents"))
    db = f"patchlens_layout_{uuid.uuid4().hex[:8]}"
    t = bucketed_patch_tables(spark, build_patch_layout(spark, sf_dir, db, n_buckets))
    pv = patch_view(spark, sf_dir, docs=t["documents"], events=t["events"], labels=t["labels"])
    out = pv.filter(F.col("subject").isNotNull()).select("patch_id", "subject", "author_email", "send_time", "accepted")
    return released(spark, out, db=db)


# ------------------------------------------------------------------ rows-only

@query("scan_jdbc")
def scan_jdbc(spark, sf_dir):
    """labels -> JDBC table -> partitioned JDBC scan with a pushed filter.

    Uses Spark's bundled embedded Derby in memory (no server, no port); it is
    visible only inside this JVM, so on a cluster point ``url`` at a real
    database instead.
    """
    url = f"jdbc:derby:memory:pl{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    lab = table(spark, sf_dir, "labels")
    IO.write_jdbc(lab, url, "LABELS", properties=props)
    b = lab.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).first()
    df = IO.scan_jdbc(spark, url, "LABELS", partition_col="DOC_ID", lower=int(b["lo"]), upper=int(b["hi"]) + 1,
                      num_partitions=4, properties=props)
    return df.filter(F.col("QUALITY").isNotNull())


@query("latest_snapshot")
def latest_snapshot(spark, sf_dir):
    """Two CSV snapshots of orders; the newer one is read back."""
    base = scratch(spark, "snapshots")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("o_year"))
    IO.write_csv(o.filter(F.col("o_year") < 1995), f"{base}/a")
    IO.write_csv(o, f"{base}/b")
    newest = IO.latest_file(spark, [f"{base}/a", f"{base}/b"], "csv", header=True, inferSchema=False)
    return released(spark, newest, base)


@query("csv_roundtrip")
def csv_roundtrip(spark, sf_dir):
    """Export patches, features, X and y as CSV; read X back with its schema, nulls -> 0."""
    from patchlens.plans.catalog_prepare import scheduling_features, scheduling_patches

    base = scratch(spark, "export")
    pat = scheduling_patches(spark, sf_dir).select("patch_id", "author_email", "send_time", "accepted")
    feats = scheduling_features(spark, sf_dir).drop("timestamp")
    x = M.ml_matrix(feats, "patch_id", "accepted")
    paths = IO.export_tables({"patches": pat, "features": feats, "X": x.drop("accepted"), "y": x.select("patch_id", "accepted")}, base)
    return released(spark, IO.read_csv(spark, paths["X"], schema=x.drop("accepted").schema), base)


@query("json_report")
def json_report(spark, sf_dir):
    """Dataset report as JSON lines, written and read back."""
    from patchlens.plans.catalog_prepare import dataset_report

    path = scratch(spark, "report")
    IO.write_text(IO.json_report(dataset_report(spark, sf_dir)), path)
    return released(spark, spark.read.json(path), path)


@query("ingest_dir")
def ingest_dir(spark, sf_dir):
    """Table files -> catalog tables; listed order first, existing tables tolerated."""
    base = scratch(spark, "ingest")
    files = {}
    for name in TABLES:
        table(spark, sf_dir, name).write.parquet(f"{base}/{name}")
        files[name] = f"{base}/{name}"
    db = f"patchlens_ingest_{uuid.uuid4().hex[:8]}"
    first = IO.ingest_dir(spark, files, ["region", "nation"], db)
    again = IO.ingest_dir(spark, files, ["region", "nation"], db)  # second run: all exist
    counts = first.join(again.withColumnRenamed("status", "rerun_status"), ["position", "table_name"])
    return released(spark, counts, base, db=db)


@query("split_index")
def split_index(spark, sf_dir):
    """(id, split) written as parquet and read back."""
    from patchlens.sources.tables import patch_view

    path = scratch(spark, "split_index")
    s = SP.stratified_split(patch_view(spark, sf_dir).select("patch_id", "accepted"), "patch_id", "accepted",
                            Decimal("0.2"), Decimal("0.25"))
    s.select("patch_id", "split").write.partitionBy("split").parquet(path)
    return released(spark, spark.read.parquet(path), path)


@query("model_roundtrip")
def model_roundtrip(spark, sf_dir):
    """Three kinds of fitted models, saved, loaded back and scoring with the loaded copies."""
    from patchlens.plans import catalog_models as CM

    m, cols = CM._matrix(spark, sf_dir)
    train, test = m.filter("split = 'train'"), m.filter("split = 'test'")
    path = scratch(spark, "model")
    texts, parts = CM._text_split(spark, sf_dir)
    texts = texts.select("patch_id", "subject", "label", "split").checkpoint(eager=True)

    def text():
        MD.save_model(MD.fit_text(texts.filter("split = 'train'"), "subject", vocab_size=5000, parts=parts), f"{path}/text")
        return MD.positive_probability(MD.load_model(f"{path}/text").transform(texts.filter("split = 'test'")))

    def forest():
        MD.save_model(MD.numeric_estimator(cols, MD.random_forest()).fit(MD.spread(train)), f"{path}/forest")
        return MD.positive_probability(MD.load_model(f"{path}/forest").transform(test))

    def boosted():
        CM.fit_boosted(train, cols, {"boosted": B.Boost(rounds=10, depth=3)}).save(spark, f"{path}/boosted")
        return B.Boosted.load(spark, f"{path}/boosted").score(test, {"s": "boosted"}).select(
            "patch_id", F.col("s.label").cast("double").alias("prediction"), F.col("s.probability")[1].alias("p"))

    # the text's classifier takes many short jobs, which leave cores to the others
    text, forest, boosted = MD.parallel_fits(lambda f: f(), [text, forest, boosted])
    scored = None
    for name, df in (("forest", forest), ("text", text), ("boosted", boosted)):
        one = df.select("patch_id", F.lit(name).alias("model"), "prediction", "p")
        scored = one if scored is None else scored.unionByName(one)
    return released(spark, scored, path)
