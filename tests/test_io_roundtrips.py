"""Rows-only queries checked exactly: what is written and read back equals the source."""

from pyspark.sql import functions as F

from conftest import SF001

import __spark_entry__ as E
from patchlens.sources.tables import TABLES, table


def test_jdbc_roundtrip(spark):
    got = E.queries()["scan_jdbc"](spark, SF001)
    want = table(spark, SF001, "labels").filter("quality is not null")
    g = got.toDF(*[c.lower() for c in got.columns]).select("doc_id", "quality", "toxic")
    assert g.exceptAll(want).count() == 0 and want.exceptAll(g).count() == 0


def test_latest_snapshot_is_newest(spark):
    got = E.queries()["latest_snapshot"](spark, SF001)
    assert got.count() == table(spark, SF001, "orders").count()  # the full (newer) snapshot, not the filtered one


def test_csv_roundtrip_equals_matrix(spark):
    got = E.queries()["csv_roundtrip"](spark, SF001)
    want = E.queries()["ml_matrix"](spark, SF001).drop("accepted")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_json_report_roundtrip(spark):
    got = E.queries()["json_report"](spark, SF001).first().asDict()
    want = E.queries()["dataset_report"](spark, SF001).first().asDict()
    assert {k: (round(v, 6) if isinstance(v, float) else v) for k, v in got.items()} == want


def test_split_index_roundtrip(spark):
    got = E.queries()["split_index"](spark, SF001).select("patch_id", "split")
    want = E.queries()["stratified_split"](spark, SF001).select("patch_id", "split")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_ingest_dir_order_and_rerun(spark):
    r = E.queries()["ingest_dir"](spark, SF001).orderBy("position").collect()
    assert [x["table_name"] for x in r] == ["region", "nation"] + sorted(set(TABLES) - {"region", "nation"})
    assert all(x["status"] == "imported" and x["rerun_status"] == "exists" for x in r)


def test_tuning_loop_history_consistent(spark):
    h = E.queries()["tuning_loop"](spark, SF001).orderBy("model", "iteration").collect()
    by = {}
    for r in h:
        by.setdefault(r["model"], []).append(r)
    for rows in by.values():
        assert rows[0]["iteration"] == 0 and rows[0]["accepted"] == 0
        for prev, cur in zip(rows, rows[1:]):
            assert cur["prev_f1"] == prev["current_f1"]
            assert cur["current_f1"] >= prev["current_f1"]
            assert cur["accepted"] == int(cur["new_f1"] - prev["current_f1"] > 1e-4)


def test_stream_matches_batch(spark):
    got = E.queries()["stream_page_quality"](spark, SF001)
    want = E.queries()["code_quality"](spark, SF001).filter("kind = 'page'").select(
        F.col("item_id").alias("page_id"), "quality")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_newest_snapshot_is_read_whole(spark):
    import os

    from patchlens.plans.catalog_io import scratch
    from patchlens.sources import io as IO

    base = scratch(spark, "snap-test")
    for name, n, age in (("new", 100, 10), ("old", 40, 1000)):
        IO.write_csv(spark.range(n).repartition(4), f"{base}/{name}")
        for f in os.listdir(f"{base}/{name}"):
            t = os.stat(f"{base}/{name}/{f}").st_mtime - age
            os.utime(f"{base}/{name}/{f}", (t, t))
    got = IO.latest_file(spark, [f"{base}/new", f"{base}/old"], "csv", header=True)
    assert got.count() == 100 and got.distinct().count() == 100
