"""The pipeline's stages against brute-force versions, and the registered queries against their SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
import test_decontam
import test_mixing
import test_simhash
import __spark_entry__ as E
from patchlens.llm import toxicity

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings", "pages", "benchmark", "labels"]


def rows_of(df):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: str(r["doc_id"]))


def test_stage_list():
    assert [n for n, _ in P.STAGES] == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "mixing", "sharding"]
    assert P.ORACLE_SQL is None


def test_each_stage_works_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    stages = dict(P.STAGES)

    kept = stages["toxicity"](spark, docs, SF).checkpoint()
    assert kept.columns == docs.columns
    rejected = {r["doc_id"] for r in toxicity.score_documents(docs, labels).filter("rejected").collect()}
    assert rows_of(kept) == [r for r in rows_of(docs) if r["doc_id"] not in rejected]
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    assert sum(truth.get(r["doc_id"], 0) for r in rows_of(kept)) <= 1  # what is left of the labelled toxic ones

    one = stages["simhash_near_dedup"](spark, kept, SF).checkpoint()
    before = rows_of(kept)
    comps = test_simhash.brute_components([test_simhash.brute_fp(r["text"]) for r in before], [r["doc_id"] for r in before])
    assert rows_of(one) == [r for r, c in zip(before, comps) if r["doc_id"] == c]

    clean = stages["benchmark_decontamination"](spark, one, SF).checkpoint()
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {d for d, _, _ in test_decontam.brute([(r["doc_id"], r["text"]) for r in rows_of(one)], items)}
    assert rows_of(clean) == [r for r in rows_of(one) if r["doc_id"] not in leaked]

    mixed = stages["mixing"](spark, clean, SF).checkpoint()
    assert mixed.columns == docs.columns
    sizes, taken = {}, {}
    for r in rows_of(clean):
        sizes[r["source"]] = sizes.get(r["source"], 0) + test_mixing.size_of(r["text"])
    for r in rows_of(mixed):
        taken[r["source"]] = taken.get(r["source"], 0) + test_mixing.size_of(r["text"])
    longest = max(test_mixing.size_of(r["text"]) for r in rows_of(clean))
    for source, target in test_mixing.reference_targets(sizes).items():
        assert target - 1 <= taken.get(source, 0) < target + longest  # the last document drawn stays whole
    by_id = {r["doc_id"]: r for r in rows_of(clean)}
    assert all(r == by_id[r["doc_id"]] for r in rows_of(mixed))

    dealt = stages["sharding"](spark, mixed, SF).collect()
    assert sorted(r["doc_id"] for r in dealt) == sorted(r["doc_id"] for r in rows_of(mixed))
    counts = [sum(r["shard"] == s for r in dealt) for s in range(8)]
    assert max(counts) - min(counts) <= 1

    whole = P.run(spark, SF).collect()
    key = lambda r: (r["doc_id"], r["shard"], r["slot"])
    assert sorted(map(key, whole)) == sorted(map(key, dealt))


def test_stages_on_an_empty_table(spark):
    none = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, none, SF).collect() == []


def test_all_operators_and_the_pipeline_are_registered():
    names = set(E.queries())
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1, n
    assert not any("patchlens.llm" in open(f).read() for f in outside())


def outside():
    import pathlib

    root = pathlib.Path(P.__file__).parent / "patchlens"
    return [f for f in root.rglob("*.py") if "llm" not in f.parts]


def canon(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(float(r[i])) if isinstance(r[i], (int, float)) else repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(n for n in E.oracle_sql() if n.startswith("op")))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    res = con.execute(E.oracle_sql()[name])
    names = [d[0] for d in res.description]
    df = E.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert canon([tuple(r) for r in df.collect()], df.columns) == canon(res.fetchall(), names)


def test_token_counts_query(spark):
    from test_rollup import brute

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = E.queries()["op4_token_counts"](spark, SF).collect()
    got = {(r["source"], r["lang"], r["tokenizer"]): (r["n_docs"], r["n_tokens"], r["n_chars"]) for r in rows}
    assert len(got) == len(rows) and got == brute([(r["source"], r["lang"], r["text"]) for r in docs.collect()])


def test_decontamination_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {(r["doc_id"], r["item_id"], r["edits"]) for r in E.queries()["op10_decontamination"](spark, SF).collect()}
    assert got and got == test_decontam.brute(docs, items)


def test_near_duplicate_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    fps = [test_simhash.brute_fp(r["text"]) for r in docs]
    comps = test_simhash.brute_components(fps, [r["doc_id"] for r in docs])
    got = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in E.queries()["op5_simhash"](spark, SF).collect()}
    assert got == {(r["doc_id"], f"{x:016x}", c) for r, x, c in zip(docs, fps, comps)}


def test_sharding_query(spark):
    import test_ring

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    out = E.queries()["op7_sharding"](spark, SF)
    key = lambda rows: sorted((r["doc_id"], r["shard"], r["slot"], r["text_crc32"]) for r in rows)
    assert key(out.collect()) == key(test_ring.check(spark, [tuple(r) for r in docs.collect()]))


def test_scores_query_covers_all_documents(spark):
    out = E.queries()["op3_toxicity"](spark, SF)
    assert out.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert out.filter(~F.col("score").between(0, 1)).count() == 0
