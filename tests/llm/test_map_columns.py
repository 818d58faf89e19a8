"""Extra columns that hold maps: they are passed on, and rows are told apart by them."""

from pyspark.sql import functions as F

from patchlens.llm import mixing, simhash


def docs(spark):
    rows = [(1, "one two three four five", "a", {"k": 1}), (1, "one two three four five", "a", {"k": 2}), (2, "other words in this one here", "b", None),
            (3, "one two three four five", "b", {}), (None, "", "a", {"x": 3})]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, tags map<string,int>")
    return df.withColumn("nested", F.struct("tags"))


def test_near_duplicates(spark):
    kept = simhash.keep_one(docs(spark)).collect()
    assert sorted((r["doc_id"] or 0) for r in kept) == [0, 1, 2] and all(r["nested"]["tags"] == r["tags"] for r in kept)


def test_mixing(spark):
    out = mixing.mix(docs(spark)).collect()
    assert out and all(r["nested"]["tags"] == r["tags"] for r in out)
    assert {r["doc_id"] for r in out} <= {1, 2, 3}
