import pytest
from pyspark.sql import functions as F

from patchlens.llm import rollup as R
from patchlens.llm.common import shared_folder

SCHEMA = "op string, doc_id long, source string, lang string, text string"


def brute(state):
    enc = R.encoder(R.load_ranks())
    out = {}
    for source, lang, text in state:
        text = text or ""
        for tok, n in ((R.WORDS, len(text.encode().split())), (R.BPE, len(enc.encode_ordinary(text)))):
            t = out.setdefault((source, lang, tok), [0, 0, 0])
            t[0] += 1
            t[1] += n
            t[2] += len(text)
    return {k: tuple(v) for k, v in out.items()}


def totals(table):
    rows = table.totals().collect()
    assert len(rows) == len({(r["source"], r["lang"], r["tokenizer"]) for r in rows})
    return {(r["source"], r["lang"], r["tokenizer"]): (r["n_docs"], r["n_tokens"], r["n_chars"]) for r in rows}


def test_inserts_deletes_and_revisions(spark):
    t = R.Rollup(spark, shared_folder(spark, "rollup-test"))
    assert totals(t) == {} and t.commits() == {}
    first = [("insert", 1, "a", "en", "one two three"), ("insert", 2, "a", None, "eins\n zwei"), ("insert", 3, None, "fr", None),
             ("insert", 4, "b", "en", ""), ("insert", 4, "b", "en", ""), ("insert", None, "b", "en", "no id"), (None, 9, "b", "en", "no op")]
    df = spark.createDataFrame(first, SCHEMA).withColumn("n_tokens", F.lit("clash")).withColumn("tokenizer", F.lit(1))
    assert t.commit("day 1/ä", df) is True
    state = [r[2:] for r in first[:-1]]
    assert totals(t) == brute(state)
    # the same batch again, even with other rows, changes nothing
    assert t.commit("day 1/ä", df) is False
    assert t.commit("day 1/ä", spark.createDataFrame(first[:1], SCHEMA)) is False
    assert totals(t) == brute(state)
    second = [("revise", 1, "c", "en", "one two three four"), ("delete", 4, None, None, None), ("delete", 77, None, None, None),
              ("delete", None, None, None, None), ("revise", 50, "a", "en", "new by revision")]
    assert t.commit("day 2", spark.createDataFrame(second, SCHEMA))
    state = [first[1][2:], first[2][2:], first[5][2:], second[0][2:], second[4][2:]]
    assert totals(t) == brute(state)
    assert t.commit("day 3", spark.createDataFrame([("delete", 1, None, None, None), ("delete", 1, None, None, None)], SCHEMA))
    assert t.commit("day 4", spark.createDataFrame([], SCHEMA))
    state.remove(second[0][2:])
    assert totals(t) == brute(state)
    assert set(t.commits()) == {"day 1/ä", "day 2", "day 3", "day 4"}
    t.drop()


def test_attempt_that_dies_counts_for_nothing(spark, monkeypatch):
    t = R.Rollup(spark, shared_folder(spark, "rollup-test"))
    batch = spark.createDataFrame([("insert", 1, "a", "en", "x y")], SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(R.Rollup, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            t.commit("b", batch)
    assert totals(t) == {}
    assert t.commit("b", batch) and totals(t) == brute([("a", "en", "x y")])


def test_second_publisher_loses(spark):
    t = R.Rollup(spark, shared_folder(spark, "rollup-test"))
    t.commit("b", spark.createDataFrame([("insert", 1, "a", "en", "x y")], SCHEMA))
    assert t._publish(t._fs(), R.base64.urlsafe_b64encode(b"b").decode(), {"batch": "b", "attempt": "other"}) is False
    assert list(t.commits()) == ["b"] and "other" not in t.commits().values()


def test_long_texts_count_whole(monkeypatch):
    enc = R.encoder(R.load_ranks())
    text = "\n".join(f"line {i} of words,\n\n  and more é{i}" for i in range(400))
    whole = len(enc.encode_ordinary(text))
    for size in (5, 40, 1000):
        monkeypatch.setattr(R, "_CHUNK", size)
        assert R.count_tokens(enc, text) == whole
    assert R.count_tokens(enc, None) == 0
