import random
import re

from pyspark.sql import functions as F

from patchlens.llm import licenses as L

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return [w for w in re.split(r"[^\w]|_", (text or "").lower()) if w]


def grams(text):
    w = words(text)
    return [" ".join(w[i: i + 5]) for i in range(len(w) - 4)]


def brute(docs, templates):
    out = set()
    for d, text, *_ in docs:
        g = grams(text)
        for t, body in templates:
            want = set(grams(body))
            hit = [i for i, s in enumerate(g) if s in want]
            if want and len(want & set(g)) / len(want) >= 0.8:
                out.add((d, t, len(want & set(g)), len(want & set(g)) / len(want), hit[0]))
    return out


def corpus(seed, n=400):
    rnd = random.Random(seed)
    vocab = ["alpha", "the", "License", "under", "Größe", "x1", "version", "of", "MIT", "delta"]
    docs = []
    for i in range(n):
        w = [rnd.choice(vocab) for _ in range(rnd.choice([0, 2, 5, 6, 7, 30, 200]))]
        if rnd.random() < 0.7:
            notice = rnd.choice(L.NOTICES)[1].split()
            if rnd.random() < 0.4:
                notice[rnd.randrange(len(notice))] = "changed"
            at = rnd.randrange(len(w) + 1)
            w[at:at] = [rnd.choice([x, x.upper()]) for x in notice]
        docs.append((i, rnd.choice([" ", "\n", " -- "]).join(w), "en", "s", 0))
    return docs + [(None, L.NOTICES[0][1], None, None, None), (7000, None, "en", "s", 0), (7001, "", "en", "s", 0), docs[3], docs[3]]


def found(df):
    rows = [(r["doc_id"], r["template_id"], r["matched"], r["containment"], r["first_word"]) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_matches_brute_force(spark):
    for seed in (1, 2):
        docs = corpus(seed)
        df = spark.createDataFrame(docs, DOCS).withColumn("template_id", F.lit(1)).withColumn("_row", F.lit("x")).withColumn("band", F.lit(0))
        assert found(L.scan(df, L.notices(spark))) == brute(docs, L.NOTICES)


def test_parts_of_the_band_table_change_nothing(spark, monkeypatch):
    docs = corpus(3, 150)
    df = spark.createDataFrame(docs, DOCS)
    monkeypatch.setattr(L, "PART_SHINGLES", 10)
    odd = L.NOTICES + [("dup", L.NOTICES[2][1]), ("short", "only four words here"), ("none", None)]
    templates = spark.createDataFrame(odd + odd[:2], "template_id string, text string")
    assert found(L.scan(df, templates)) == brute(docs, odd)


def test_every_shingle_is_in_one_window(spark):
    for n in range(4, 40):
        df = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(n)))], "doc_id long, text string")
        lone = L.windows(df, ["doc_id"], "text").select(F.explode(F.array(*[L._hash_at(F.col("w"), F.lit(i)) for i in range(L.STEP)])).alias("s"))
        assert sorted(r["s"] for r in lone.filter("s is not null").collect()) == sorted(df.select(F.explode(L.shingles(F.col("text")))).toPandas()["col"])


def test_collision_probability_is_high():
    assert 1 - (1 - 1 / L.STEP) ** L.BANDS > 0.9999


def test_empty_tables_and_native_plan(spark):
    docs = spark.createDataFrame(corpus(1, 5), DOCS)
    none = spark.createDataFrame([], "template_id string, text string")
    assert L.scan(docs, none).collect() == [] and L.scan(docs.limit(0), L.notices(spark)).collect() == []
    plan = L.scan(docs, L.notices(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def brute_any_length(docs, templates):
    out = set()
    for d, text in docs:
        for t, body in templates:
            k = min(5, len(words(body)))
            cut = lambda w: [tuple(w[i: i + k]) for i in range(len(w) - k + 1)]
            g, want = cut(words(text)), set(cut(words(body))) if k else set()
            if want and len(want & set(g)) / len(want) >= 0.8:
                out.add((d, t, len(want & set(g)), len(want & set(g)) / len(want), next(i for i, s in enumerate(g) if s in want)))
    return out


def test_templates_shorter_than_a_shingle(spark, monkeypatch):
    rnd = random.Random(5)
    templates = L.NOTICES + L.SHORT_NOTICES + [("one", "Copyleft"), ("two", "MIT License"), ("four", "no rights at all"), ("none", "?!")]
    docs = []
    for i in range(300):
        w = [rnd.choice(["all", "rights", "reserved", "x", "MIT", "license", "no", "at"]) for _ in range(rnd.choice([0, 1, 2, 3, 4, 9, 60]))]
        at = rnd.randrange(len(w) + 1)
        w[at:at] = rnd.choice(templates)[1].split() if rnd.random() < 0.6 else []
        docs.append((i, " ".join(w)))
    docs += [(900, "ALL  RIGHTS\nreserved"), (901, "all rights"), (902, "// SPDX-License-Identifier: MIT"), (903, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute_any_length(docs, templates)
    assert {t for _, t, *_ in want} > {"All-rights-reserved", "SPDX-tag", "one", "two", "four"}
    for part in (L.PART_SHINGLES, 10):
        monkeypatch.setattr(L, "PART_SHINGLES", part)
        assert found(L.scan(df, spark.createDataFrame(templates, "template_id string, text string"))) == want


def test_query_finds_short_notices_of_the_documents(spark):
    import __spark_entry__ as E

    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = found(E.queries()["op8_license_scan"](spark, "/root/testdata/sf0.001"))
    assert sum(t == "All-rights-reserved" for _, t, *_ in got) == 3
    assert got == brute_any_length(docs, L.NOTICES + L.SHORT_NOTICES)
