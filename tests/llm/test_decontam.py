import random

import pytest
from pyspark.sql import functions as F

from patchlens.llm import decontam as D


def distance_inside(pattern, text):
    """Least word edits between ``pattern`` and any run of ``text`` (plain dynamic programme)."""
    prev = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        cur = [i] + [0] * len(text)
        for j, t in enumerate(text, 1):
            cur[j] = min(prev[j - 1] + (p != t), prev[j] + 1, cur[j - 1] + 1)
        prev = cur
    return min(prev)


def brute(docs, items):
    out = set()
    for d, text in docs:
        words = D.item_words(text)
        for i, item in {(i, t) for i, t in items if t is not None}:
            pat = D.item_words(item)
            if pat and words:
                dist = distance_inside(pat, words)
                if dist <= D.budget(len(pat)):
                    out.add((d, i, dist))
    return out


def data(seed):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([1, 4, 5, 9, 15, 40, 90])))) for i in range(12)]
    items += [(90, None), (91, ""), (92, "?!"), (None, "Ünique Item, of words here")]
    docs = []
    for d in range(60):
        words = [rnd.choice(vocab) for _ in range(rnd.choice([0, 3, 50, 300]))]
        if rnd.random() < 0.7:
            piece = D.item_words(rnd.choice(items[:12])[1])
            for _ in range(rnd.randrange(int(len(piece) * 0.3) + 1)):
                k = rnd.randrange(len(piece))
                op = rnd.random()
                if op < 0.34:
                    piece[k] = "edit"
                elif op < 0.67 and len(piece) > 1:
                    del piece[k]
                else:
                    piece.insert(k, "more")
            at = rnd.randrange(len(words) + 1)
            words[at:at] = piece
        docs.append((d, " ".join(words)))
    return docs + [(None, items[9][1].upper() + "!"), (70, None), (71, ""), (72, "ünique  ITEM of\nwords here"), (3, docs[3][1])], items


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_brute_force(spark, seed):
    docs, items = data(seed)
    bench = spark.createDataFrame(items + items[:2], "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("x")).withColumn("_text", F.lit(1))
    out = D.find_leaks(df, bench).collect()
    assert {(r["doc_id"], r["item_id"], r["edits"]) for r in out} == brute(docs, items)
    texts = dict(docs)
    for r in out:
        if r["doc_id"] not in (3, None):
            item = D.item_words(dict(items)[r["item_id"]])
            assert distance_inside(item, D.item_words(texts[r["doc_id"]])[r["first_word"]: r["end_word"]]) == r["edits"]
    left = D.drop_leaks(df, bench)
    assert left.columns == df.columns
    leaked = {(r["doc_id"]) for r in out}
    assert sorted(map(str, [r["doc_id"] for r in left.collect()])) == sorted(str(d) for d, _ in docs if d not in leaked)


def test_item_blocks_change_nothing(spark, monkeypatch):
    docs, items = data(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    whole = sorted(map(str, D.find_leaks(df, bench).collect()))
    monkeypatch.setattr(D, "item_blocks", lambda b, real=D.item_blocks: real(b, block_words=20))
    assert sum(1 for _ in D.item_blocks(bench)) > 3
    assert sorted(map(str, D.find_leaks(df, bench).collect())) == whole
    leaked = {d for d, _, _ in brute(docs, items)}
    assert D.drop_leaks(df, bench).count() == sum(d not in leaked for d, _ in docs)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.find_leaks(docs, none).collect() == [] and D.drop_leaks(docs, none).count() == 1
    items = spark.createDataFrame([(1, "a b c d e")], "item_id long, text string")
    assert D.find_leaks(docs.limit(0), items).collect() == [] and D.drop_leaks(docs.limit(0), items).collect() == []


def test_myers_against_dynamic_programme():
    rnd = random.Random(9)
    for _ in range(300):
        p = [rnd.randrange(4) for _ in range(rnd.randrange(1, 80))]
        t = [rnd.randrange(4) for _ in range(rnd.randrange(0, 120))]
        want = distance_inside(p, t)
        got = D.myers(p, t, 40)
        # a match has at least one word to end at
        assert (got[0] if got else None) == (want if t and want <= 40 else None)
