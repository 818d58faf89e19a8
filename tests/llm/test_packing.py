"""Packing against a plain encode, concatenate and cut."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as E
from patchlens.llm import packing as P
from patchlens.llm.common import shared_folder

SF = "/root/testdata/sf0.001"


def plain(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.tokenizer_path())
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def digest(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check(rows, docs, length):
    """Pieces against whole documents: coverage, digests, gapless sequences, one short sequence at most."""
    want = sorted((d is None, d or 0, len(i) + 1, digest(i + [P.END_ID])) for (d, _), i in zip(docs, plain([t for _, t in docs])))
    by_seq = {}
    for r in rows:
        by_seq.setdefault(r["sequence_id"], []).append(r)
    for s in by_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= length
    sizes = [sum(r["length"] for r in by_seq[s]) for s in sorted(by_seq)]
    assert sorted(by_seq) == list(range(len(by_seq))) and all(n == length for n in sizes[:-1])
    # pieces of one document follow one another in the concatenation
    got, held = [], []
    for r in sorted(rows, key=lambda r: r["sequence_id"] * length + r["offset"]):
        held.append(r)
        assert r["start"] == sum(x["length"] for x in held[:-1]) and r["doc_id"] == held[0]["doc_id"]
        whole = len(held) == 1 and r["length"] == r["doc_tokens"]
        assert r["boundary"] == (not whole)
        if r["start"] + r["length"] == r["doc_tokens"]:
            ids = b"".join(x["ids"] for x in held)
            got.append((r["doc_id"] is None, r["doc_id"] or 0, r["doc_tokens"], zlib.crc32(ids)))
            held = []
    assert not held and sorted(got) == want


def run(spark, docs, length, parts=3):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    df = df.withColumn("ids", F.lit("clash")).withColumn("at", F.lit(1)).withColumn("part", F.lit(None)).withColumn("_text", F.lit(2))
    return P.pack(df, shared_folder(spark, "packing-test"), length).collect()


def test_units_give_the_ids_of_the_whole_text():
    enc = P.UnitEncoder(P.tokenizer_path(), units=300)
    rnd = random.Random(1)
    marks = ["a", "Be", chr(0xE9), " ", "  ", "\n", " \n", "\t", "'s", "'", chr(0x2019), "12", chr(0x3A9), " word", ",", "<|endoftext|>", "<|",
             chr(0x1C), chr(0x3000), chr(0x85), chr(0x65E5), chr(0x301), ".", chr(0x1F600), chr(0), " Stra" + chr(0xDF) + "e"]
    texts = ["".join(rnd.choices(marks, k=rnd.randint(0, 16))) for _ in range(6000)]
    for i in range(0, len(texts), 500):
        ids, sizes = enc.encode(texts[i: i + 500])
        got = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
        assert got == plain(texts[i: i + 500])


def test_pieces_on_mixed_documents(spark):
    rnd = random.Random(2)
    docs = [(i, " ".join(rnd.choices(["one", "two,", "three\n", "4"], k=rnd.randint(0, 60)))) for i in range(60)]
    docs += [(None, "no id"), (None, "no id"), (7, None), (8, ""), (9, "same"), (9, "same"), (500, "very long text " * 3000), (501, "x" * 20000)]
    for length, parts in ((16, 1), (64, 3), (2048, 5)):
        check(run(spark, docs, length, parts), docs, length)


def test_a_text_longer_than_a_group(spark):
    docs = [(1, "short"), (2, "ab cd, " * (P.CHARS // 6)), (3, "end")]
    check(run(spark, docs, 2048, 1), docs, 2048)


def test_empty_table(spark):
    assert run(spark, [], 2048) == []


def test_exact_fill(spark):
    docs = [(i, "") for i in range(32)]  # one end id each
    rows = run(spark, docs, 16)
    assert sorted({r["sequence_id"] for r in rows}) == [0, 1]
    check(rows, docs, 16)


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = E.queries()["op11_packing"](spark, SF).collect()
    ids = {d: i + [P.END_ID] for (d, _), i in zip(docs, plain([t for _, t in docs]))}
    seen = {}
    for r in rows:
        piece = ids[r["doc_id"]][r["start"]: r["start"] + r["length"]]
        assert digest(piece) == r["ids_crc32"] and len(piece) == r["length"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        seen.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
    for d, i in ids.items():
        at = 0
        for s, n in sorted(seen[d]):
            assert s == at
            at += n
        assert at == len(i)
    total = sum(map(len, ids.values()))
    assert len({r["sequence_id"] for r in rows}) == -(-total // P.SEQUENCE)
