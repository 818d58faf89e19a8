import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from patchlens.llm import simhash as S
from patchlens.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute_fp(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in low).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i: i + 4]) for i in range(max(1, len(words) - 3))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, ids, radius=4):
    n = len(fps)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                root[find(i)] = find(j)
    low = {}
    for i in range(n):
        if ids[i] is not None:
            low[find(i)] = min(low.get(find(i), ids[i]), ids[i])
    return [low.get(find(i)) for i in range(n)]


def corpus(seed=0, n=150):
    rnd = random.Random(seed)
    vocab = ["Über", "abc", "Der", "x y", "ÉTÉ", "zeta", "tau", "one", "two", "ß", "a b"]
    rows = []
    for i in range(n):
        kind = rnd.random()
        if kind < 0.45 and rows:
            words = (rnd.choice(rows)[1] or "").split(" ")
            for _ in range(rnd.randrange(3)):
                words[rnd.randrange(len(words))] = rnd.choice(vocab)
            text = " ".join(words)
        elif kind < 0.5:
            text = rnd.choice([None, "", " \n\t", "one", "one two three"])
        else:
            text = rnd.choice([" ", "\n", "\t\r"]).join(rnd.choice(vocab) for _ in range(rnd.choice([3, 4, 30, 120])))
        rows.append((i, text, "en", "s", 0))
    return rows + [(None, "zeta tau", "en", "s", 0), (900, "again", "en", "s", 0), (900, "again", "en", "s", 0)]


def test_fingerprint_matches_definition():
    for _, text, *_ in corpus(5, 80):
        assert S.fingerprint(text) == brute_fp(text)


def test_chunks_of_a_long_text_add_up(monkeypatch):
    text = " ".join(str(i % 977) for i in range(5000))
    whole = S.fingerprint(text)
    monkeypatch.setattr(S, "_CHUNK", 64)
    assert S.fingerprint(text) == whole == brute_fp(text)


def test_components_match_brute_force(spark):
    rows = corpus(1)
    out = S.near_duplicates(spark.createDataFrame(rows, SCHEMA).withColumn("fp", F.lit("x")).withColumn("rep", F.lit(1))).collect()
    fps = [brute_fp(r[1]) for r in rows]
    want = sorted(map(str, zip([r[0] for r in rows], [f"{x:016x}" for x in fps], brute_components(fps, [r[0] for r in rows]))))
    assert sorted(str((r["doc_id"], r["fingerprint"], r["component_id"])) for r in out) == want


def test_tiles_lose_no_link(spark):
    rnd = random.Random(3)
    base = [rnd.getrandbits(64) for _ in range(120)]
    fps = set(base)
    for x in base[:60]:
        for _ in range(6):
            for b in rnd.sample(range(64), rnd.randrange(1, 6)):
                x ^= 1 << b
            fps.add(x)
    hub = 0xF0F0F0F0F0F0F0F0
    fps |= {hub ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(i)}
    fps = sorted(fps)
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    want = brute_components(fps[:], list(range(len(fps)))) if len(fps) < 3000 else None
    for tile_rows in (50, 16384):
        edges = S.tile_links(df, 4, tile_rows)
        got = {r["node"] % 2**64: r["root"] % 2**64 for r in components(edges).collect()}
        assert edges.count() < 45 * len(fps)
        mine = [got.get(x, x) for x in fps]
        classes_got = {tuple(i for i, r in enumerate(mine) if r == root) for root in set(mine)}
        classes_want = {tuple(i for i, r in enumerate(want) if r == root) for root in set(want)}
        assert classes_got == classes_want


def test_pair_kernel_against_all_pairs():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 2**20, 300, dtype=np.uint64))
    b = np.unique(rng.integers(0, 2**20, 250, dtype=np.uint64))
    got = {(int(a[i]), int(b[j])) for x, y in S._links(a, b, 4) for i, j in zip(x, y)}
    assert got == {(int(x), int(y)) for x in a for y in b if int(x ^ y).bit_count() <= 4}


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (700, 701), (701, 700)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)} | {700: 700, 701: 700}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_keep_one(spark):
    rows = corpus(2)
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("_key", F.lit(7)).withColumn("n", F.lit(None).cast("int"))
    out = S.keep_one(docs)
    assert out.columns == docs.columns
    kept = [r["doc_id"] for r in out.collect()]
    comps = brute_components([brute_fp(r[1]) for r in rows], [r[0] for r in rows])
    assert sorted(kept, key=str) == sorted(set(comps), key=str)
    # ids that repeat in different components stay, once for each
    twice = spark.createDataFrame([(1, "a b c d e", "en", "s", 0), (1, "v w x y z", "en", "s", 0), (1, "v w x y z", "fr", "s", 0)], SCHEMA)
    assert sorted(r["text"] for r in S.keep_one(twice).collect()) == ["a b c d e", "v w x y z"]


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert S.near_duplicates(none).collect() == [] and S.keep_one(none).collect() == []
