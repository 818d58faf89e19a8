"""Mixing sources to target weights, by DataFrame functions alone.

1. Sizes: every row's word count; totals per source.
2. Targets: weights share the budget; a target stops at ``max_repeat`` times
   its source and the excess is shared again by weight.  Sorted by cap / weight,
   the sources that stop form a prefix, so prefix sums solve it in one pass.
3. A source is a line of words: its rows in seeded hash order, one pass after
   another.  The mix takes the line's first T words, cut into blocks of
   ``block_words``; T is the target rounded.  So a row is drawn at most
   ``max_repeat`` times and the last row drawn of a source may count in part.
4. Splitting tree: the root holds every source's block quota.  A node over the
   shards [lo, hi) deals its quotas to its two halves by a multivariate
   hypergeometric draw (a chain of exact hypergeometric draws, source by
   source), down to one quota per (shard, source).
5. A source's blocks are permuted, and each shard draws the next run of its
   quota from that order, so the draws are disjoint and use every block once.
6. Rows of a shard are ordered by a seeded hash (a sort inside partitions).

Only per-source and per-shard tables leave the row level.  Rows meet in windows
of about BUCKET_ROWS, so one source may hold most rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patchlens.llm.common import bounded_broadcast, free_name, preceding_sum, row_hash, settle, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEAT = 2
N_SHARDS = 64
BLOCK_WORDS = 1024
BUCKET_ROWS = 500
#: A prime above any block count; modulo n it is coprime to n, so i -> (prime * i + c) mod n permutes 0..n-1.
PRIME = 2305843009213693951


def source_key(source: Column) -> Column:
    """A key without nulls: null sources form a class of their own, after all others."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit("null"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Per source: source_size, weight, target, and ``take``, the target rounded to whole words.

    ``sizes`` has (_src, source, size).  Weights repeat over the sources in code
    point order, null last.  share is in tenths or coarser.
    """
    per = sizes.groupBy("_src").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"),
                                    F.count(F.lit(1)).alias("n_rows"))
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))  # one row per source
    per = per.withColumn("_i", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("_i") % len(weights) + 1).cast("int")).cast("bigint")
    per = per.withColumn("weight", weight).withColumn("_cap", F.col("source_size") * max_repeat)
    everyone = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("_cap") / F.col("weight"), "_i")
    tenths = round(share * 10)
    # _left10: ten times what the sources from this one on share if all before it stop at their caps
    per = (per.withColumn("_total", F.sum("source_size").over(everyone))
           .withColumn("_w_left", F.sum("weight").over(everyone) - F.sum("weight").over(by_ratio) + F.col("weight"))
           .withColumn("_left10", F.col("_total") * tenths - (F.sum("_cap").over(by_ratio) - F.col("_cap")) * 10))
    stops = F.col("_cap") * 10 * F.col("_w_left") <= F.col("_left10") * F.col("weight")
    per = per.withColumn("_stops", stops)
    # the open sources share by weight what the first open one has before it
    first_open = F.min(F.when(~F.col("_stops"), F.struct(F.col("_cap") / F.col("weight"), F.col("_i"), F.col("_left10"), F.col("_w_left")))).over(everyone)
    per = per.withColumn("_open", first_open)
    left10, w_left = F.col("_open._left10"), F.col("_open._w_left")
    open_target = F.col("weight") * left10.cast("double") / (w_left.cast("double") * 10)
    open_take = F.expr("div(weight * _open._left10 * 2 + _open._w_left * 10, _open._w_left * 20)")
    return per.select("_src", "source", "_i", "n_rows", "source_size", "weight",
                      F.when(F.col("_stops"), F.col("_cap").cast("double")).otherwise(open_target).alias("target"),
                      F.when(F.col("_stops"), F.col("_cap")).otherwise(open_take).cast("bigint").alias("take"))


def hypergeometric(population: Column, successes: Column, draws: Column, u: Column) -> Column:
    """A hypergeometric draw from the uniform ``u``, by inversion outward from the mode.

    Weights relative to the mode follow from the ratio of neighbouring
    probabilities; one fold sums them, a second stops where they pass u times
    the sum.  Both look 12 standard deviations to either side.
    """
    n, q, m = (c.cast("double") for c in (population, successes, draws))
    lo, hi = F.greatest(F.lit(0.0), m + q - n), F.least(q, m)
    mode = F.least(hi, F.greatest(lo, F.floor((q + 1) * (m + 1) / (n + 2)).cast("double")))
    spread = F.sqrt(F.greatest(F.lit(0.0), m * q * (n - q) * (n - m)) / F.greatest(F.lit(1.0), n * n * (n - 1)))
    inputs = F.struct(n.alias("n"), q.alias("q"), m.alias("m"), mode.alias("mode"), u.alias("u"),
                      (F.ceil(spread * 12) + 24).cast("int").alias("reach"))

    def up(v, k):
        return (v["q"] - k) * (v["m"] - k) / ((k + 1) * (v["n"] - v["q"] - v["m"] + k + 1))

    def down(v, k):
        return k * (v["n"] - v["q"] - v["m"] + k) / ((v["q"] - k + 1) * (v["m"] - k + 1))

    def step(v, acc, i):
        k = i.cast("double")
        above = F.greatest(F.lit(0.0), acc["a"] * up(v, v["mode"] + k - 1))
        # below the support the weight is 0 already; keep the divisor away from 0 there
        below = F.when(acc["b"] > 0, F.greatest(F.lit(0.0), acc["b"] * down(v, v["mode"] - k + 1))).otherwise(0.0)
        return F.struct(above.alias("a"), below.alias("b"))

    def total(v):
        zero = F.struct(F.struct(F.lit(1.0).alias("a"), F.lit(1.0).alias("b")).alias("p"), F.lit(1.0).alias("sum"))

        def merge(acc, i):
            p = step(v, acc["p"], i)
            return F.struct(p.alias("p"), (acc["sum"] + p["a"] + p["b"]).alias("sum"))

        return F.aggregate(F.sequence(F.lit(1), v["reach"]), zero, merge, lambda acc: acc["sum"])

    def search(v, goal):
        zero = F.struct(F.struct(F.lit(1.0).alias("a"), F.lit(1.0).alias("b")).alias("p"), F.lit(1.0).alias("sum"),
                        F.when(goal < 1.0, v["mode"]).alias("at"))

        def merge(acc, i):
            p = step(v, acc["p"], i)
            high = acc["sum"] + p["a"]
            at = F.when(acc["at"].isNotNull(), acc["at"]).when(goal < high, v["mode"] + i).when(goal < high + p["b"], v["mode"] - i)
            return F.struct(p.alias("p"), (high + p["b"]).alias("sum"), at.alias("at"))

        return F.aggregate(F.sequence(F.lit(1), v["reach"]), zero, merge, lambda acc: F.coalesce(acc["at"], v["mode"]))

    # one-element transforms bind the inputs once
    return F.transform(F.array(inputs), lambda v: F.transform(
        F.array(v["u"] * total(v)), lambda goal: search(v, goal))[0])[0].cast("bigint")


def uniform(*keys: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*keys), 11).cast("double") / float(2**53)


def split_quotas(quotas: Column, draws: Column, seed: int, lo: Column, hi: Column) -> Column:
    """Multivariate hypergeometric: how many of each quota are among ``draws`` drawn without replacement."""
    zero = F.struct(F.aggregate(quotas, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n"), draws.alias("m"),
                    F.array().cast("array<bigint>").alias("out"))

    def merge(acc, q):
        u = uniform(F.lit(seed), lo, hi, F.size(acc["out"]))
        return F.transform(F.array(hypergeometric(acc["n"], q, acc["m"], u)), lambda x: F.struct(
            (acc["n"] - q).alias("n"), (acc["m"] - x).alias("m"), F.concat(acc["out"], F.array(x)).alias("out")))[0]

    return F.aggregate(quotas, zero, merge, lambda acc: acc["out"])


def splitting_tree(quotas: DataFrame, n_shards: int = N_SHARDS, seed: int = 0) -> DataFrame:
    """(shard, quotas array) from one row holding the array ``quotas`` of block counts per source.

    Shard i of k gets floor((i + 1) n / k) - floor(i n / k) of the n blocks.
    """
    tree = quotas.select(F.lit(0).alias("lo"), F.lit(n_shards).alias("hi"), "quotas",
                         F.aggregate("quotas", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n"))
    for _ in range(math.ceil(math.log2(n_shards)) if n_shards > 1 else 0):
        tree = tree.withColumn("mid", F.expr("div(lo + hi, 2)").cast("int"))
        edge = f"(div(mid * n, {n_shards}) - div(lo * n, {n_shards}))"
        left = split_quotas(F.col("quotas"), F.expr(edge), seed, F.col("lo"), F.col("hi"))
        tree = tree.withColumn("left", F.when(F.col("hi") - F.col("lo") > 1, left))
        right = F.zip_with("quotas", "left", lambda q, x: q - x)
        halves = F.when(F.col("hi") - F.col("lo") > 1, F.array(
            F.struct(F.col("lo"), F.col("mid").alias("hi"), F.col("left").alias("quotas")),
            F.struct(F.col("mid").alias("lo"), F.col("hi"), right.alias("quotas")),
        )).otherwise(F.array(F.struct("lo", "hi", "quotas")))
        tree = tree.select("n", F.inline(halves))
    return tree.select(F.col("lo").alias("shard"), "quotas")


def mix_plan(sizes: DataFrame, n_shards: int = N_SHARDS, block_words: int = BLOCK_WORDS, seed: int = 0,
             weights=WEIGHTS, share: float = SHARE, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Per source: target, take, its blocks, and the first permuted block of each shard (``starts``)."""
    per = source_targets(sizes, weights, share, max_repeat)
    per = settle(per.withColumn("blocks", F.expr(f"div(take + {block_words - 1}, {block_words})")))
    # one row per source, so the row of all quotas is as long as the source list
    whole = per.agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "blocks"))), lambda s: s["blocks"]).alias("quotas"))
    leaves = splitting_tree(whole, n_shards, seed).select("shard", F.posexplode("quotas").alias("_i", "quota"))
    earlier = Window.partitionBy("_i").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = leaves.withColumn("start", F.coalesce(F.sum("quota").over(earlier), F.lit(0)))
    starts = starts.groupBy("_i").agg(F.transform(F.array_sort(F.collect_list(F.struct("shard", "start"))), lambda s: s["start"]).alias("starts"))
    return settle(per.join(starts, "_i").drop("_i"))


def draws_of_rows(docs: DataFrame, n_shards: int = N_SHARDS, block_words: int = BLOCK_WORDS, seed: int = 0,
                  weights=WEIGHTS, share: float = SHARE, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``docs`` with a struct column ``mix``: size, source_size, target, draws.

    ``draws`` is an array of (copy, words, shard, place), one for each time the
    mix draws the row.  Words are counted in ``text`` (null: 0, never drawn).
    Null sources are one source.  Rows that agree in every column are
    interchangeable.  An empty table stays empty.
    """
    taken = {c.lower() for c in docs.columns}
    work = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    doc_id = F.col("_row.doc_id") if "doc_id" in taken else F.lit(None)
    order = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f"|{seed}")))
    work = (work.withColumn("source", F.col("_row.source")).withColumn("_src", source_key(F.col("source")))
            .withColumn("size", F.col("_row.size") if "text" not in taken else word_count(F.col("_row.text")))
            .withColumn("_h", order))
    narrow = settle(work.select("source", "_src", "size", "_h"))
    per = mix_plan(narrow, n_shards, block_words, seed, weights, share, max_repeat)
    k = per.count()
    plan = per.select("_src", "source_size", "target", "take", "blocks", "starts",
                      F.ceil(F.col("n_rows") / BUCKET_ROWS).alias("buckets"))
    plan = bounded_broadcast(plan, k * (8 * n_shards + 200))
    # as many buckets as the source's rows ask for, so that no window holds many more rows than another
    bucket = F.expr(f"div(cast(conv(substr(_h, 1, 8), 16, 10) as bigint) * buckets, {2**32})")
    totals = narrow.join(plan.select("_src", "buckets"), "_src").withColumn("_b", bucket).groupBy("_src", "_b").agg(F.sum("size").alias("_t"))
    planned = work.join(plan, "_src", "left").withColumn("_b", bucket)
    joined = preceding_sum(planned, ["_src"], "_b", ["_h", "size", row_hash(docs, "_row")], "size", "_at", totals)
    big = "decimal(38,0)"

    def draw(copy):
        at = copy * F.col("source_size") + F.col("_at")
        words = F.greatest(F.lit(0).cast("bigint"), F.least(F.col("size"), F.col("take") - at))
        block = F.floor(at / F.lit(block_words)).cast("bigint")
        blocks = F.greatest(F.col("blocks"), F.lit(1))
        turned = (block.cast("decimal(18,0)") * (F.lit(PRIME) % blocks).cast("decimal(19,0)")).cast(big) \
            + (F.abs(F.xxhash64(F.lit(seed), F.col("_src")) % F.lit(2**31))).cast(big)
        rank = (turned % blocks.cast(big)).cast("bigint")
        shard = F.size(F.filter("starts", lambda s: s <= rank)) - 1
        place = F.xxhash64(F.lit(seed + 1), F.col("_h"), F.col("size"), copy)
        return F.struct(copy.cast("int").alias("copy"), words.alias("words"), shard.alias("shard"), place.alias("place"))

    draws = F.filter(F.transform(F.sequence(F.lit(0), F.lit(max_repeat - 1)), draw), lambda d: d["words"] > 0)
    return joined.select("_row", F.struct("size", "source_size", "target", draws.alias("draws")).alias("mix"))


def mix(docs: DataFrame, **params) -> DataFrame:
    """The mix itself: a row per draw, with shard, place, copy and words beside the row's columns.

    Rows lie by shard and, inside it, in shuffled order.  A draw always carries
    the whole row; ``words`` says how many of its words count (fewer than its
    size only for a source's last draw).
    """
    rows = draws_of_rows(docs, **params).select("_row", F.explode("mix.draws").alias("_draw"))
    rows = rows.repartition("_draw.shard", F.pmod("_draw.place", F.lit(64))).sortWithinPartitions("_draw.shard", "_draw.place")
    extra = [F.col(f"_draw.{c}").alias(free_name(docs, c)) for c in ("shard", "place", "copy", "words")]
    return rows.select(*[F.col(f"_row.`{c}`") for c in docs.columns], *extra)
