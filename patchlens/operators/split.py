"""Repeatable, exact stratified splits, folds and capped samples.

Rows are ordered inside their class by md5(id|seed); a split takes the first
ceil(n_c * share) rows of each class.  The result depends only on ids and the
seed - not on partitioning, task order or executor loss - so a recomputed
partition after a failure yields the same assignment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchlens.operators.labels import top_n
from patchlens.operators.ranked import boundaries, hash_key, hash_rank


#: Boundaries of at most so many classes are broadcast.
BROADCAST_CLASSES = 100_000


def stratified_split(df: DataFrame, id_col: str, label: str, test_share: float = 0.2,
                     val_share: float | None = 0.25, seed=42, hex_digits: int | None = None) -> DataFrame:
    """Add ``split`` in {train, val, test}.

    test = first ceil(n_c * test_share) rows of each class by (md5, id); val =
    next ceil(rest_c * val_share) (if ``val_share``); train = the remainder.
    Rows are compared with their class's boundary (hash, id), so they are not
    shuffled; rows that repeat an id fall on one side together.  A null label
    is a class of its own, a null id hashes like any other.
    """
    n = F.col("class_size")
    n_test = F.ceil(n * F.lit(test_share))
    ranks = {"_test": n_test}
    if val_share:
        ranks["_val"] = n_test + F.ceil((n - n_test) * F.lit(val_share))
    # two columns, written once: the source is not read again for each step
    narrow = df.select(label, id_col).checkpoint(eager=True)
    cuts = boundaries(narrow, label, id_col, ranks, seed, hex_digits).checkpoint(eager=True)  # one row per class
    # left to its estimate, the join would deal all columns of the rows by class: one task per class
    cuts = F.broadcast(cuts) if cuts.count() <= BROADCAST_CLASSES else cuts
    d = df.join(cuts, F.col(label).eqNullSafe(F.col(f"_o_{label}")), "left")
    at = F.struct(hash_key(id_col, seed).alias("h"), F.col(id_col).alias("id"))
    split = F.when(at <= F.col("_test"), F.lit("test"))
    if val_share:
        split = split.when(at <= F.col("_val"), F.lit("val"))
    return d.withColumn("split", split.otherwise(F.lit("train"))).drop(f"_o_{label}", *ranks)


def stratified_kfold(df: DataFrame, id_col: str, label: str, k: int = 3, seed=42, hex_digits: int | None = None) -> DataFrame:
    """fold = (rank - 1) % k inside each class."""
    r = hash_rank(df, [label], id_col, seed, hex_digits)
    return r.withColumn("fold", ((F.col("rank") - 1) % k).cast("int")).drop("rank", "class_size")


def kfold(df: DataFrame, id_col: str, k: int = 5, seed=42, hex_digits: int | None = None) -> DataFrame:
    """Unstratified folds through the same two-level rank (one dummy class)."""
    d = df.withColumn("_all", F.lit(0))
    r = hash_rank(d, ["_all"], id_col, seed, hex_digits)
    return r.withColumn("fold", ((F.col("rank") - 1) % k).cast("int")).drop("rank", "class_size", "_all")


def sample_cap(df: DataFrame, id_col: str, n: int, seed=42) -> DataFrame:
    """At most ``n`` rows without replacement: the n smallest md5(id|seed) (see ``top_n``)."""
    return top_n(df.withColumn("_h", hash_key(id_col, seed)), n, "_h", tiebreak=[id_col]).drop("_h")
