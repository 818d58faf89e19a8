"""Exact ranks and boundaries without one-task windows.

A plain ``row_number().over(partitionBy(label).orderBy(h))`` puts every row
of a class into one task: with a binary label the whole table lands on two
tasks.  The two-level form used here keeps the same total order but spreads
the work:

1. every row gets a hash ``h`` and a bucket = the first hex characters of
   ``h`` (so bucket order agrees with ``h`` order); the number of characters
   follows from the row count, for about TARGET_ROWS_PER_BUCKET rows each;
2. rows are counted per (class, bucket) - a partial aggregation;
3. prefix sums over that table give each bucket's offset;
4. ``row_number`` inside (class, bucket) plus the offset is the exact rank.

A split needs no rank of every row: the (hash, id) at each boundary rank is
found in one bucket per class, and rows are compared with it where they are.

Null ids hash like the text 'null' and null classes form their own class, so
no row is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TARGET_ROWS_PER_BUCKET = 100_000


def hash_key(id_col: str, seed) -> Column:
    """md5 of ``<id>|<seed>``; the same string hashes equally in DuckDB."""
    return F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(f"|{seed}")))


def hex_digits_for_rows(rows: int, target: int = TARGET_ROWS_PER_BUCKET) -> int:
    """Shortest hash prefix that gives about ``target`` rows per bucket (at least one digit)."""
    digits = 1
    while target * 16**digits < rows:
        digits += 1
    return digits


def largest_class(df: DataFrame, part_cols: list[str]) -> int:
    """Rows of the largest class."""
    return df.groupBy(*part_cols).count().agg(F.max("count")).first()[0] or 0


def _null_safe(left: list[str], right: list[str]) -> Column:
    cond = F.lit(True)
    for a, b in zip(left, right):
        cond = cond & F.col(a).eqNullSafe(F.col(b))
    return cond


def _offsets(d: DataFrame, part_cols: list[str], size_col: str) -> DataFrame:
    """Per (class, bucket): rows before it in the class, its rows and the class size."""
    counts = d.groupBy(*part_cols, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*part_cols).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        *[F.col(c).alias(f"_o_{c}") for c in part_cols], F.col("_b").alias("_o_b"), "_n",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
        F.sum("_n").over(Window.partitionBy(*part_cols)).alias(size_col))


def hash_rank(df: DataFrame, part_cols: list[str], id_col: str, seed=42, hex_digits: int | None = None,
              rank_col: str = "rank", size_col: str = "class_size") -> DataFrame:
    """Add ``rank`` (1-based, order by (hash, id) within ``part_cols``) and the partition size."""
    hd = hex_digits or hex_digits_for_rows(largest_class(df, part_cols))
    d = df.withColumn("_h", hash_key(id_col, seed)).withColumn("_b", F.substring("_h", 1, hd))
    o = _offsets(d, part_cols, size_col).drop("_n")
    same = _null_safe(part_cols, [f"_o_{c}" for c in part_cols]) & (F.col("_b") == F.col("_o_b"))
    j = d.join(o, same, "inner").drop(*[f"_o_{c}" for c in part_cols], "_o_b")
    w = Window.partitionBy(*part_cols, "_b").orderBy("_h", id_col)
    return j.withColumn(rank_col, (F.col("_off") + F.row_number().over(w)).cast("bigint")).drop("_h", "_b", "_off")


def boundaries(df: DataFrame, part_col: str, id_col: str, ranks: dict[str, Column], seed=42,
               hex_digits: int | None = None) -> DataFrame:
    """Per class the (hash, id) at each wanted rank.

    ``ranks`` maps a name to an expression of ``class_size``; a rank of 0 has
    no boundary (null).  Output: ``_o_<part_col>`` and one struct per name.
    ``df`` is read twice and should be narrow.
    """
    hd = hex_digits or hex_digits_for_rows(largest_class(df, [part_col]))
    d = df.select(part_col, id_col).withColumn("_h", hash_key(id_col, seed)).withColumn("_b", F.substring("_h", 1, hd))
    o = _offsets(d, [part_col], "class_size")
    wanted = F.inline(F.array(*[F.struct(F.lit(n).alias("_name"), k.cast("bigint").alias("_k")) for n, k in ranks.items()]))
    hit = o.select("*", wanted).filter((F.col("_k") > F.col("_off")) & (F.col("_k") <= F.col("_off") + F.col("_n")))
    # one bucket per class and boundary
    inside = d.join(hit.select(f"_o_{part_col}", "_o_b").distinct(), F.col(part_col).eqNullSafe(F.col(f"_o_{part_col}"))
                    & (F.col("_b") == F.col("_o_b")), "left_semi")
    ranked = inside.withColumn("_i", F.row_number().over(Window.partitionBy(part_col, "_b").orderBy("_h", id_col)))
    found = ranked.join(hit, F.col(part_col).eqNullSafe(F.col(f"_o_{part_col}")) & (F.col("_b") == F.col("_o_b"))
                        & (F.col("_off") + F.col("_i") == F.col("_k")), "inner")
    at = F.struct(F.col("_h").alias("h"), F.col(id_col).alias("id"))
    sizes = o.select(f"_o_{part_col}").distinct()
    cuts = found.groupBy(F.col(part_col).alias("_c")).agg(
        *[F.max(F.when(F.col("_name") == n, at)).alias(n) for n in ranks])
    return sizes.join(cuts, F.col(f"_o_{part_col}").eqNullSafe(F.col("_c")), "left").drop("_c")
