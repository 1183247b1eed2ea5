"""``row_number()`` within groups that stays parallel at any group size.

In a fact table almost every group is small, and one group may hold a
third of all rows. So no window goes over a whole large group:

1. Rows of unrepeated groups have rank 1 and are never shuffled. A keys-only
   pass counts 64-bit hashes of the group key (8 bytes a row, combined before
   the shuffle); the hashes seen twice set bits in a map of ``MARK_WORDS``
   words, the only thing broadcast, whose size does not depend on the data. A
   row whose bit is clear is alone in its group. (A bit may be set by another
   group's hash; such a row merely takes another way, which is exact.)
2. Rows of groups of at most a ``GROUPS_A_PIECE``-th of a task's rows are
   shuffled once, by key, and ranked by a window. A second map marks the others.
3. Rows of larger groups are range-partitioned by group key, order columns and, for
   ties, a number of their own, which cuts a large group into consecutive
   pieces even if all its rows are equal, and written to the shared folder, so every later pass and every retried task sees the same pieces.
   A row's rank is its number within (group, piece) plus the rows of the
   group in earlier pieces, which are counted per (group, piece).

Rows equal in all order columns are interchangeable; no row id is needed.

The first pass also counts the rows of the second and third way. Beyond
``PIECE_ROWS`` they are dealt to tasks by that count: adaptive execution packs tasks by
compressed bytes, and repeated rows compress so well that a task would sort,
and spill, many times the rows it can hold.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import shared_scratch

#: 64-bit words of the map of repeated hashes (2**20 words are 8 MiB).
MARK_WORDS_LOG2 = 20
#: Repeated rows that one task sorts, about.
PIECE_ROWS = 250_000
#: Groups that such a task has at least, unless they are cut.
GROUPS_A_PIECE = 250


def plain_rank(df: DataFrame, key: Sequence[str], ordering: Sequence[Column], rank_col: str) -> DataFrame:
    """The window over whole groups: what ``skew_safe_rank`` must equal."""
    return df.withColumn(
        rank_col, F.row_number().over(Window.partitionBy(*key).orderBy(*ordering)).cast("bigint")
    )


def _save(df: DataFrame, purpose: str) -> DataFrame:
    path = shared_scratch(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _bit(hash_: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), hash_.bitwiseAND(F.lit(63)).cast("int"))


def _word(hash_: Column) -> Column:
    return F.shiftrightunsigned(hash_, 64 - MARK_WORDS_LOG2).cast("int")


def _marks(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """``(_word, _bits, _large, _rows, _large_rows)``: at most ``2**MARK_WORDS_LOG2``
    rows; the bits and rows of repeated hashes, and of those of large groups."""
    hashes = df.select(F.xxhash64(*key).alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
    repeated = hashes.filter("_n > 1").select(
        _word(F.col("_h")).alias("_word"),
        _bit(F.col("_h")).alias("_bit"),
        "_n",
        (F.col("_n") > F.lit(PIECE_ROWS // GROUPS_A_PIECE)).alias("_cut"),
    )
    return repeated.groupBy("_word").agg(
        F.bit_or("_bit").alias("_bits"),
        F.bit_or(F.when(F.col("_cut"), F.col("_bit")).otherwise(F.lit(0))).alias("_large"),
        F.sum("_n").alias("_rows"),
        F.sum(F.when(F.col("_cut"), F.col("_n")).otherwise(F.lit(0))).alias("_large_rows"),
    )


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Tasks to sort so many rows in; 0 if they are few enough to be left to
    adaptive execution."""
    return 0 if rows <= PIECE_ROWS else max(spark.sparkContext.defaultParallelism, -(-rows // PIECE_ROWS))


def skew_safe_rank(
    df: DataFrame, key: Sequence[str], order_cols: Sequence[str], *, rank_col: str = "rank"
) -> DataFrame:
    """``row_number() OVER (PARTITION BY key ORDER BY order_cols ASC NULLS LAST)``."""
    columns = df.columns
    marks = _save(_marks(df, key), "rank-marks")
    hash_ = F.xxhash64(*key)
    counts = marks.agg(F.sum("_rows").alias("rows"), F.sum("_large_rows").alias("large")).first()
    rows, large = counts.rows or 0, counts.large or 0
    marked = df.join(F.broadcast(marks.select("_word", "_bits", "_large")), _word(hash_) == F.col("_word"), "left")

    def among(bits: str) -> Column:
        return F.coalesce(F.col(bits).bitwiseAND(_bit(hash_)) != 0, F.lit(False))

    ordering = [F.col(c).asc_nulls_last() for c in order_cols]
    found = marked.filter(~among("_bits")).select(*columns, F.lit(1).cast("bigint").alias(rank_col))
    if rows > large or not large:
        small = marked.filter(among("_bits") & ~among("_large")).select(*columns)
        tasks = tasks_for(df.sparkSession, rows - large)
        found = found.unionByName(plain_rank(small.repartition(tasks, *key) if tasks else small, key, ordering, rank_col))
    if not large:
        return found

    tasks = tasks_for(df.sparkSession, large)
    dealt = [tasks] if tasks else []
    # The row's own number ends the range key, so that rows equal in key and all
    # order columns, however many, are cut into pieces like any others.
    own = marked.filter(among("_large")).select(*columns, F.monotonically_increasing_id().alias("_own"))
    pieces = own.repartitionByRange(*dealt, *key, *ordering, "_own").drop("_own")
    placed = _save(pieces.withColumn("_piece", F.spark_partition_id()), "rank-pieces")
    sizes = placed.groupBy(*key, "_piece").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*key).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    renamed = {c: f"_k_{c}" for c in [*key, "_piece"]}
    offsets = (
        sizes.withColumn("_offset", F.sum("_n").over(earlier))
        .filter("_offset is not null")  # groups that are cut, at most one per piece's edge
        .select(*(F.col(c).alias(r) for c, r in renamed.items()), "_offset")
    )
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(r)) for c, r in renamed.items()))
    inside = Window.partitionBy(*key, "_piece").orderBy(*ordering)
    if tasks:
        placed = placed.repartition(tasks, *key, "_piece")
    ranked = placed.withColumn("_number", F.row_number().over(inside)).join(offsets, same, "left")
    rank = (F.col("_number") + F.coalesce("_offset", F.lit(0))).cast("bigint")
    return found.unionByName(ranked.select(*columns, rank.alias(rank_col)))
