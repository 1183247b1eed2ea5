"""Helpers shared by the corpus operators."""

from __future__ import annotations

import io
import math
import zipfile
from collections.abc import Callable, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import strata
from strata.session import shared_scratch
from strata.sources import storage

#: A word is a maximal run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of the rows that a Python worker gets at a time, about. Spark's own
#: bound is 10,000 rows, which hold 33 MB if a text has 3.3 KB.
BATCH_BYTES = 4 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def save(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Used where a frame feeds several jobs or a loop: lineage ends at files
    every executor can reach, so a lost executor costs one re-read, and
    later jobs do not repeat the work (or see another random order).
    """
    spark = df.sparkSession
    path = shared_scratch(spark, f"llm-{purpose}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or with underscores added what no column of ``df`` is called."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(df: DataFrame) -> tuple[DataFrame, str]:
    """``df``, saved, with a number of its own for every row, so that rows that
    share an id or have none can be told apart in several jobs; and the new
    column's name, which no other column has."""
    name = unused(df, "_row")
    return save(df.withColumn(name, F.monotonically_increasing_id()), "rows"), name


def located(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """``df``, which must be read from files, with the file of every row and its
    place in it, so that rows can be told apart in several jobs and need not be
    saved once more; and the two new columns' names."""
    file, place = unused(df, "_file"), unused(df, "_row")
    at = df.metadataColumn("_metadata")
    return df.select("*", at["file_path"].alias(file), at["row_index"].alias(place)), [file, place]


def repeated_rows(rows: DataFrame, row: Sequence[str], times: DataFrame, out: str, most: int) -> DataFrame:
    """Rows of ``rows`` that are in ``times(row, out)``, with ``out``: 1 to ``most``.

    ``row`` tells rows apart, its last column is a number from 0. The numbers
    are joined as bitmaps, ``most`` bits a row and 4 KiB for 32,768 numbers in
    sequence, so that the texts stay where they are for as long as Spark finds
    the bitmaps small enough to broadcast. Being saved, their size is known.
    """
    *group, number = row
    at, bucket = F.bitmap_bit_position(F.col(number)), F.bitmap_bucket_number(F.col(number))
    keys = {c: unused(rows, f"_of{k}") for k, c in enumerate(group)} | {number: unused(rows, "_bucket")}
    bits = [unused(rows, f"_bits{k}") for k in range(1, most + 1)]
    marks = times.groupBy(*[F.col(c).alias(keys[c]) for c in group], bucket.alias(keys[number])).agg(
        *[F.bitmap_construct_agg(F.when(F.col(out) >= k, at)).alias(b) for k, b in enumerate(bits, 1)]
    )
    found = save(marks, "marked-rows")
    same = bucket == found[keys[number]]
    for c in group:
        same &= rows[c] == found[keys[c]]

    def bit(column: str) -> Column:
        byte = F.conv(F.hex(F.substring(F.col(column), F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, (at % 8).cast("int")).cast("int")

    counted = rows.join(found, same).withColumn(out, sum((bit(b) for b in bits[1:]), bit(bits[0])))
    return counted.filter(F.col(out) > 0).drop(*keys.values(), *bits)


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Python workers import the functions and models they get by name, and need
    not have the package installed.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(strata.__file__).resolve().parent
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    target = f"{shared_scratch(spark, 'llm-code')}/strata_code.zip"
    storage.write_bytes(spark, target, archive.getvalue())
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def map_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``mapInArrow`` with this package on the workers' path."""
    ship_code(df.sparkSession)
    return df.mapInArrow(run, schema)


def bound_batches(spark: SparkSession) -> None:
    """Let Arrow batches of this session hold ``BATCH_BYTES``, unless it has a bound.

    A batch is held by the executor and, as bytes and as Python strings, by the
    worker, and what a worker once took it keeps for all later stages.
    """
    if spark.conf.get(_BATCH_CONF, None) is None:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))


def word_count(text: Column) -> Column:
    """Number of words (0 for null or blank text)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def remainder_of_id(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (null ids count as '')."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(modulus))


def pieces(rows: int) -> int:
    """Pieces that :func:`running_total` should cut ``rows`` into: the square
    root, so that a piece and the list of pieces both stay far below the rows."""
    return max(1, math.isqrt(rows))


def running_total(
    df: DataFrame,
    *,
    group: Sequence[str],
    bucket: Column,
    order: Sequence[str],
    value: Column,
    out: str,
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the earlier rows of the group.

    A group may hold a third of all rows, so no window ever spans a group:
    ``bucket`` (ascending with the order, not null) cuts it into pieces of
    bounded size, a window numbers each piece, and the pieces' totals, one
    row each, give the offsets. ``group`` columns must not be null. ``df``
    is used twice; pass a saved frame.
    """
    pieces = df.withColumn("_bucket", bucket).withColumn("_value", value)
    totals = pieces.groupBy(*group, "_bucket").agg(F.sum("_value").alias("_total"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *group, "_bucket", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy(*group, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = pieces.withColumn("_local", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    joined = local.join(offsets, [*group, "_bucket"])
    return joined.withColumn(out, (F.col("_local") + F.col("_offset")).cast("long")).drop(
        "_bucket", "_value", "_local", "_offset"
    )
