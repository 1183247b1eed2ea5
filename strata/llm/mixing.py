"""Mixing sources to target weights with a low-discrepancy schedule.

Every source's documents, in a shuffled order, form one line of words that is
cut into equal blocks. Slot ``n`` of the schedule maps the ``n``-th van der
Corput point (bit reversal) through the cumulative target shares to a source;
the slots of a source are ranked, and rank ``r`` takes the source's block
``r`` modulo its number of blocks. Any stretch of the schedule is close to
the target shares, and no step draws a random number, so reruns agree.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD, located, numbered, pieces, repeated_rows, running_total, save, unused, word_count

WEIGHTS = (3, 1, 2)
TOTAL_SHARE = 1.5
MAX_EPOCHS = 2
BLOCK_WORDS = 256
#: Cells that the unit interval is cut into to look a point's source up.
CELLS = 1 << 12
_POINT_BITS = 52


@dataclass
class Mix:
    """The parts of a mix: per document, per source, the schedule, and where
    each document lies in its source's line of words."""

    documents: DataFrame
    sources: DataFrame
    schedule: DataFrame
    lines: DataFrame


def _key(column: str):
    """A source as a non-null join key."""
    return F.concat(F.when(F.col(column).isNull(), "1").otherwise("0"), F.coalesce(column, F.lit("")))


def targets(sizes: DataFrame) -> DataFrame:
    """``sizes(source, size)`` → one row per source with its target words.

    Sources in code-point order (null last) get ``WEIGHTS`` in turn and share
    ``TOTAL_SHARE`` of all words; a target stops at ``MAX_EPOCHS`` times its
    source and the rest is shared again by weight. That water level is found in
    one pass: with sources sorted by cap per weight, a source is capped while
    the level over the sources from it on reaches its cap; from the first that
    is not capped on, those levels only fall. The frame has one
    row per source, so its windows run over source names, not documents.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(place, F.lit(len(WEIGHTS))) + 1).cast("int"))
    caps = per.select(
        "*",
        place.cast("long").alias("source_no"),
        weight.cast("double").alias("weight"),
        (F.col("source_size") * MAX_EPOCHS).cast("double").alias("cap"),
    )
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    spent = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(everything) * F.lit(TOTAL_SHARE) - F.coalesce(F.sum("cap").over(spent), F.lit(0.0))
    ) / F.sum("weight").over(rest)
    levels = caps.withColumn("level", level).withColumn(
        "level", F.max(F.when(F.col("cap") > F.col("level") * F.col("weight"), F.col("level"))).over(everything)
    )
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("weight")))
    return levels.select("source", "source_no", "source_size", "rows", "weight", target.alias("target"))


def _plan(sources: DataFrame, block: int) -> DataFrame:
    """Blocks and slots that each source needs, and its stretch of the unit interval."""
    words = F.least(F.round("target").cast("long"), F.col("source_size") * MAX_EPOCHS)
    planned = sources.withColumn("words", words).withColumn(
        "blocks", F.ceil(F.col("source_size") / F.lit(block)).cast("long")
    )
    size = F.greatest("source_size", F.lit(1))
    epochs, rest = F.expr(f"words div {'greatest(source_size, 1L)'}"), F.col("words") % size
    planned = planned.withColumn("rest", rest).withColumn(
        "need", epochs * F.col("blocks") + F.ceil(F.col("rest") / F.lit(block)).cast("long")
    )
    order = Window.orderBy("source_no")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.greatest(F.sum("need").over(everything), F.lit(1))
    return planned.select(
        "*",
        ((F.sum("need").over(upto) - F.col("need")) / total).alias("low"),
        (F.sum("need").over(upto) / total).alias("high"),
    )


def schedule(plan: DataFrame, slots: int) -> DataFrame:
    """``(slot, source_no, rank)``: every source's ranks 0 .. need - 1.

    A point's source is looked up by an equi-join on the cell of the unit
    interval it falls in. The first ``slots`` points give each source its need
    to within a few slots; ranks beyond it are skipped and the missing ones
    follow in source order.
    """
    spark = plan.sparkSession
    bits = F.conv(F.reverse(F.lpad(F.bin("id"), _POINT_BITS, "0")), 2, 10).cast("double")
    points = spark.range(slots).select(F.col("id").alias("slot"), (bits / F.lit(float(1 << _POINT_BITS))).alias("x"))
    points = points.withColumn("cell", F.floor(F.col("x") * CELLS))
    cells = plan.filter("need > 0").select(
        "source_no",
        "low",
        "high",
        "need",
        F.explode(F.sequence(F.floor(F.col("low") * CELLS), F.floor(F.col("high") * CELLS))).alias("cell"),
    )
    drawn = save(points.join(cells, "cell").filter("low <= x and x < high").select("slot", "source_no"), "slots")
    ranked = running_total(
        drawn, group=["source_no"], bucket=F.expr(f"slot div {pieces(slots)}"), order=["slot"], value=F.lit(1), out="rank"
    )
    kept = ranked.join(plan.select("source_no", "need"), "source_no").filter("rank < need").drop("need")
    counts = drawn.groupBy("source_no").agg(F.count(F.lit(1)).alias("drawn"))
    short = plan.join(counts, "source_no", "left").filter("coalesce(drawn, 0) < need")
    extra = short.select(
        "source_no", F.explode(F.sequence(F.coalesce("drawn", F.lit(0)), F.col("need") - 1)).alias("rank")
    )
    extra = extra.withColumn("slot", F.row_number().over(Window.orderBy("source_no", "rank")) - 1 + F.lit(slots))
    return kept.select("slot", "source_no", "rank").unionByName(extra.select("slot", "source_no", "rank"))


def mix(docs: DataFrame, *, block: int = BLOCK_WORDS, seed: int = 0) -> Mix:
    """Take words of ``docs(doc_id, text, source)`` by source to the targets.

    ``Mix.documents`` has one row per row of ``docs``: ``doc_id``, ``source``,
    ``size`` (words), ``source_size``, ``target`` (of its source), ``taken``
    (words of it in the mix, at most ``MAX_EPOCHS`` times its size) and
    ``first_slot`` (the first slot that takes words of it, null if none does).
    ``Mix.schedule`` lists ``slot, source_no, rank, block, words``.

    Null and blank texts have size 0 and are never taken; a null source is a
    source of its own, last in order; null ids and repeated rows are rows like
    any other. A source without words has target 0. An empty table gives empty
    frames. Columns beyond the three are ignored. Texts are only counted, not
    moved (:func:`mixed_blocks` moves them): very long documents span many blocks.
    """
    return _mix(docs, block, seed, [])


def _mix(docs: DataFrame, block: int, seed: int, keep: list[str]) -> Mix:
    """:func:`mix` whose documents also have the columns ``keep``."""
    counted = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", word_count(F.col("text")).alias("size"), *keep
    )
    sized = save(counted, "sizes")
    sources = save(_plan(targets(sized), block), "sources")
    totals = sources.agg(F.sum("need").alias("slots"), F.sum("rows").alias("rows")).first()
    slots, rows = totals.slots or 0, totals.rows or 0
    numbered = sized.withColumn("_key", _key("source")).join(
        sources.select(_key("source").alias("_key"), "source_no", "source_size", "target"), "_key"
    ).drop("_key")
    shuffled = save(numbered.withColumn("order", F.xxhash64(F.lit(seed), "doc_id", "size")), "shuffled")
    cell = F.floor((F.col("order") / F.lit(float(1 << 63)) + 1) * (pieces(rows) / 2)).cast("long")
    lined = save(
        running_total(
            shuffled, group=["source_no"], bucket=cell, order=["order", "doc_id", "size", *keep], value=F.col("size"), out="start"
        ),
        "lines",
    )
    ranks = schedule(sources, slots)
    place = sources.select("source_no", "source_size", "blocks", "need", "rest")
    words = F.when(
        (F.col("rank") == F.col("need") - 1) & (F.col("rest") > 0), (F.col("rest") - 1) % F.lit(block) + 1
    ).otherwise(F.least(F.lit(block), F.col("source_size") - F.col("block") * block))
    plan = save(
        ranks.join(place, "source_no")
        .withColumn("block", F.col("rank") % F.col("blocks"))
        .select("slot", "source_no", "rank", "block", words.cast("long").alias("words")),
        "schedule",
    )
    spans = lined.filter("size > 0").select(
        "source_no",
        "start",
        "size",
        F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")).alias("block"),
    )
    first = F.greatest(F.col("start") - F.col("block") * block, F.lit(0))
    last = F.least(F.col("start") + F.col("size") - F.col("block") * block, F.col("words"))
    taken = (
        spans.join(plan, ["source_no", "block"])
        .groupBy("source_no", "start")
        .agg(
            F.sum(F.greatest(last - first, F.lit(0))).alias("taken"),
            F.min(F.when(last > first, F.col("slot"))).alias("first_slot"),
        )
    )
    documents = (
        lined.filter("size > 0")
        .join(taken, ["source_no", "start"], "left")
        .unionByName(lined.filter("size = 0").withColumns({"taken": F.lit(0).cast("long"), "first_slot": F.lit(None).cast("long")}))
        .select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "first_slot", *keep)
    )
    return Mix(documents, sources, plan, lined.select("source_no", "source", "start", "size", "doc_id", *keep))


def mixed_blocks(docs: DataFrame, *, block: int = BLOCK_WORDS, seed: int = 0) -> DataFrame:
    """The text of the mix of ``docs(doc_id, text, source)`` in slot order.

    One row per piece of a document in a slot's block: ``slot``, ``place`` (of
    its first word in the block), ``source``, ``doc_id``, ``start`` and ``end``
    (word numbers in the document, end exclusive) and ``text`` (its words
    joined by one space). Range-partitioned and sorted by slot and place, so
    files written from it follow each other as the schedule does.

    Every text is cut once into its pieces before it meets the slots, so a very
    long document is never repeated whole. Documents without words are in no
    block; null and repeated ids are rows like any other; an empty table gives
    no rows.
    """
    rows, row = numbered(docs.select("doc_id", "text", "source"))
    made = _mix(rows, block, seed, [row])
    whole = made.lines.filter("size > 0").join(rows.select(row, "text"), row)

    def cut(at):
        first = F.greatest(at * block - F.col("start"), F.lit(0))
        upto = F.least((at + 1) * block - F.col("start"), F.col("size"))
        words = F.slice("words", (first + 1).cast("int"), (upto - first).cast("int"))
        return F.struct(at.alias("block"), first.alias("first"), words.alias("words"))

    blocks = F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")
    pieces_of = whole.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).select(
        "source_no", "source", "doc_id", "start", F.explode(F.transform(blocks, cut)).alias("piece")
    )
    pieces_of = pieces_of.select("source_no", "source", "doc_id", F.col("start").alias("line"), "piece.*")
    taken = pieces_of.join(made.schedule.withColumnRenamed("words", "limit"), ["source_no", "block"])
    place = F.col("line") + F.col("first") - F.col("block") * block
    held = F.least(F.size("words").cast("long"), F.col("limit") - F.col("place"))
    found = taken.withColumn("place", place).withColumn("held", held).filter("held > 0")
    return (
        found.select(
            "slot",
            "place",
            "source",
            "doc_id",
            F.col("first").alias("start"),
            (F.col("first") + F.col("held")).alias("end"),
            F.array_join(F.slice("words", F.lit(1), F.col("held").cast("int")), " ").alias("text"),
        )
        .repartitionByRange("slot", "place")
        .sortWithinPartitions("slot", "place")
    )


def mixed_documents(docs: DataFrame, *, block: int = BLOCK_WORDS, seed: int = 0, stored: bool = False) -> DataFrame:
    """``docs`` as the mix takes them: every document as many times (0, 1 or
    2) as its taken words are nearest to; all columns as they are.

    Blocks follow the documents' line, so all but the few documents that a
    source's last block cuts are taken whole. Every row is decided by itself,
    whatever other rows share its doc_id or have none.

    ``stored``: ``docs`` is read from files, so that a row is known by its file
    and its place in it, and the texts need not be saved once more.
    """
    if stored:
        rows, row = located(docs)
    else:
        rows, number = numbered(docs)
        row = [number]
    times, copy = unused(docs, "_copies"), unused(docs, "_copy")
    taken = _mix(rows, block, seed, row).documents
    copies = taken.select(*row, F.round(F.col("taken") / F.greatest("size", F.lit(1))).cast("int").alias(times)).filter(
        F.col(times) > 0
    )
    marked = repeated_rows(rows, row, copies, times, MAX_EPOCHS)
    repeated = marked.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times))))
    return repeated.select(docs.columns)
