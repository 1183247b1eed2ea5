"""K-d tree sharding: weighted medians along the widest metadata dimension.

Rows with equal texts form a unit, placed at the metadata of its first row
and weighted by its bytes; a unit heavier than an eighth of a shard is cut by
document id. A node of the tree that stands for several shards is cut along
the dimension in which its units spread most (each scaled to 0..1), at the
weighted quantile that gives either side its number of shards' bytes. All
nodes of a level are cut together: a few passes over the units sum bytes by
node and bin and narrow each node's quantile by a factor of the bins, so no
node is ever sorted or gathered in one task. Equal coordinates are ordered
by a hash of the unit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import located, numbered, pieces, running_total, save

#: Bits of a coordinate and of the tie-break hash in the order key.
COORD_BITS, TIE_BITS = 16, 46
#: Rows that one pass over a level may send to the driver.
PASS_ROWS = 1 << 18
#: A cut is final when its bin holds this part of a shard, or one unit.
CUT_SHARE = 0.0005
#: A unit heavier than this part of a shard is cut by document id.
UNIT_SHARE = 0.125
#: Parts that a heavier one is cut into, for each such share.
HEAVY_PARTS = 4
DIMENSIONS = ("source_at", "lang_at", "length_at")
OUTPUT = (
    "doc_id long, size long, text_crc32 long, law string, shard int, slot long, grown_shard int, "
    "lang string, source string"
)


@dataclass
class _Node:
    shards: int
    first: int
    axis: int = 0
    low: int = 0
    span: int = 1 << (COORD_BITS + TIE_BITS)
    below: float = 0.0
    want: float = 0.0
    cut: int | None = None


def _place(frame: DataFrame, column: str, out: str) -> DataFrame:
    """Distinct values in order, scaled to 0..1; one row per value, null last."""
    values = frame.select(column).distinct()
    rank = F.row_number().over(Window.orderBy(F.col(column).asc_nulls_last())) - 1
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    scaled = rank / F.greatest(F.count(F.lit(1)).over(every) - 1, F.lit(1))
    return values.select(F.col(column).alias(f"_{column}"), scaled.alias(out))


def _units(rows: DataFrame, target: float) -> tuple[DataFrame, DataFrame]:
    """Units ``(unit, part, weight, dimensions, tie)`` and the heavy ones' parts."""
    first = F.min(F.struct("doc_id", "source", "lang")).alias("first")
    whole = save(
        rows.groupBy("unit").agg(F.sum("size").alias("weight"), F.max("size").alias("size"), first), "groups"
    )
    limit = max(1.0, target * UNIT_SHARE)
    # at most shards / UNIT_SHARE units can be that heavy
    heavy = whole.filter((F.col("weight") > limit) & (F.col("weight") > F.col("size"))).select(
        "unit", F.ceil(F.col("weight") / F.lit(max(1.0, limit / HEAVY_PARTS))).cast("int").alias("parts")
    )
    split = (
        rows.join(F.broadcast(heavy), "unit")
        .withColumn("part", F.pmod(F.xxhash64("own"), "parts").cast("int"))
        .groupBy("unit", "part")
        .agg(F.sum("size").alias("part_weight"))
    )
    meta = whole.select("unit", "weight", "size", F.col("first.source").alias("source"), F.col("first.lang").alias("lang"))
    cut = meta.join(F.broadcast(split), "unit", "left").select(
        "unit",
        F.coalesce("part", F.lit(0)).alias("part"),
        F.coalesce("part_weight", "weight").alias("weight"),
        "size",
        "source",
        "lang",
    )
    length = F.least(F.log2("size") / 40, F.lit(1.0))
    placed = cut
    for column in ("source", "lang"):
        places = _place(whole.select(F.col(f"first.{column}").alias(column)), column, f"{column}_at")
        placed = placed.join(places, F.col(column).eqNullSafe(F.col(f"_{column}"))).drop(f"_{column}")
    tie = F.shiftrightunsigned(F.xxhash64("unit", "part"), 64 - TIE_BITS)
    return placed.select(
        "unit", "part", "weight", "source_at", "lang_at", length.alias("length_at"), tie.alias("tie")
    ), heavy


def _order_key(nodes: DataFrame):
    steps = 1 << COORD_BITS
    coord = F.element_at(F.array(*DIMENSIONS), F.col("axis") + 1)
    return F.least(F.floor(coord * steps), F.lit(steps - 1)).cast("long") * F.lit(1 << TIE_BITS) + F.col("tie")


def _cut_level(units: DataFrame, nodes: dict[int, _Node], tolerance: float) -> None:
    """Set axis and cut of the given nodes (those with several shards)."""
    spark = units.sparkSession
    edges = [f(c).alias(f"{f.__name__}_{c}") for c in DIMENSIONS for f in (F.min, F.max)]
    chosen = units.filter(F.col("node").isin(*nodes))
    for row in chosen.groupBy("node").agg(F.sum("weight").alias("weight"), *edges).collect():
        node = nodes[row["node"]]
        spreads = [row[f"max_{c}"] - row[f"min_{c}"] for c in DIMENSIONS]
        node.axis = max(range(len(spreads)), key=spreads.__getitem__)
        node.want = row["weight"] * (node.shards // 2) / node.shards
    open_nodes = dict(nodes)
    while open_nodes:
        bins = max(16, min(1 << 14, PASS_ROWS // len(open_nodes)))
        widths = {k: -(-n.span // bins) for k, n in open_nodes.items()}
        state = spark.createDataFrame(
            [(k, n.axis, n.low, n.span, widths[k]) for k, n in open_nodes.items()],
            "node int, axis int, low long, span long, width long",
        )
        sums = (
            units.join(F.broadcast(state), "node")
            .withColumn("at", _order_key(units) - F.col("low"))
            .filter("at >= 0 and at < span")
            .groupBy("node", F.expr("at div width").alias("bin"))
            .agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("units"))
        )
        found: dict[int, list] = {k: [] for k in open_nodes}
        for row in sums.collect():
            found[row["node"]].append((row["bin"], row["weight"], row["units"]))
        for key, node in list(open_nodes.items()):
            width = widths[key]
            end = node.low + node.span
            for at, weight, count in sorted(found[key]):
                if node.below + weight < node.want:
                    node.below += weight
                    continue
                start = node.low + at * width
                if count == 1 or weight <= tolerance or width == 1:
                    nearer = node.want - node.below > node.below + weight - node.want
                    node.cut = min(start + width, end) if nearer else start
                else:
                    node.low, node.span = start, min(width, end - start)
                break
            else:
                node.cut = end
            if node.cut is not None:
                del open_nodes[key]


def kd_shards(units: DataFrame, shards: int) -> DataFrame:
    """``units`` with ``shard`` from 0 to ``shards - 1``.

    The tree has one level per halving of the number of shards; the units are
    rewritten once a level. The driver holds the tree and the bins of a pass.
    """
    spark = units.sparkSession
    units = save(units.withColumn("node", F.lit(0)), "units")
    total = units.agg(F.sum("weight").alias("w")).first().w or 0
    tree = {0: _Node(shards, 0)}
    while any(n.shards > 1 for n in tree.values()):
        _cut_level(units, {k: n for k, n in tree.items() if n.shards > 1}, total / shards * CUT_SHARE)
        moves, below = [], {}
        for node in tree.values():
            left = node.shards // 2
            if node.shards == 1:
                below[len(below)] = _Node(1, node.first)
                moves.append((0, 0, len(below) - 1, len(below) - 1))
            else:
                below[len(below)] = _Node(left, node.first)
                below[len(below)] = _Node(node.shards - left, node.first + left)
                moves.append((node.axis, node.cut or 0, len(below) - 2, len(below) - 1))
        state = spark.createDataFrame(
            [(k, *m) for k, m in zip(tree, moves, strict=True)], "node int, axis int, cut long, lower int, upper int"
        )
        side = F.when(_order_key(units) < F.col("cut"), F.col("lower")).otherwise(F.col("upper"))
        units = save(
            units.join(F.broadcast(state), "node")
            .withColumn("_to", side)
            .drop("node", "axis", "cut", "lower", "upper")
            .withColumnRenamed("_to", "node"),
            "units",
        )
        tree = below
    names = spark.createDataFrame([(k, n.first) for k, n in tree.items()], "node int, shard int")
    return units.join(F.broadcast(names), "node").drop("node")


def shard_documents(docs: DataFrame, *, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """Deal ``docs(doc_id, text, lang, source)`` into shards of near-equal bytes.

    Give the number of ``shards``, or ``target_bytes`` of which it follows.
    One row per row of ``docs``: ``doc_id, size`` (UTF-8 bytes of the text
    plus 8), ``text_crc32, law`` ("bytes"), ``shard, slot`` (0, 1, .. in each
    shard), ``grown_shard`` (null: shards are balanced, not keyed), ``lang``
    and ``source``.

    A null text counts as empty (size 8, checksum 0); null sources and
    languages come last in their dimension; null ids and repeated rows are
    rows like any other. Rows of equal text share a shard unless together
    they exceed an eighth of one. One document larger than a shard stays
    whole. An empty table gives no rows. Other columns are ignored.
    """
    return _shard(docs, shards, target_bytes, [])


def sharded_documents(
    docs: DataFrame, *, shards: int | None = None, target_bytes: int | None = None, stored: bool = False
) -> DataFrame:
    """:func:`shard_documents` with the ``text`` of every row, in the order of
    shard and slot: the shards themselves. Files written from it, also
    ``partitionBy("shard")``, hold one stretch of slots each; a shard larger than a
    task's share is several files.

    ``stored``: ``docs`` is read from files, so that a row is known by its file
    and its place in it, and its text need not be saved once more.
    """
    columns = ["doc_id", "text", "lang", "source"]
    if stored:
        rows, row = located(docs)
        rows = rows.select(*columns, *row)
    else:
        rows, number = numbered(docs.select(*columns))
        row = [number]
    placed = _shard(rows, shards, target_bytes, row)
    joined = placed.join(rows.select(*row, "text"), row).drop(*row)
    return joined.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")


def _shard(docs: DataFrame, shards: int | None, target_bytes: int | None, keep: list[str]) -> DataFrame:
    """:func:`shard_documents` with the columns ``keep``."""
    if (shards is None) == (target_bytes is None):
        raise ValueError("give either shards or target_bytes")
    text = F.coalesce("text", F.lit(""))
    crc = F.crc32(text.cast("binary"))
    size = (F.octet_length(text) + 8).cast("long")
    rows = save(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            "lang",
            "source",
            size.alias("size"),
            crc.alias("text_crc32"),
            F.xxhash64(text, crc).alias("unit"),
            # tells rows apart that share an id or have none
            F.monotonically_increasing_id().alias("own"),
            *keep,
        ),
        "rows",
    )
    totals = rows.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    total = totals.bytes or 0
    if not totals.rows:
        return docs.sparkSession.createDataFrame([], ", ".join([OUTPUT, *(f"`{c}` {t}" for c, t in docs.dtypes if c in keep)]))
    if shards is None:
        shards = max(1, -(-total // max(1, target_bytes)))
    units, heavy = _units(rows, total / shards)
    dealt = kd_shards(units, shards).select("unit", "part", "shard")
    parted = rows.join(F.broadcast(heavy), "unit", "left").withColumn(
        "part", F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("own"), "parts")).cast("int")
    )
    placed = save(parted.join(dealt, ["unit", "part"]).drop("parts", "part"), "sharded")
    slotted = running_total(
        placed,
        group=["shard"],
        bucket=F.pmod(F.xxhash64("own"), F.lit(pieces(totals.rows))),
        order=["doc_id", "text_crc32", "own"],
        value=F.lit(1),
        out="slot",
    )
    return slotted.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "lang",
        "source",
        *keep,
    )
