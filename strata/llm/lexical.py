"""Ranked lexical search, term-partitioned and pipelined.

The posting lists of the items' terms are split among term owners, the rare
terms' owner first, and every list is cut by blocks of documents. A bundle is
a group of items at one block of documents; it travels through the owners one
after another. At each owner a cogroup brings a bundle and the owner's
postings of that block together, and integer contributions are added to the
bundle's sparse accumulators (document, score so far). The last owner leaves
each item's best documents of the block, and one ranking over those is the
answer.

An accumulator is let go only when it provably cannot be among the best: even
with the greatest possible contributions of all later owners it would stay
below ``k`` others of its own block. Results are those of the full sum.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import map_arrow, save, ship_code

#: A block of the inverted file ends at so many documents or postings.
BLOCK_DOCS, BLOCK_POSTINGS = 4096, 1 << 20
#: Items that travel together; accumulators of a bundle: items x documents of a block at most.
BUNDLE_ITEMS = 256
#: Owner of a term by its document frequency: at most 1/64, 1/8, all of the documents.
OWNER_SHARES = (64, 8, 1)
#: Bits of the term filter (2**22 bits are 512 KiB), the only thing sent to all tasks.
FILTER_BITS = 1 << 22
#: No term contributes more than its weight times this.
MOST = 1_000_000

# Fixed value: characters that part terms, and upper-case letters that are folded.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and non-ASCII characters; A-Z folded."""
    return text.encode().translate(_FOLD).split() if text else []


def item_terms(items: DataFrame) -> DataFrame:
    """``(item_id, term)``, each once: rows that share an id are one item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                (i, t.decode())
                for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)
                for t in set(terms_of(text.as_py()))
            ]
            ids, terms = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(terms, pa.string())], ["item_id", "term"])

    found = map_arrow(items.select(F.col("item_id").cast("long").alias("item_id"), "text"), run, "item_id long, term string")
    return found.distinct()


def term_filter(terms: DataFrame) -> np.ndarray:
    """Bit map of the terms' checksums, at most ``FILTER_BITS`` bits; it may
    let other terms pass, which then find no item."""
    bit = F.pmod(F.crc32("term"), F.lit(FILTER_BITS))
    words = terms.groupBy(F.shiftright(bit, 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int"))).alias("bits")
    )
    out = np.zeros(FILTER_BITS // 64, dtype="<i8")
    for row in words.toLocalIterator():
        out[row.word] = row.bits
    return np.unpackbits(out.view(np.uint8), bitorder="little")


class _Block:
    """Postings of consecutive documents, as rows of the inverted file."""

    FIELDS = [("block", pa.int64()), ("term", pa.string()), ("docs", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())),
              ("ids", pa.list_(pa.int64())), ("df", pa.int64()), ("total", pa.int64())]
    SCHEMA = "block long, term string, docs array<int>, counts array<int>, ids array<long>, df long, total long"

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.sizes: list[int] = []
        self.lists: dict[bytes, tuple[list[int], list[int]]] = {}
        self.postings = 0

    def add(self, doc_id: int | None, terms: list[bytes], wanted: bytes) -> None:
        at = len(self.ids)
        self.ids.append(doc_id)
        self.sizes.append(len(terms))
        for term, count in Counter(terms).items():
            if wanted[zlib.crc32(term) % FILTER_BITS]:
                docs, counts = self.lists.setdefault(term, ([], []))
                docs.append(at)
                counts.append(count)
                self.postings += 1

    @property
    def full(self) -> bool:
        return len(self.ids) >= BLOCK_DOCS or self.postings >= BLOCK_POSTINGS

    def rows(self, number: int) -> pa.RecordBatch:
        """One row a term, and one without a term for the documents themselves."""
        found = list(self.lists.items())
        columns = [
            [number] * (len(found) + 1),
            [None, *(t.decode() for t, _ in found)],
            [None, *(docs for _, (docs, _) in found)],
            [self.sizes, *(counts for _, (_, counts) in found)],
            [self.ids, *[None] * len(found)],
            [sum(n > 0 for n in self.sizes), *(len(docs) for _, (docs, _) in found)],
            [sum(self.sizes), *[0] * len(found)],
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, (_, t) in zip(columns, self.FIELDS, strict=True)], [n for n, _ in self.FIELDS]
        )


def inverted_file(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """Rows ``(block, term, docs, counts, ids, df, total)``: places of a block's
    documents that hold the term, with its occurrences. A block's row without a
    term has the documents' ids and numbers of terms. Blocks are made where the
    documents are read, without a shuffle."""
    wanted = bits.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = TaskContext.get().partitionId() << 33, _Block()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                block.add(doc_id, terms_of(text.as_py()), wanted)
                if block.full:
                    yield block.rows(number)
                    number, block = number + 1, _Block()
        if block.ids:
            yield block.rows(number)

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, _Block.SCHEMA)


def owned_terms(wanted: DataFrame, found: DataFrame, documents: int) -> DataFrame:
    """``(term, owner, bundle, weight, items)``: one row per term and bundle.

    ``items``: the bundle's items that hold the term, each with ``rest``, the
    weights that later owners may still add to it.
    """
    ratio = (2.0 * documents + 2) / (2 * F.col("df") + 1)
    owner = F.lit(len(OWNER_SHARES) - 1)
    for k in range(len(OWNER_SHARES) - 2, -1, -1):
        owner = F.when(F.col("df") * OWNER_SHARES[k] <= documents, k).otherwise(owner)
    weighted = wanted.join(
        found.select("term", F.floor(1000 * F.log(ratio)).cast("long").alias("weight"), owner.alias("owner")), "term"
    )
    by_owner = weighted.groupBy("item_id").agg(
        *(F.sum(F.when(F.col("owner") > k, F.col("weight")).otherwise(0)).alias(f"rest{k}") for k in range(len(OWNER_SHARES)))
    )
    # Keys that group by null like any other value; an id's group is its bundle.
    same = F.col("i.item_id").eqNullSafe(F.col("r.item_id"))
    rest = F.get(F.array(*(F.col(f"rest{k}") for k in range(len(OWNER_SHARES)))), F.col("owner"))
    return (
        weighted.alias("i")
        .join(by_owner.alias("r"), same)
        .select("term", "owner", "bundle", "weight", F.struct(F.col("i.item_id").alias("item_id"), rest.alias("rest")).alias("item"))
        .groupBy("term", "owner", "bundle", "weight")
        .agg(F.collect_list("item").alias("items"))  # at most a bundle's items
    )


_BUNDLE = "block long, bundle long, item_id long, docs array<int>, scores array<long>, sizes array<int>, ids array<long>"


def _add(bundle: pa.Table, postings: pa.Table, documents: int, words: int, best: int) -> tuple[dict, np.ndarray, list]:
    """Scores of a bundle's items over the block after one owner: ``item → (scores, rest)``."""
    header = bundle.filter(pa.compute.is_valid(bundle["ids"]))
    sizes = header["sizes"][0].values.to_numpy()
    lengths = 50 + 50 * sizes.astype(np.int64) * documents // words
    sums: dict[int | None, np.ndarray] = {}
    rests: dict[int | None, int] = {}
    carried = bundle.filter(pa.compute.is_null(bundle["ids"]))
    for item, docs, scores in zip(carried["item_id"].to_pylist(), carried["docs"], carried["scores"], strict=True):
        sums[item] = np.zeros(len(sizes), dtype=np.int64)
        sums[item][docs.values.to_numpy()] = scores.values.to_numpy()
    for row in range(postings.num_rows):
        docs = postings["docs"][row].values.to_numpy()
        tf = postings["counts"][row].values.to_numpy().astype(np.int64)
        added = postings["weight"][row].as_py() * (1_000_000_000 * tf // (1000 * tf + 20 * lengths[docs]))
        for item in postings["items"][row].as_py():
            key = item["item_id"]
            if key not in sums:
                sums[key] = np.zeros(len(sizes), dtype=np.int64)
            sums[key][docs] += added  # a list holds a document once
            rests[key] = item["rest"]
    for item, rest in rests.items():
        scores = sums[item]
        if np.count_nonzero(scores) > best:
            bar = np.partition(scores, len(scores) - best)[len(scores) - best]
            scores[scores < bar - rest * MOST] = 0
    return sums, sizes, header["ids"][0].values.to_pylist()


def search(docs: DataFrame, items: DataFrame, *, best: int = 50) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's ``best`` documents with a
    score above 0, highest first, ties by ascending ``doc_id`` (none last).

    ``docs(doc_id, text)``, ``items(item_id, text)``. Rows of ``items`` with one
    id (or none) are one item; every row of ``docs`` is a document of its own,
    also without an id or with a repeated one. Null and empty texts hold no
    term; other columns are ignored; an empty table gives no rows. A document
    is held whole while its terms are counted.
    """
    spark = docs.sparkSession
    wanted = save(item_terms(items), "lexical-terms")
    number = wanted.select("item_id").distinct().count()
    bundles = max(1, -(-number // BUNDLE_ITEMS))
    wanted = wanted.withColumn("bundle", F.pmod(F.xxhash64(F.coalesce("item_id", F.lit(-1))), F.lit(bundles)))
    index = save(inverted_file(docs, term_filter(wanted)), "lexical-index")
    found = index.groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))
    whole = found.filter("term is null").first()
    documents, words = (int(whole.df), int(whole.total)) if whole else (0, 0)
    terms = save(owned_terms(wanted, found.filter("term is not null"), documents), "lexical-owners")

    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bundles - 1).cast("long")))
    travelling = index.filter("term is null and df > 0").select(
        "block", everywhere.alias("bundle"), F.lit(None).cast("long").alias("item_id"),
        F.lit(None).cast("array<int>").alias("docs"), F.lit(None).cast("array<long>").alias("scores"),
        F.col("counts").alias("sizes"), "ids",
    )
    ship_code(spark)

    def carry(bundle: pa.Table, postings: pa.Table) -> pa.Table:
        sums, _, _ = _add(bundle, postings, documents, words, best)
        held = [(item, np.flatnonzero(scores)) for item, scores in sums.items()]
        held = [(item, at, sums[item][at]) for item, at in held if len(at)]
        header = bundle.filter(pa.compute.is_valid(bundle["ids"]))
        fresh = pa.table(
            {
                "block": pa.array([header["block"][0].as_py()] * len(held), pa.int64()),
                "bundle": pa.array([header["bundle"][0].as_py()] * len(held), pa.int64()),
                "item_id": pa.array([item for item, _, _ in held], pa.int64()),
                "docs": pa.array([at.astype(np.int32) for _, at, _ in held], pa.list_(pa.int32())),
                "scores": pa.array([scores for _, _, scores in held], pa.list_(pa.int64())),
                "sizes": pa.nulls(len(held), pa.list_(pa.int32())),
                "ids": pa.nulls(len(held), pa.list_(pa.int64())),
            }
        )
        return pa.concat_tables([header.cast(fresh.schema), fresh])

    def select(bundle: pa.Table, postings: pa.Table) -> pa.Table:
        sums, _, ids = _add(bundle, postings, documents, words, best)
        rows = []
        for item, scores in sums.items():
            at = np.flatnonzero(scores)
            if len(at) > best:
                at = at[scores[at] >= np.partition(scores[at], len(at) - best)[len(at) - best]]
            ranked = sorted((-int(scores[k]), ids[k] is None, ids[k] or 0) for k in at)
            rows += [(item, None if none else doc, -score) for score, none, doc in ranked[:best]]
        return pa.table({n: pa.array([r[k] for r in rows], pa.int64()) for k, n in enumerate(("item_id", "doc_id", "score"))})

    for owner in range(len(OWNER_SHARES)):
        postings = index.filter("term is not null").join(terms.filter(F.col("owner") == owner), "term")
        # toDF: columns of their own, as both sides come from the index
        postings = postings.select("block", "bundle", "weight", "items", "docs", "counts").toDF(
            "block", "bundle", "weight", "items", "docs", "counts"
        )
        met = travelling.groupBy("block", "bundle").cogroup(postings.groupBy("block", "bundle"))
        last = owner == len(OWNER_SHARES) - 1
        travelling = met.applyInArrow(select if last else carry, "item_id long, doc_id long, score long" if last else _BUNDLE)
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = travelling.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    return ranked.select("item_id", "rank", "doc_id", "score")
