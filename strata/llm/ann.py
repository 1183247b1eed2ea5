"""Approximate nearest neighbours with a permutation index.

Every vector is represented by the order in which it sees its ``PREFIX``
nearest of ``PIVOTS`` pivots, and posted under each of them with the pivot's
place in that order (Amato and Savino's metric inverted file). A query reads
the posting lists of its own nearest pivots, adds up the footrule distance
between the two orders (a pivot missing from a prefix counts as placed just
behind it), and reranks the nearest by the inner product.

Equal rows are one row with a count. Rows are dealt by a hash of id and vector
into blocks of bounded size, one block a partition; a block's inverted file
lives in one task, the queries come in broadcast blocks of bounded size, and
only the best of each block leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import save, ship_code

PIVOTS = 256
PREFIX = 64
#: Share of a block's distinct vectors that is reranked, and the least number.
RERANK_SHARE = 0.16
RERANK_LEAST = 256
BLOCK_ROWS = 1 << 14
#: Floats in one broadcast block of queries.
QUERY_FLOATS = 1 << 22
TOP = 20


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, embedding array<double>)`` without vectors that are null,
    empty, zero or hold null or non-finite components."""
    values = F.col("embedding").cast("array<double>")
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), values.alias("embedding"))
        .filter(F.col("vec_id").isNotNull() & (F.size("embedding") > 0))
        .filter(finite)
        .filter(F.exists("embedding", lambda v: v != 0))
    )


def choose_pivots(vectors: DataFrame, pivots: int = PIVOTS) -> np.ndarray:
    """A bounded draw of distinct vectors by a hash of their content."""
    drawn = (
        vectors.groupBy(F.xxhash64("embedding").alias("draw"))
        .agg(F.min("embedding").alias("embedding"))  # copies are one row before the draw
        .orderBy("draw")
        .limit(pivots)
        .collect()
    )
    rows = [tuple(r["embedding"]) for r in drawn]
    return np.array(rows, dtype=np.float64)


def prefixes(rows: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The nearest pivots of each row, nearest first (ties to the lower number)."""
    return np.argsort(-(rows @ pivots.T), axis=1, kind="stable")[:, :prefix]


class InvertedFile:
    """Posting lists of one block: by pivot, the rows that see it and its place."""

    def __init__(self, rows: np.ndarray, pivots: np.ndarray, prefix: int):
        self.size, self.prefix = len(rows), min(prefix, len(pivots))
        orders = prefixes(rows, pivots, self.prefix)
        by_pivot = np.argsort(orders.ravel(), kind="stable")
        self.rows = (by_pivot // self.prefix).astype(np.int32)
        self.places = (by_pivot % self.prefix).astype(np.int32)
        self.starts = np.searchsorted(orders.ravel()[by_pivot], np.arange(len(pivots) + 1))

    def footrule(self, order: np.ndarray) -> np.ndarray:
        """Footrule distance of every row's order to the given one."""
        k = self.prefix
        lists = [slice(self.starts[p], self.starts[p + 1]) for p in order]
        rows = np.concatenate([self.rows[s] for s in lists])
        # a shared pivot saves both missing-pivot costs and pays the difference of places
        saved = np.concatenate([(2 * k - at - self.places[s]) - np.abs(at - self.places[s]) for at, s in enumerate(lists)])
        return k * (k + 1) - np.bincount(rows, weights=saved, minlength=self.size)


def _search(block: pd.DataFrame, queries, pivots: np.ndarray, top: int) -> Iterator[tuple]:
    """The block's nearest rows of each query, best first, ties to smaller ids.

    ``block`` has ``vec_id``, ``embedding`` and ``times``, the number of equal rows."""
    block = block.sort_values("vec_id")
    matrix = np.array(block["embedding"].tolist(), dtype=np.float64)
    ids, times = block["vec_id"].to_numpy(), block["times"].to_numpy()
    values, owner = np.unique(matrix, axis=0, return_inverse=True)
    owner = owner.ravel()
    order = np.argsort(owner, kind="stable")  # rows of a vector, ids ascending
    starts = np.searchsorted(owner[order], np.arange(len(values) + 1))
    index = InvertedFile(values, pivots, PREFIX)
    depth = min(len(values), max(RERANK_LEAST, int(RERANK_SHARE * len(values))))
    for query_id, query, near in zip(*queries, strict=True):
        distance = index.footrule(near)
        picked = np.argpartition(distance, depth - 1)[:depth]
        # vectors that only rows of the query's own id have are no candidates
        mine, mine_rows = np.unique(owner[slice(*np.searchsorted(ids, [query_id, query_id + 1]))], return_counts=True)
        picked = np.setdiff1d(picked, mine[mine_rows == starts[mine + 1] - starts[mine]])
        scores = (values[picked] * query).sum(axis=1)
        # the rows of a vector share a score, so this many distinct vectors hold the block's best
        best = np.lexsort((ids[order[starts[picked]]], -scores))[: top + 1]
        found = []
        for score, v in zip(scores[best].tolist(), picked[best], strict=True):
            rows = order[starts[v] : starts[v + 1]]
            if v in mine:
                rows = rows[ids[rows] != query_id]
            for row in rows[:top]:
                found += [(-score, int(ids[row]))] * min(top, int(times[row]))
        found.sort()
        yield query_id, [v for _, v in found[:top]], [-s for s, _ in found[:top]]


def _searcher(shared, top: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [b for b in batches if len(b)]
        if not rows:
            return
        ids, matrix, near, pivots = shared.value
        for _, block in pd.concat(rows, ignore_index=True).groupby("block"):
            found = list(_search(block, (ids, matrix, near), pivots, top))
            yield pd.DataFrame(found, columns=["query_id", "vec_ids", "scores"])

    return run


def search(vectors: DataFrame, queries: DataFrame, *, top: int = TOP) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest found of each query by
    inner product, ties to the smaller vec_id, never the query's own vec_id.

    ``vectors`` and ``queries`` have ``vec_id`` and ``embedding``; other columns
    are ignored. Vectors that :func:`usable` rejects, or whose length is not
    the most common one, take no part on either side. Every row is a
    candidate, rows that share a vec_id and equal rows too: an id may come more
    than once in an answer. Of several query rows of one vec_id the least
    vector asks. Fewer candidates than ``top`` give fewer rows; an empty side
    gives none.
    """
    spark = vectors.sparkSession
    ship_code(spark)
    result = "query_id long, rank int, vec_id long, score double"
    kept = usable(vectors).groupBy("vec_id", "embedding").agg(F.count(F.lit(1)).alias("times"))
    kept = save(kept.withColumn("n", F.size("embedding")), "vectors")
    shape = kept.groupBy("n").agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "n").first()
    if shape is None:
        return spark.createDataFrame([], result)
    size, rows = shape["n"], shape["rows"]
    kept = kept.filter(F.col("n") == size).drop("n")
    pivots = choose_pivots(kept)
    blocks = -(-rows // BLOCK_ROWS)
    dealt = kept.withColumn("block", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(blocks)).cast("int"))
    dealt = dealt.repartitionById(blocks, F.col("block"))
    asked = usable(queries).filter(F.size("embedding") == size).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    asked = save(asked, "queries")
    parts = max(1, -(-asked.count() * size // QUERY_FLOATS))
    found = spark.createDataFrame([], "query_id long, vec_id long, score double")
    for part in range(parts):
        rows_of = asked.filter(F.pmod(F.xxhash64("vec_id", F.lit("query")), F.lit(parts)) == part).collect()
        if not rows_of:
            continue
        matrix = np.array([r["embedding"] for r in rows_of], dtype=np.float64)
        shared = spark.sparkContext.broadcast(
            ([r["vec_id"] for r in rows_of], matrix, prefixes(matrix, pivots, PREFIX), pivots)
        )
        best = dealt.mapInPandas(_searcher(shared, top), "query_id long, vec_ids array<long>, scores array<double>")
        pairs = best.select("query_id", F.explode(F.arrays_zip("vec_ids", "scores")).alias("pair"))
        found = found.unionByName(pairs.select("query_id", F.col("pair.vec_ids").alias("vec_id"), F.col("pair.scores").alias("score")))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
