"""Benchmark decontamination by spaced-seed hashing.

A spaced seed is a fixed mask over consecutive tokens: the tokens at its ones
are hashed, those at its zeros are ignored, so a window whose substituted
tokens fall on zeros still hits. Every window of every benchmark item and of
every document is hashed under each mask; equal hashes are hits. Around a hit
the two token rows are aligned and the best window of ``WINDOW`` tokens is
sought; the overlap counts if enough of its tokens are equal. Items shorter
than a window are compared whole and have masks of their own by length, so
that none of the allowed substitutions hides them.

The benchmark is the stated query set: it is indexed in blocks of bounded
size, each broadcast and run against all documents, so documents are never
shuffled and a passage that many of them share costs nothing extra.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_arrow, save, unused

#: Token positions that count (1) or are ignored (0). Together they are lossless:
#: whichever two tokens of a window of 13 are substituted, one of them fits.
WINDOW_MASKS = ("1111111", "11110111", "11101111", "1110100111")
#: By the shortest item they serve, up to the next entry: masks that are lossless
#: for what ``SHARE`` allows there (none, one from 5 and two from 10 tokens on).
SHORT_MASKS = {
    1: ("1",),
    2: ("11",),
    3: ("111",),
    4: ("1111",),
    5: ("1111", "11101", "11011", "10111"),
    7: ("11111", "111011", "110111"),
    8: ("111111", "1111011", "1101111"),
    10: ("1111011", "11001111", "110110011", "11110101", "10101111"),
    12: ("11110111", "1100101111", "11011001011", "1111111", "11111101"),
}
MASKS = tuple(dict.fromkeys([*WINDOW_MASKS, *(m for masks in SHORT_MASKS.values() for m in masks)]))
#: Tokens of a verified overlap, and the share of them that must be equal.
WINDOW = 13
SHARE = 0.8
#: Benchmark tokens in one broadcast index, and tokens of one piece of an item.
BLOCK_TOKENS = 1 << 18
PIECE_TOKENS = 1 << 12
_BATCH_CHARS = 1 << 20
_HIT_ROWS = 1 << 16

_WORDS: np.ndarray | None = None


def masks_of(size: int) -> tuple[str, ...]:
    """The masks that index an item of ``size`` tokens."""
    if size >= WINDOW:
        return WINDOW_MASKS
    return SHORT_MASKS[max(least for least in SHORT_MASKS if least <= size)] if size else ()


def _word_table() -> np.ndarray:
    """Which code points belong to words."""
    global _WORDS
    if _WORDS is None:
        _WORDS = np.fromiter((chr(c).isalnum() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _WORDS


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def token_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all tokens, and the number of tokens of each text.

    Tokens are runs of letters and digits of the lower-cased text. All texts
    are hashed at once: a token's hash is the sum of its characters' hashes,
    each mixed with its place in the token.
    """
    lowered = [(t or "").lower() for t in texts]
    codes = np.frombuffer("\n".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if not len(codes):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(texts), dtype=np.int64)
    word = _word_table()[codes]
    edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    places = np.arange(len(codes)) - np.repeat(np.concatenate([[0], starts]), np.diff(np.concatenate([[0], starts, [len(codes)]])))
    chars = _mix(codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + places.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    chars[~word] = 0
    hashes = _mix(np.add.reduceat(chars, starts)) if len(starts) else np.zeros(0, dtype=np.uint64)
    sizes = np.array([len(t) + 1 for t in lowered])
    owner = np.searchsorted(np.cumsum(sizes), starts, side="right")
    return hashes, np.bincount(owner, minlength=len(texts))


def seed_hashes(tokens: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the masked window at every position (empty if too short)."""
    total = len(tokens) - len(mask) + 1
    if total <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(total, len(mask), dtype=np.uint64)
    for at, bit in enumerate(mask):
        if bit == "1":
            out = (out ^ tokens[at : at + total]) * np.uint64(0x9FB21C651E98DF25)
            out ^= out >> np.uint64(32)
    return out


def _inside(counts: np.ndarray, span: int) -> np.ndarray:
    """Positions whose window of ``span`` tokens stays in one text."""
    ends = np.repeat(np.cumsum(counts), counts)
    total = max(0, len(ends) - span + 1)
    return np.arange(total) + span <= ends[:total]


class Index:
    """Spaced seeds of some pieces of benchmark items."""

    def __init__(self, pieces: list[tuple[int, int, np.ndarray]]):
        self.items = np.array([p[0] for p in pieces], dtype=np.int64)
        self.offsets = np.array([p[1] for p in pieces], dtype=np.int64)
        self.counts = np.array([len(p[2]) for p in pieces], dtype=np.int64)
        self.tokens = np.concatenate([p[2] for p in pieces]) if pieces else np.zeros(0, dtype=np.uint64)
        self.starts = np.cumsum(self.counts) - self.counts
        self.owner = np.repeat(np.arange(len(pieces)), self.counts)
        short, long = self.counts < WINDOW, self.counts >= WINDOW
        self.short, self.long = self._seeds(short), self._seeds(long)
        seeds = [part[1] for part in self.short + self.long]
        bits = 1 << max(16, math.ceil(math.log2(16 * sum(map(len, seeds)) + 1)))
        self.low = np.uint64(bits - 1)
        self.filter = np.zeros(bits, dtype=bool)
        for part in seeds:
            self.filter[(part & self.low).astype(np.int64)] = True

    def _seeds(self, chosen: np.ndarray) -> list[tuple[str, np.ndarray, np.ndarray]]:
        """Masks of the chosen pieces with their sorted hashes and places."""
        sizes = np.unique(self.counts[chosen]).tolist()
        out = []
        for mask in dict.fromkeys(m for size in sizes for m in masks_of(size)):
            served = chosen & np.isin(self.counts, [size for size in sizes if mask in masks_of(size)])
            hashes = seed_hashes(self.tokens, mask)
            at = np.flatnonzero(_inside(self.counts, len(mask)))
            at = at[served[self.owner[at]]]
            order = at[np.argsort(hashes[at], kind="stable")]
            out.append((mask, hashes[order], order))
        return out

    def hits(self, parts, tokens: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of (document token position, index token position)."""
        for mask, seeds, at in parts:
            hashes = seed_hashes(tokens, mask)
            if not len(hashes) or not len(seeds):
                continue
            where = np.flatnonzero(self.filter[(hashes & self.low).astype(np.int64)] & _inside(counts, len(mask)))
            first = np.searchsorted(seeds, hashes[where], side="left")
            many = np.searchsorted(seeds, hashes[where], side="right") - first
            where, first, many = where[many > 0], first[many > 0], many[many > 0]
            begin = 0
            ends = np.cumsum(many)
            while begin < len(where):
                stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + _HIT_ROWS, side="right")))
                n = many[begin:stop]
                inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                yield np.repeat(where[begin:stop], n), at[np.repeat(first[begin:stop], n) + inner]
                begin = stop

    def _whole(self, tokens: np.ndarray, counts: np.ndarray) -> Iterator[tuple[tuple[int, int], tuple]]:
        """Overlaps with items shorter than a window, which are compared whole."""
        starts = np.cumsum(counts) - counts
        owner = np.repeat(np.arange(len(counts)), counts)
        need = np.array([math.ceil(SHARE * size) for size in range(WINDOW)])
        for here, there in self.hits(self.short, tokens, counts):
            text, piece = owner[here], self.owner[there]
            at = here - (there - self.starts[piece])
            fits = (at >= starts[text]) & (at + self.counts[piece] <= starts[text] + counts[text])
            text, piece, at = text[fits], piece[fits], at[fits]
            size, equal = self.counts[piece], np.zeros(len(at), dtype=np.int64)
            for k in range(int(size.max(initial=0))):
                live = np.flatnonzero(size > k)
                equal[live] += tokens[at[live] + k] == self.tokens[self.starts[piece[live]] + k]
            enough = np.flatnonzero(equal >= need[size])
            text, piece, at, size, equal = (x[enough] for x in (text, piece, at, size, equal))
            item = self.items[piece]
            order = np.lexsort((at, -equal / size, item, text))
            text, item = text[order], item[order]
            new = np.ones(len(order), dtype=bool)
            new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1])
            order, text, item = order[new], text[new], item[new]
            places = (at[order] - starts[text]).tolist()
            columns = zip(equal[order].tolist(), size[order].tolist(), places, [0] * len(order), strict=True)
            yield from zip(zip(text.tolist(), item.tolist(), strict=True), columns, strict=True)

    def overlaps(self, tokens: np.ndarray, counts: np.ndarray) -> dict[tuple[int, int], tuple]:
        """Best verified overlap of each (text, item): equal tokens, compared
        tokens, place in the text, place in the item."""
        starts = np.cumsum(counts) - counts
        owner = np.repeat(np.arange(len(counts)), counts)
        best: dict[tuple[int, int], tuple] = {}

        def keep(pair: tuple[int, int], found: tuple) -> None:
            if pair not in best or (-found[0] / found[1], *found[2:]) < (-best[pair][0] / best[pair][1], *best[pair][2:]):
                best[pair] = found

        for pair, found in self._whole(tokens, counts):
            keep(pair, found)
        for here, there in self.hits(self.long, tokens, counts):
            text, piece = owner[here], self.owner[there]
            shift = (here - starts[text]) - (there - self.starts[piece])
            # hits on one alignment within a window's reach verify the same overlap
            cell = (there - self.starts[piece]) // WINDOW
            key = np.unique(np.stack([text, piece, shift, cell]), axis=1)
            for t, p, d, c in key.T.tolist():
                low = max(0, -d, (c - 1) * WINDOW)
                high = min(int(self.counts[p]), int(counts[t]) - d, (c + 3) * WINDOW)
                size = WINDOW
                if high - low < size:
                    continue
                a = tokens[starts[t] + d + low : starts[t] + d + high]
                b = self.tokens[self.starts[p] + low : self.starts[p] + high]
                sums = np.concatenate([[0], np.cumsum(a == b)])
                equal = sums[size:] - sums[:-size]
                at = int(equal.argmax())
                if equal[at] < math.ceil(SHARE * size):
                    continue
                found = (int(equal[at]), size, int(d + low + at), int(self.offsets[p] + low + at))
                keep((t, int(self.items[p])), found)
        return best


def _blocks(benchmark: DataFrame) -> Iterator[Index]:
    """Indexes of bounded size that together hold every item.

    Items are streamed to the driver one partition at a time; long ones are
    cut into pieces that overlap by a window.
    """
    held, size = [], 0
    for row in benchmark.select("item_id", "text").filter("item_id is not null and text is not null").toLocalIterator():
        tokens, _ = token_hashes([row["text"]])
        for at in range(0, max(1, len(tokens) - WINDOW), PIECE_TOKENS):
            piece = tokens[at : at + PIECE_TOKENS + WINDOW]
            held.append((row["item_id"], at, piece))
            size += len(piece)
            if size >= BLOCK_TOKENS:
                yield Index(held)
                held, size = [], 0
    if held:
        yield Index(held)


def _search(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Overlaps of every row, some of them repeated. The last column of ``docs``
    is the text; those before, longs, name the row."""
    spark = docs.sparkSession
    keys = docs.columns[:-1]
    schema = "item_id long, equal_tokens int, compared_tokens int, doc_token long, item_token long"
    schema = ", ".join([*(f"{key} long" for key in keys), schema])
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = [*(pa.int64() for _ in keys), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    found = spark.createDataFrame([], schema)
    for index in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                *ids, texts = (column.to_pylist() for column in batch.columns)
                ids = list(zip(*ids, strict=True))
                begin, rows = 0, []
                while begin < len(texts):
                    stop, chars = begin, 0
                    while stop < len(texts) and (stop == begin or chars + len(texts[stop] or "") <= _BATCH_CHARS):
                        chars += len(texts[stop] or "")
                        stop += 1
                    tokens, counts = token_hashes(texts[begin:stop])
                    best = shared.value.overlaps(tokens, counts)
                    rows += [(*ids[begin + t], item, *what) for (t, item), what in sorted(best.items())]
                    begin = stop
                columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names
                )

        found = found.unionByName(map_arrow(docs, run, schema))
    return found


def find_overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Contaminated pairs: ``doc_id, item_id, equal_tokens, compared_tokens,
    doc_token, item_token`` (the best window's places), one row per pair.

    Items of any length are found; one shorter than a window must agree whole
    (exactly up to four tokens). A token is a run of letters and digits, so
    text without spaces is one token a clause. Null texts, texts without a
    token and null item ids are skipped; repeated
    rows of one doc_id are reported once; rows with a null doc_id are
    searched and reported under null. Whole documents and whole items are
    used. Either table empty gives no rows; other columns are ignored.
    """
    found = _search(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark)
    order = F.struct(
        (F.col("equal_tokens") / F.col("compared_tokens")).alias("share"),
        (-F.col("doc_token")).alias("doc"),
        (-F.col("item_token")).alias("item"),
        "equal_tokens",
        "compared_tokens",
    )
    return (
        found.groupBy("doc_id", "item_id")
        .agg(F.max(order).alias("best"))
        .select(
            "doc_id",
            "item_id",
            "best.equal_tokens",
            "best.compared_tokens",
            (-F.col("best.doc")).alias("doc_token"),
            (-F.col("best.item")).alias("item_token"),
        )
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, whole_ids: bool = True) -> DataFrame:
    """``docs`` without the documents that overlap a benchmark item; all
    columns as they are.

    With ``whole_ids`` an id that has a contaminated row goes with all its
    rows; without, only the rows whose own text is contaminated go. Rows with
    a null doc_id are always decided one by one.
    """
    own = F.xxhash64("text")
    if whole_ids:
        own = F.when(F.col("doc_id").isNull(), own).otherwise(F.lit(0).cast("long"))
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), own.alias("_text"), "text")
    # written first: the planner sees how few rows it is, so documents need no shuffle
    hits = save(_search(rows, benchmark).select("_id", "_text").distinct(), "contaminated")
    hit_id, hit_text = unused(docs, "_id"), unused(docs, "_text")
    hits = hits.toDF(hit_id, hit_text)
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(hit_id)) & (own == F.col(hit_text))
    return docs.join(hits, same, "left_anti")
