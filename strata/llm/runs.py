"""Periodic runs of words, found by uniting suffix classes in order of
descending longest common prefix (LCP).

A run is a stretch with smallest period ``q`` that no neighbouring word
extends. Suffixes that share at least ``l`` words form a class; going down
from the greatest LCP, the edges between neighbouring suffixes unite classes
as Kruskal's algorithm does, and every class keeps its positions in order.
When two classes meet at LCP ``l``, positions that become neighbours at a
distance of at most ``l`` seed a run: they repeat the ``l`` words at that
distance, and a smaller period would have put a position between them before.
Exactly one seed of a run is its start, the one whose words before differ.

Before that, words that can be in no run are set aside, without loss: inside
a long enough run every ``gram`` of consecutive words comes twice in the
document, so only stretches of repeated grams get suffixes at all.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import WORD, map_arrow, word_count

#: Words worked on together; a longer text is a group of its own.
GROUP_WORDS = 1 << 18
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_MIX = np.uint64(0x9E3779B97F4A7C15)


def gram_length(least: int, times: int) -> int:
    """Words of a gram such that every gram inside a run of at least ``least``
    words and ``times`` periods comes twice in it."""
    return max(1, min(max(least, times * q) - 2 * q + 1 for q in range(1, least + 1)))


def _repeating(words: np.ndarray, text: np.ndarray, gram: int) -> np.ndarray:
    """Which words lie in a gram that their text holds twice (equal hashes
    of different grams only keep more words)."""
    keep = np.zeros(len(words), dtype=bool)
    size = len(words) - gram + 1
    if size < 2:
        return keep
    mixed = text[:size].astype(np.uint64)
    for k in range(gram):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX + words[k : k + size].astype(np.uint64)
    at = np.flatnonzero(text[:size] == text[gram - 1 :])
    if len(at) < 2:
        return keep
    order = at[np.argsort(mixed[at], kind="stable")]
    equal = mixed[order[1:]] == mixed[order[:-1]]
    repeated = order[np.concatenate([[False], equal]) | np.concatenate([equal, [False]])]
    for k in range(gram):
        keep[repeated + k] = True
    return keep


def _ranks(symbols: np.ndarray) -> list[np.ndarray]:
    """Ranks of the stretches of 1, 2, 4, ... symbols from every position, up to
    the first length at which all differ (the end sorts first)."""
    levels, width, n = [symbols.astype(np.int64)], 1, len(symbols)
    while levels[-1].max() + 1 < n:
        after = np.zeros(n, dtype=np.int64)
        after[:-width] = levels[-1][width:] + 1
        key = levels[-1] * (n + 1) + after
        levels.append(np.unique(key, return_inverse=True)[1].reshape(-1))
        width *= 2
    return [x.astype(np.int32) for x in levels]


def _edges(symbols: np.ndarray, least: int) -> tuple[list[int], list[int], list[int]]:
    """Neighbours in suffix order with an LCP of at least ``least``, greatest first."""
    levels = _ranks(symbols)
    n = len(symbols)
    order = np.empty(n, dtype=np.int64)
    order[levels[-1]] = np.arange(n)
    left, right, lcp = order[:-1], order[1:], np.zeros(n - 1, dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        a, b = left + lcp, right + lcp
        inside = np.flatnonzero(np.maximum(a, b) < n)
        same = inside[levels[k][a[inside]] == levels[k][b[inside]]]
        lcp[same] += 1 << k
    long = np.flatnonzero(lcp >= least)
    long = long[np.argsort(-lcp[long], kind="stable")]
    return left[long].tolist(), right[long].tolist(), lcp[long].tolist()


def _seeds(symbols: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """``(i, j, l)``: positions that become neighbours of one class at LCP ``l``,
    at a distance of at most ``l``."""
    home = list(range(len(symbols)))
    members: dict[int, list[int]] = {}
    for a, b, l in zip(*_edges(symbols, least), strict=True):
        small, large = home[a], home[b]
        few, many = members.get(small) or [small], members.get(large) or [large]
        if len(few) > len(many):
            small, large, few, many = large, small, many, few
        previous = -1
        for k, x in enumerate(few):
            home[x] = large
            at = bisect_left(many, x)
            if at and many[at - 1] > previous and x - many[at - 1] <= l:
                yield many[at - 1], x, l
            following = few[k + 1] if k + 1 < len(few) else len(home)
            if at < len(many) and many[at] < following and many[at] - x <= l:
                yield x, many[at], l
            previous = x
        if 16 * len(few) > len(many):
            many += few
            many.sort()
        else:
            for x in few:
                insort(many, x)
        members.pop(small, None)
        members[large] = many


def runs_of(words: np.ndarray, text: np.ndarray, least: int, times: int) -> np.ndarray:
    """Rows ``(start, length, period)`` in order of start and period.

    ``words``: numbers of the words of several texts one after another;
    ``text``: which text each belongs to (ascending). No run crosses texts.
    """
    kept = np.flatnonzero(_repeating(words, text, gram_length(least, times)))
    if not len(kept):
        return np.empty((0, 3), dtype=np.int64)
    # Stretches of kept words; equal words of different stretches are told apart.
    new = np.concatenate([[True], (np.diff(kept) > 1) | (np.diff(text[kept]) > 0)])
    stretch = np.cumsum(new) - 1
    symbols = np.unique(stretch * (int(words.max()) + 1) + words[kept], return_inverse=True)[1].reshape(-1)
    shortest = min(max(least - q, (times - 1) * q) for q in range(1, least + 1))
    found = [
        (i, j - i + l, j - i)
        for i, j, l in _seeds(symbols, shortest)
        if j - i + l >= max(least, times * (j - i)) and (not i or symbols[i - 1] != symbols[j - 1])
    ]
    out = np.array(sorted((i, q, n) for i, n, q in found), dtype=np.int64).reshape(-1, 3)[:, [0, 2, 1]]
    out[:, 0] = kept[out[:, 0]]
    return out


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _group(ids: list, texts: list[list[bytes]], least: int, times: int) -> pa.RecordBatch:
    numbers = _Numbers()
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    words = np.fromiter((numbers[w] for t in texts for w in t), dtype=np.int64, count=int(sizes.sum()))
    text = np.repeat(np.arange(len(texts)), sizes)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    runs = runs_of(words, text, least, times)
    owner = text[runs[:, 0]] if len(runs) else np.empty(0, dtype=np.int64)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    dropped = np.cumsum(change)[:-1] > 0
    collapsed = []
    for k, t in enumerate(texts):
        gone = dropped[begins[k] : begins[k + 1]]
        collapsed.append(b" ".join(t if not gone.any() else [w for w, g in zip(t, gone, strict=True) if not g]))
    offsets = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
    columns = [runs[:, 0] - begins[owner], runs[:, 1], runs[:, 2]]
    structs = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=list(RUN))
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(sizes), pa.ListArray.from_arrays(pa.array(offsets), structs),
         pa.array([c.decode() for c in collapsed], pa.string())],
        ["doc_id", "words", "runs", "collapsed"],
    )


def find_runs(docs: DataFrame, *, least: int = 6, times: int = 4) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``words`` (their number),
    ``runs`` (array of ``start, length, period``, by start and period) and
    ``collapsed``, the text without words that a run holds after its first
    period, joined by one space.

    Runs have at least ``least`` words and ``times`` (two or more) periods. Null and
    empty texts have no words and collapse to the empty string. Null ids and
    repeated rows are kept, other columns ignored; an empty table gives no
    rows. A text is held whole in its task, at a few hundred bytes a word of
    those stretches that repeat.
    """
    if least < 2 or times < 2:
        raise ValueError("a run has at least two words and two periods")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, held = [], [], 0
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = (value.as_py() or "").encode().split()  # bytes: only ASCII white space splits
                if texts and held + len(words) > GROUP_WORDS:
                    yield _group(ids, texts, least, times)
                    ids, texts, held = [], [], 0
                ids.append(doc_id)
                texts.append(words)
                held += len(words)
            if texts:
                yield _group(ids, texts, least, times)

    return map_arrow(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
        run,
        "doc_id long, words long, runs array<struct<start:long,length:long,period:long>>, collapsed string",
    )


def planted(text: Column, doc_id: Column) -> Column:
    """The query's text: in one document of ten (by the id's checksum) the words
    from a place on are replaced by repetitions of the first of them."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        begin = (g % n).cast("int")
        period = (1 + F.floor((n - begin) / (3 + g % 8))).cast("int")
        copies = F.flatten(F.array_repeat(F.slice(words, begin + 1, period), F.ceil((n - begin) / period).cast("int")))
        return F.array_join(F.concat(F.slice(words, 1, begin), F.slice(copies, 1, (n - begin).cast("int"))), " ")

    # an array of one, so that the words are found once and then named
    words = F.array(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    return F.when((h % 10 == 0) & (word_count(text) > 0), F.element_at(F.transform(words, repeated), 1)).otherwise(text)


def digests(found: DataFrame) -> DataFrame:
    """``found`` of :func:`find_runs` as counts, the longest run and digests."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("n"), (-r.start).alias("s"), (-r.period).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start.cast("string"), r.length.cast("string"), r.period.cast("string")))
    return found.withColumn("_best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_best.s")).alias("start"),
        F.col("_best.n").alias("length"),
        (-F.col("_best.p")).alias("period"),
        F.floor(1000 * F.col("_best.n") / -F.col("_best.p")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
