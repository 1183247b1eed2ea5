"""SimHash near-duplicate groups with pigeonring candidate filtering.

Fingerprint: XXH64 (seed 42) of every word shingle, repeats included; a bit
is set when it is set in more than half of the hashes.

Candidates: the 64 bits form a ring of ``SEGMENTS`` segments. By the
pigeonring principle, two fingerprints that differ in at most ``t`` bits have
a segment from which every chain of ``l`` consecutive segments differs in at
most ``l * t / SEGMENTS`` bits. With two bits and three segments the budgets
are 0, 1 and 2, so a chain starts with an equal segment, the next one differs
in at most one bit, and the third step is the whole Hamming check. Chains of
length two become join keys: the first segment as it is and the second with
one bit masked out, one key per bit of the ring, 64 per *distinct*
fingerprint. No bucket holds more than the fingerprints that agree on 41
bits, so a group of many copies makes one row and near copies spread out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import located, map_arrow, numbered, repeated_rows, save, unused
from strata.llm.components import connected_components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: Bits of the three segments, lowest first.
SEGMENTS = ((0, 22), (22, 43), (43, 64))
#: Longer runs of one key are linked through shared one-bit neighbours.
PAIRWISE_RUN = 128
_CHUNK = 1 << 16
_FLIPS = np.concatenate([np.zeros(1, dtype=np.uint64), np.uint64(1) << np.arange(64, dtype=np.uint64)])


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of one whole text; 0 without words (or null)."""
    words = text.encode().lower().split() if text else []  # bytes: only A-Z and ASCII white space count
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    total = len(words) - shingle + 1
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, total, _CHUNK):
        part = words[at : at + _CHUNK + shingle - 1]
        grams = map(b" ".join, zip(*(part[k:] for k in range(shingle)), strict=False))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    ones = np.flatnonzero(2 * counts > total)
    return sum(1 << int(k) for k in ones)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp)``: one row per document, ``fp`` the signed 64-bit view."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(texts, run, "doc_id long, fp long")


def _mask(start: int, end: int) -> int:
    return ((1 << end) - 1) ^ ((1 << start) - 1)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def chain_masks() -> list[int]:
    """For every bit of the ring the key's mask: the segment before the bit's
    own, and the bit's segment without that bit."""
    masks = []
    for k, (start, end) in enumerate(SEGMENTS):
        chain = _mask(*SEGMENTS[k - 1]) | _mask(start, end)
        masks += [chain & ~(1 << bit) for bit in range(start, end)]
    return masks


def _spread_labels(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """Smallest reachable index for each of ``n`` nodes."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _link(keys: np.ndarray, bits: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between fingerprints of equal keys, at most one per fingerprint.

    Pairs are compared inside the task and reduced to a spanning set before
    anything is emitted, so the output is linear in the input rows.
    """
    cut = np.flatnonzero((keys[1:] != keys[:-1]) | (bits[1:] != bits[:-1])) + 1
    starts = np.concatenate([[0], cut])
    lengths = np.diff(np.concatenate([starts, [len(fps)]]))
    run = np.repeat(np.arange(len(starts)), lengths)
    empty = np.empty(0, dtype=np.int64)
    left, right, hub_of, near = [empty], [empty], [empty], [np.empty(0, dtype=np.uint64)]
    alive = np.flatnonzero((lengths[run] > 1) & (lengths[run] <= PAIRWISE_RUN))
    for shift in range(1, int(lengths[lengths <= PAIRWISE_RUN].max(initial=0))):
        alive = alive[alive + shift < len(fps)]
        alive = alive[run[alive] == run[alive + shift]]
        close = alive[np.bitwise_count(fps[alive] ^ fps[alive + shift]) <= MAX_BITS]
        left.append(close)
        right.append(close + shift)
    for r in np.flatnonzero(lengths > PAIRWISE_RUN):
        # two fingerprints within two bits share a value one flip away from both
        members = np.arange(starts[r], starts[r] + lengths[r])
        for flip in _FLIPS:
            hub_of.append(members)
            near.append(fps[members] ^ flip)
    values, at = np.unique(fps, return_inverse=True)
    hubs, hub = np.unique(np.concatenate(near), return_inverse=True)
    label = _spread_labels(
        at[np.concatenate(left + hub_of)],
        np.concatenate([at[np.concatenate(right)], len(values) + hub]),
        len(values) + len(hubs),
    )[: len(values)]
    moved = np.flatnonzero(label != np.arange(len(values)))
    return values[moved], values[label[moved]]


def _linker(rows: int = 1 << 18):
    """Link runs of equal keys in batches sorted by key; a run that crosses
    batches is carried over (it holds fingerprints that agree on 41 bits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        count = 0

        def emit(parts):
            a, b = _link(*parts)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            key, bit, fp = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            held.append((key, bit, fp.view(np.uint64)))
            count += len(key)
            if count < rows:
                continue
            parts = [np.concatenate(x) for x in zip(*held, strict=True)]
            last = np.flatnonzero((parts[0] != parts[0][-1]) | (parts[1] != parts[1][-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield emit([x[:cut] for x in parts])
            held, count = [tuple(x[cut:] for x in parts)], len(parts[0]) - cut
        if count:
            yield emit([np.concatenate(x) for x in zip(*held, strict=True)])

    return run


def links(fps: DataFrame) -> DataFrame:
    """Spanning links ``(a, b)`` between the distinct fingerprints of ``fps(fp)``
    that differ in at most ``MAX_BITS`` bits."""
    masked = F.array(*(F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in chain_masks()))
    keyed = fps.select(F.posexplode(masked).alias("bit", "key"), "fp")
    dealt = keyed.select("key", "bit", "fp").repartition("key", "bit").sortWithinPartitions("key", "bit", "fp")
    return map_arrow(dealt, _linker(), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, *, shingle: int = SHINGLE) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint`` (16 hex
    digits), ``component_id`` (smallest doc_id reachable over links).

    Null, empty and blank texts have fingerprint zero and link like any other;
    texts shorter than a shingle hash their whole word sequence. Rows with a
    null doc_id are grouped too, but never name a group unless it has no other
    id (then null). Repeated rows stay repeated. An empty table gives no rows.
    Other columns of ``docs`` are ignored.
    """
    prints = save(fingerprints(docs, shingle), "fingerprints")
    distinct = save(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    roots = connected_components(links(distinct.select("fp")))
    member = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("root")
    )
    named = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = member.join(named, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def deduplicate(docs: DataFrame, *, shingle: int = SHINGLE, stored: bool = False) -> DataFrame:
    """``docs`` with one row of every group; all columns as they are.

    Groups are decided by text, row by row: it is the row of the smallest
    doc_id that stays, and a row without one only if the group has no other.
    Among rows of one id (or none) the least hash of the text decides, then
    that of all columns; of rows equal in everything any one stays.

    ``stored``: ``docs`` is read from files, so that a row is known by its file
    and its place in it, and the texts need not be saved once more.
    """
    if stored:
        rows, row = located(docs)
    else:
        rows, number = numbered(docs)
        row = [number]
    hashed = [f.name for f in docs.schema if "map<" not in f.dataType.simpleString()]
    at = ["_file", "_row"][-len(row) :]
    marked = rows.select(
        F.col("doc_id").cast("long").alias("id"),
        F.xxhash64("text").alias("text_hash"),
        F.xxhash64(*hashed).alias("row_hash"),
        *[F.col(c).alias(name) for c, name in zip(row, at, strict=True)],
        "text",
    )
    names = ["id", "text_hash", "row_hash", *at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *known, texts = batch.columns
            fps = np.array([fingerprint(t.as_py(), shingle) for t in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*known, pa.array(fps.view(np.int64))], [*names, "fp"])

    schema = ", ".join(f"{c} {'string' if c == '_file' else 'long'}" for c in [*names, "fp"])
    prints = map_arrow(marked, run, schema)
    order = F.struct(F.col("id").isNull().alias("nameless"), *names)
    first = save(prints.groupBy("fp").agg(F.min(order).alias("first")), "first-rows")
    roots = connected_components(links(first.select("fp")))
    kept = (
        first.join(roots, first.fp == roots.node, "left")
        .groupBy(F.coalesce("component", "fp").alias("root"))
        .agg(F.min("first").alias("first"))
        .select(*[F.col(f"first.{c}").alias(c) for c in at])
    )
    return _marked_rows(rows, row, kept).select(docs.columns)


def _marked_rows(rows: DataFrame, row: str | list[str], kept: DataFrame) -> DataFrame:
    """The rows of ``rows`` whose place in ``row`` is among ``kept(_row)``, or
    ``kept(_file, _row)``."""
    row = [row] if isinstance(row, str) else row
    times = unused(rows, "_times")
    marks = kept.select(*[F.col(k).alias(c) for k, c in zip(kept.columns, row, strict=True)], F.lit(1).alias(times))
    return repeated_rows(rows, row, marks, times, 1).drop(times)
