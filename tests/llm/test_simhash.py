from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from tests.llm.conftest import docs_of

from strata.llm import simhash


def plain_fingerprint(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints, most=2):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= most:
                parent[find(i)] = find(j)
    least = {}
    for k, x in enumerate(ids):
        least[find(k)] = min(least.get(find(k), x), x)
    return {x: least[find(k)] for k, x in enumerate(ids)}


def near_texts(rng, n):
    """Groups of long texts whose members differ in one word."""
    out = []
    for _ in range(n):
        words = [rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(rng.randrange(50)) for _ in range(300)]
        for k in range(4):
            changed = list(words)
            changed[rng.randrange(300)] = f"x{k}"
            out.append(" ".join(changed))
        out.append(" ".join(words).upper())
    return out


def test_matches_all_pairs(spark):
    texts = near_texts(random.Random(5), 12) + ["", None, "one two", "one  two", "A b C d"]
    got = {r.doc_id: r for r in simhash.near_duplicates(docs_of(spark, texts)).collect()}
    prints = [plain_fingerprint(t) for t in texts]
    assert [int(got[k].fingerprint, 16) for k in range(len(texts))] == prints
    want = plain_components(list(range(len(texts))), prints)
    assert {k: r.component_id for k, r in got.items()} == want
    assert len(set(want.values())) < len(set(prints))  # there are links between different texts


def test_chain_keys_meet_for_all_pairs_within_two_bits():
    rng = random.Random(7)
    masks = simhash.chain_masks()
    assert len(masks) == 64
    for _ in range(2000):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randrange(3)):
            b ^= 1 << bit
        assert any(a & m == b & m for m in masks)


def test_long_runs_link_like_short_ones(monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, size=6, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, size=(6, 40), dtype=np.uint64)
    fps = np.unique((base[:, None] ^ flips).ravel())
    keys, bits = np.zeros(len(fps), dtype=np.int64), np.zeros(len(fps), dtype=np.int32)

    def groups():
        a, b = simhash._link(keys, bits, fps)
        root = {int(x): int(x) for x in fps} | dict(zip(a.tolist(), b.tolist(), strict=True))
        return root

    by_neighbours = groups()  # longer than PAIRWISE_RUN
    monkeypatch.setattr(simhash, "PAIRWISE_RUN", 10_000)
    assert by_neighbours == groups()
    want = plain_components([int(x) for x in fps], [int(x) for x in fps])
    assert by_neighbours == want


def test_runs_across_batches():
    import pyarrow as pa

    fps = np.arange(100, dtype=np.int64) * 3
    batch = [
        pa.RecordBatch.from_arrays([pa.array(np.repeat(k // 50, 10)), pa.array(np.zeros(10, dtype=np.int32)), pa.array(fps[k : k + 10])], ["key", "bit", "fp"])
        for k in range(0, 100, 10)
    ]
    def roots(rows):
        out = {}
        for x in simhash._linker(rows)(iter(batch)):
            out |= dict(zip(x.column(0).to_pylist(), x.column(1).to_pylist(), strict=True))
        return out

    assert roots(25) == roots(10_000)


def test_edges(spark, edge_docs, no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
    got = simhash.near_duplicates(edge_docs).collect()
    assert len(got) == edge_docs.count()
    zero = {r.doc_id for r in got if r.fingerprint == "0" * 16}
    assert zero == {1, 2, 3}
    by_id = {(r.doc_id, r.fingerprint): r.component_id for r in got}
    assert {by_id[k] for k in by_id if k[0] in (1, 2, 3)} == {1}
    assert {by_id[k] for k in by_id if k[0] in (5, 6)} == {5}
    assert [r.component_id for r in got if r.doc_id is None] == [None]


def test_deduplicate(edge_docs, no_docs):
    kept = simhash.deduplicate(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    assert [i for _, i in ids] == [1, 4, 5, 7, 7, 8, 9, 0]
    assert simhash.deduplicate(no_docs).count() == 0


def test_deduplicate_decides_by_row(spark):
    from tests.llm.conftest import frame

    a, b, c = ("alpha beta gamma delta", "one two three four", "red green blue white")
    rows = [(None, a, "en", "s", 0)] * 3 + [(None, b, "en", "x", 0), (None, b, "en", "y", 0), (2, b, "en", "s", 0), (2, c, "en", "s", 0), (1, c, "en", "s", 0)]
    kept = simhash.deduplicate(frame(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == [(0, a), (1, c), (2, b)]
    nameless = frame(spark, [(None, b, "en", k, 0) for k in "xyz"])
    assert simhash.deduplicate(nameless).collect() == simhash.deduplicate(nameless.orderBy("source", ascending=False)).collect()


def test_rows_that_stay_are_marked_in_bitmaps_and_texts_are_not_shuffled(spark):
    from pyspark.sql import functions as F

    docs = spark.range(0, 70_000, 1, 3).select(F.col("id").alias("doc_id"), F.lit("text").alias("_bits"))
    rows, row = simhash.numbered(docs)
    kept = rows.filter("doc_id % 7 in (0, 3) or doc_id > 60000").select(F.col(row).alias("_row"))
    found = simhash._marked_rows(rows, row, kept)
    assert found.columns == rows.columns
    want = [k for k in range(70_000) if k % 7 in (0, 3) or k > 60_000]
    assert sorted(r.doc_id for r in found.collect()) == want
    plan = found._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert simhash._marked_rows(rows, row, kept.limit(0)).count() == 0


def test_stored_documents_are_deduplicated_without_saving_texts(spark, edge_docs, tmp_path, monkeypatch):
    path = str(tmp_path / "docs")
    edge_docs.repartition(3).write.parquet(path)
    monkeypatch.setattr(simhash, "numbered", lambda df: pytest.fail("the texts were saved once more"))
    kept = simhash.deduplicate(spark.read.parquet(path), stored=True)
    assert kept.columns == edge_docs.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    assert [i for _, i in ids] == [1, 4, 5, 7, 7, 8, 9, 0]
