from __future__ import annotations

import functools
import itertools
import math
import random

import numpy as np

from strata.llm import decontam
from tests.llm.conftest import docs_of, frame

BENCH = "item_id long, text string, extra string"


def tokens(text):
    out, word = [], ""
    for c in (text or "").lower() + " ":
        if c.isalnum():
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


NUMBERS: dict[str, int] = {}


@functools.cache
def coded(text):
    return np.array([NUMBERS.setdefault(w, len(NUMBERS)) for w in tokens(text)], dtype=np.int64)


def overlaps(doc, item):
    """Every alignment and window. Items shorter than a window also need a
    seed on the alignment; longer ones must be found without regard to seeds."""
    a, b = coded(doc), coded(item)
    size = min(decontam.WINDOW, len(b))
    need = math.ceil(decontam.SHARE * size)
    for shift in range(-len(b), len(a)) if size else ():
        low, high = max(0, -shift), min(len(b), len(a) - shift)
        equal = a[low + shift : high + shift] == b[low:high]
        if equal.sum() < need:
            continue
        seeded = size == decontam.WINDOW or any(
            all(equal[k + i] for i, bit in enumerate(mask) if bit == "1")
            for mask in decontam.MASKS
            for k in range(len(equal) - len(mask) + 1)
        )
        if seeded and any(equal[k : k + size].sum() >= need for k in range(len(equal) - size + 1)):
            return True
    return False


def test_masks_are_lossless():
    for gone in itertools.combinations(range(decontam.WINDOW), 2):
        assert any(
            not {k + i for i, bit in enumerate(mask) if bit == "1"} & set(gone)
            for mask in decontam.MASKS
            for k in range(decontam.WINDOW - len(mask) + 1)
        ), gone


def test_token_hashes_follow_tokens():
    texts = ["One, two three", None, "", "two-THREE", "ünï 日本 x1", "!!", "a\nb"]
    hashes, counts = decontam.token_hashes(texts)
    assert counts.tolist() == [len(tokens(t)) for t in texts]
    flat = [w for t in texts for w in tokens(t)]
    same = {}
    for word, value in zip(flat, hashes.tolist(), strict=True):
        assert same.setdefault(word, value) == value
    assert len(set(same.values())) == len(same)


def test_matches_brute_force(spark):
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(40)]
    items = [" ".join(rng.choices(vocabulary, k=rng.choice([5, 8, 10, 14, 30]))) for _ in range(25)]
    docs = []
    for k in range(120):
        words = rng.choices(vocabulary, k=rng.randrange(60))
        if k % 2:
            part = rng.choice(items).split()
            part = [rng.choice(vocabulary) if rng.random() < 0.1 * (k % 3) else w for w in part]
            at = rng.randrange(len(words) + 1)
            words[at:at] = part
        docs.append(", ".join(words).title())
    bench = frame(spark, [(k, t, "x") for k, t in enumerate(items)], BENCH)
    got = {(r.doc_id, r.item_id) for r in decontam.find_overlaps(docs_of(spark, docs), bench).collect()}
    want = {(d, i) for d, doc in enumerate(docs) for i, item in enumerate(items) if overlaps(doc, item)}
    assert got == want and len(got) > 40


def test_blocks_and_pieces(spark, monkeypatch):
    rng = random.Random(2)
    long_item = " ".join(f"t{rng.randrange(10**6)}" for _ in range(300))
    words = long_item.split()
    docs = docs_of(spark, [" ".join(words[k : k + 20]) for k in range(0, 280, 7)])
    bench = frame(spark, [(1, long_item, "x"), (2, "short item " * 10, "x")], BENCH)
    want = sorted(tuple(r) for r in decontam.find_overlaps(docs, bench).collect())
    assert len(want) == 40
    monkeypatch.setattr(decontam, "PIECE_TOKENS", 32)
    monkeypatch.setattr(decontam, "BLOCK_TOKENS", 64)
    got = sorted(tuple(r) for r in decontam.find_overlaps(docs, bench).collect())
    assert [r[:4] for r in got] == [r[:4] for r in want]


def test_edges(spark, edge_docs, no_docs):
    bench = frame(
        spark,
        [(1, None, "x"), (2, "", "x"), (None, "one two three four five", "x"), (3, "no id here at all " * 3, "x"), (4, "word5 and more word6 and more word7 and more word8 and", "x")],
        BENCH,
    )
    got = decontam.find_overlaps(edge_docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(7, 4)}
    assert decontam.find_overlaps(no_docs, bench).count() == 0
    assert decontam.find_overlaps(edge_docs, bench.limit(0)).count() == 0
    kept = decontam.decontaminate(edge_docs, bench)
    assert kept.columns == edge_docs.columns
    assert kept.filter("doc_id = 7").count() == 0 and kept.filter("doc_id is null").count() == 1


def test_repeated_words_stay_bounded(spark):
    text = "the " * 5000
    docs, bench = docs_of(spark, [text]), frame(spark, [(1, "the " * 50, "x")], BENCH)
    assert decontam.find_overlaps(docs, bench).count() == 1
    assert decontam.seed_hashes(np.zeros(3, dtype=np.uint64), "11111111").size == 0


def test_short_items_survive_every_allowed_substitution():
    for size in range(1, decontam.WINDOW + 1):
        item = np.arange(1, size + 1, dtype=np.uint64)
        index = decontam.Index([(5, 0, item)])
        allowed = size - math.ceil(decontam.SHARE * size)
        for gone in (g for n in range(size + 1) for g in itertools.combinations(range(size), n) if n <= allowed + 1):
            text = np.concatenate([[90, 91], item, [92]]).astype(np.uint64)
            text[[2 + k for k in gone]] = 99
            found = index.overlaps(text, np.array([len(text)]))
            want = {(0, 5): (size - len(gone), size, 2, 0)} if len(gone) <= allowed else {}
            assert found == want, (size, gone)


def test_short_items_match_brute_force_without_seeds(spark):
    rng = random.Random(5)
    vocabulary = [f"v{k}" for k in range(9)]
    items = [" ".join(rng.choices(vocabulary, k=1 + k % 14)) for k in range(56)]
    docs = [" ".join(rng.choices(vocabulary, k=rng.randrange(40))) for _ in range(150)]
    docs += ["今日は晴れ、明日は雨。", "plain"]
    for k in range(56):  # with up to three words exchanged
        part = items[k].split()
        for at in rng.sample(range(len(part)), min(len(part) - 1, k % 4)):
            part[at] = "other"
        docs.append(" ".join(["start", *part, "end"]))
    items += ["明日は雨", "plain text"]

    def plain(doc, item):
        a, b = coded(doc), coded(item)
        size = min(decontam.WINDOW, len(b))
        return any(
            (a[i : i + size] == b[j : j + size]).sum() >= math.ceil(decontam.SHARE * size)
            for i in range(len(a) - size + 1)
            for j in range(len(b) - size + 1)
        )

    bench = frame(spark, [(k, t, "x") for k, t in enumerate(items)], BENCH)
    got = {(r.doc_id, r.item_id) for r in decontam.find_overlaps(docs_of(spark, docs), bench).collect()}
    assert got == {(d, i) for d, doc in enumerate(docs) for i, item in enumerate(items) if plain(doc, item)}
    assert (150, 56) in got and len({len(coded(items[i])) for _, i in got}) >= 10


def test_contamination_is_decided_by_row(spark):
    passage = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    rows = [(7, f"see {passage} here"), (7, "a clean text"), (None, passage), (None, "a clean text"), (8, passage), (9, None), (None, None)]
    docs = frame(spark, [(k, t, "en", "s", 0) for k, t in rows])
    bench = frame(spark, [(1, passage, "x")], BENCH)
    kept = decontam.decontaminate(docs, bench, whole_ids=False).collect()
    clean = [(7, "a clean text"), (9, None), (None, None), (None, "a clean text")]
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted(clean, key=str)
    kept = decontam.decontaminate(docs, bench).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted(clean[1:], key=str)
