from __future__ import annotations

import math
import re
from collections import Counter

from strata.llm import lexical
from strata.llm.common import table
from strata.llm.queries import op12_lexical_search
from tests.llm.conftest import docs_of, frame

SF = "/root/testdata/sf0.001"
ITEMS = "item_id long, text string"
_UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(_UPPER))


def plain_search(docs, items, best=50):
    """Every document's whole score for every item."""
    counts = [(doc_id, Counter(plain_terms(text))) for doc_id, text in docs]
    counts = [(d, c, sum(c.values())) for d, c in counts if c]
    number, words = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    wanted = {}
    for item_id, text in items:
        wanted.setdefault(item_id, set()).update(plain_terms(text))
    out = []
    for item_id, terms in wanted.items():
        scored = []
        for doc_id, c, n in counts:
            m = 100 - 50 + 50 * n * number // words
            score = sum(
                math.floor(1000 * math.log((2 * number + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m))
                for t in terms
                if t in c
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, k + 1, None if none else d, -s) for k, (s, none, d) in enumerate(sorted(scored)[:best])]
    return sorted(out, key=str)


def rows_of(found):
    return sorted(map(tuple, found.collect()), key=str)


def pairs(df):
    return [tuple(r) for r in df.select(df.columns[0], "text").collect()]


def test_query_equals_plain_scores(spark):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    assert rows_of(op12_lexical_search(spark, SF)) == plain_search(pairs(docs), pairs(items))


def test_many_blocks_and_bundles(spark, monkeypatch):
    docs = table(spark, SF, "documents").repartition(7)
    items = table(spark, SF, "benchmark")
    monkeypatch.setattr(lexical, "BUNDLE_ITEMS", 9)
    assert rows_of(lexical.search(docs, items, best=5)) == plain_search(pairs(docs), pairs(items), 5)


def test_blocks_end_at_their_bounds(monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", 3)
    block = lexical._Block()
    wanted = b"\x01" * lexical.FILTER_BITS
    for k in range(3):
        assert not block.full
        block.add(k, lexical.terms_of("One two TWO é2"), wanted)
    assert block.full
    rows = block.rows(5).to_pylist()
    assert rows[0] == {"block": 5, "term": None, "docs": None, "counts": [4, 4, 4], "ids": [0, 1, 2], "df": 3, "total": 12}
    assert {r["term"]: r["counts"] for r in rows[1:]} == {"one": [1] * 3, "two": [2] * 3, "é2": [1] * 3}


def test_letting_go_loses_no_result(spark):
    """Hundreds of documents hold a rare term, so bars are set early; documents
    that only common terms lift must still come out."""
    texts = [f"common w{k % 40} rare{k % 3}" for k in range(400)] + ["common common common w1 w2 w3"] * 30 + ["common"] * 300
    docs = docs_of(spark, texts).repartition(2)
    items = frame(spark, [(1, "rare1 common w1 w2 w3"), (2, "common"), (3, "w7 w8 rare0"), (4, "absent")], ITEMS)
    assert rows_of(lexical.search(docs, items, best=5)) == plain_search(pairs(docs), pairs(items), 5)


def test_edges(spark, edge_docs, no_docs):
    items = frame(spark, [(1, "one TWO five"), (1, "Three"), (None, "id text"), (None, "été"), (3, None), (4, " !"), (5, "one two")], ITEMS)
    found = lexical.search(edge_docs, items)
    assert rows_of(found) == plain_search(pairs(edge_docs), pairs(items))
    ranks = [(r.item_id, r["rank"]) for r in found.collect()]
    assert len(set(ranks)) == len(ranks)  # equal rows have ranks of their own
    assert lexical.search(no_docs, items).count() == 0
    assert lexical.search(edge_docs, frame(spark, [], ITEMS)).count() == 0
