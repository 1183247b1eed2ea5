from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import runs
from strata.llm.common import table
from strata.llm.queries import op11_periodic_runs
from tests.llm.conftest import docs_of, frame

SF = "/root/testdata/sf0.001"


def plain_runs(words, least=6, times=4):
    """Every period in turn; a stretch of a smaller period is not counted again."""
    numbers = {}
    w = np.array([numbers.setdefault(x, len(numbers)) for x in words], dtype=np.int64)
    found = []
    for q in range(1, len(w) // times + 1):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], w[:-q] == w[q:], [0]])))
        for start, end in edges.reshape(-1, 2).tolist():
            size = end - start + q
            if size >= max(least, times * q):
                part = w[start : end + q]
                if not any((part[:-p] == part[p:]).all() for p in range(1, q)):
                    found.append((start, size, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def plain_row(doc_id, text):
    words = plain_planted(doc_id, (text or "").encode().split())
    found = plain_runs(words)
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    s, n, q = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in found)
    kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
    return (doc_id, len(found), s, n, q, 1000 * n // q if found else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


stretch = st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=5), st.integers(1, 24)).map(lambda t: (t[0] * 24)[: t[1]])
texts = st.lists(st.lists(stretch, max_size=5).map(lambda s: sum(s, [])), min_size=1, max_size=4)


@settings(max_examples=500, deadline=None)
@given(texts, st.sampled_from([(6, 4), (2, 2), (5, 3), (9, 2), (4, 5)]))
def test_runs_equal_all_periods_tried(texts, limits):
    words = np.array(sum(texts, []), dtype=np.int64)
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    begins = np.cumsum([0, *(len(t) for t in texts)])
    want = [(int(begins[k]) + s, n, q) for k, t in enumerate(texts) for s, n, q in plain_runs(t, *limits)]
    assert [tuple(r) for r in runs.runs_of(words, text, *limits).tolist()] == want


def test_gram_length_is_lossless():
    assert runs.gram_length(6, 4) == 5 and runs.gram_length(2, 2) == 1
    for least, times in ((6, 4), (12, 3), (7, 2), (3, 9)):
        gram = runs.gram_length(least, times)
        for q in range(1, 40):  # every gram of the shortest run comes one period before or after
            size = max(least, times * q)
            assert all(i - q >= 0 or i + q <= size - gram for i in range(size - gram + 1))


@pytest.mark.parametrize("words", [[1] * 30_000, [1, 2, 3] * 10_000, list(range(500)) * 40])
def test_long_periodic_texts(words):
    (run,) = runs.runs_of(np.array(words), np.zeros(len(words), dtype=np.int64), 6, 4)
    assert tuple(run) == (0, len(words), len(set(words)))


def test_no_run_crosses_documents(spark):
    rows = runs.find_runs(docs_of(spark, ["a a a", "a a a a", "a a a a a a"])).orderBy("doc_id").collect()
    assert [len(r.runs) for r in rows] == [0, 0, 1] and rows[2].collapsed == "a"


def test_query_equals_plain_version(spark):
    docs = table(spark, SF, "documents").collect()
    want = sorted(plain_row(r.doc_id, r.text) for r in docs)
    got = op11_periodic_runs(spark, SF).collect()
    assert sorted(map(tuple, got)) == want
    assert sum(r.n_runs > 0 for r in got) > len(docs) // 20


def test_edges(spark, edge_docs, no_docs):
    found = runs.digests(runs.find_runs(edge_docs.withColumn("text", runs.planted(edge_docs.text, edge_docs.doc_id)))).collect()
    long, short = [r for r in found if r.length and r.length > 1000], [r for r in found if not r.length or r.length <= 1000]
    want = [plain_row(r.doc_id, r.text) for r in edge_docs.collect() if len(r.text or "") < 1000]
    assert sorted(map(tuple, short), key=str) == sorted(want, key=str)
    assert [(r.doc_id, r.n_runs, r.start, r.length, r.period) for r in long] == [(7, 1, 0, 120_000, 3 * 997)]
    assert runs.find_runs(no_docs).count() == 0
    with pytest.raises(ValueError):
        runs.find_runs(no_docs, times=1)


def test_dropped_words_and_repeated_rows(spark):
    text = "x y " * 5 + "z " * 7 + "end"
    rows = runs.find_runs(frame(spark, [(1, text, None, None, None)] * 2 + [(None, None, None, None, None)])).collect()
    assert [r.collapsed for r in rows] == ["x y z end", "x y z end", ""]
    assert [tuple(r) for r in rows[0].runs] == [(0, 10, 2), (10, 7, 1)]
