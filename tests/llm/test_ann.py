from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from strata.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(spark, rows):
    return spark.createDataFrame([(k, None if v is None else [None if x is None else float(x) for x in v], 0) for k, v in rows], SCHEMA)


def brute(rows, query_ids, top):
    kept = {}
    for k, v in rows:
        if v is None or not len(v) or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        kept[k] = np.array(v, dtype=np.float32).astype(float)
    out = {}
    for q in query_ids:
        if q in kept:
            found = sorted((-float((kept[q] * v).sum()), k) for k, v in kept.items() if k != q)[:top]
            out[q] = [(k, -s) for s, k in found]
    return out


def answer(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_edges_and_ties_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(k, rng.normal(size=8)) for k in range(60)]
    rows += [(k, rows[3][1]) for k in range(100, 160)]  # many copies of one vector
    rows += [(200, None), (201, []), (202, [0.0] * 8), (203, [float("nan")] * 8), (204, [float("inf")] + [1.0] * 7), (205, [None] + [1.0] * 7)]
    frame = vectors(spark, rows)
    asked = frame.filter("vec_id % 20 = 0")
    got, want = answer(ann.search(frame, asked)), brute(rows, [k for k, _ in rows if k % 20 == 0], 20)
    assert {q: [k for k, _ in v] for q, v in got.items()} == {q: [k for k, _ in v] for q, v in want.items()}
    for q in want:
        np.testing.assert_allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12)


def test_few_candidates_and_repeated_ids(spark):
    frame = vectors(spark, [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 1.0]), (2, [1.0, 2.0, 3.0])])
    assert answer(ann.search(frame, frame.filter("vec_id = 0"))) == {0: [(1, 0.5)]}  # one length wins


def test_empty(spark):
    frame = vectors(spark, [])
    assert ann.search(frame, frame).count() == 0
    some = vectors(spark, [(0, [1.0]), (1, [2.0])])
    assert ann.search(some, frame).count() == 0


def test_footrule_is_the_distance_of_the_orders():
    rng = np.random.default_rng(2)
    rows, pivots = rng.normal(size=(50, 6)), rng.normal(size=(12, 6))
    index, orders = ann.InvertedFile(rows, pivots, 5), ann.prefixes(rows, pivots, 5)
    for q in range(5):
        place = lambda order, p: list(order).index(p) if p in order else 5
        want = [sum(abs(place(orders[q], p) - place(o, p)) for p in set(orders[q]) | set(o)) for o in orders]
        np.testing.assert_array_equal(index.footrule(orders[q]), want)


@pytest.mark.parametrize("rows, every", [(500, 20), (6000, 100), (40_000, 1000)])
def test_recall(spark, rows, every):
    rng = np.random.default_rng(4)
    data = rng.normal(size=(rows, 64)).astype(np.float32)
    data /= np.linalg.norm(data, axis=1, keepdims=True)
    frame = spark.createDataFrame(pd.DataFrame({"vec_id": range(rows), "embedding": data.tolist(), "label": 0}), SCHEMA)
    got = answer(ann.search(frame, frame.filter(f"vec_id % {every} = 0")))
    whole, hits = data.astype(float), 0
    for q in range(0, rows, every):
        scores = (whole * whole[q]).sum(axis=1)
        scores[q] = -np.inf
        hits += len({k for k, _ in got[q]} & set(np.argsort(-scores)[:20].tolist()))
    assert hits / (20 * len(got)) >= 0.9 and len(got) == rows // every


def test_every_row_of_a_repeated_id_is_a_candidate(spark):
    rows = [(0, [1.0, 0.0]), (1, [9.0, 1.0]), (1, [0.5, 1.0]), (2, [0.25, 0.0]), (2, [0.25, 0.0]), (3, [0.1, 3.0])]
    frame = vectors(spark, rows)
    got = answer(ann.search(frame, frame.filter("vec_id = 0")))
    assert [k for k, _ in got[0]] == [1, 1, 2, 2, 3]
    np.testing.assert_allclose([s for _, s in got[0]], [9.0, 0.5, 0.25, 0.25, 0.1], rtol=1e-6)
    assert [k for k, _ in answer(ann.search(frame, frame.filter("vec_id = 0"), top=3))[0]] == [1, 1, 2]
    # many rows of the query's own id, nearer than all others, crowd none out
    mine = [(0, [100.0 + k, k * 0.5]) for k in range(40)]
    frame = vectors(spark, rows + mine + [(9, [100.0, 0.0])] * 30)
    got = answer(ann.search(frame, frame.filter("vec_id = 0"), top=33))
    assert [k for k, _ in got[0]] == [9] * 30 + [1, 1, 2]
    got = answer(ann.search(frame, frame.filter("vec_id = 9"), top=41))
    assert [k for k, _ in got[9]] == [0] * 40 + [1]


def test_search_among_copies_of_every_vector(spark):
    rng = np.random.default_rng(8)
    data = rng.normal(size=(3000, 32)).astype(np.float32).astype(float)
    rows = [(k + 3000 * c, data[k]) for c in range(4) for k in range(3000)]
    frame = vectors(spark, rows)
    got = answer(ann.search(frame, frame.filter("vec_id % 600 = 0")))
    want, hits = brute(rows, [k for k, _ in rows if k % 600 == 0], 20), 0
    for q, pairs in want.items():
        hits += len({k for k, _ in pairs} & {k for k, _ in got[q]})
        assert [s for _, s in got[q]] == sorted((s for _, s in got[q]), reverse=True)
    assert hits / (20 * len(want)) >= 0.9 and len(want) == 20


def test_recall_with_a_hundred_copies_of_every_vector(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(6)
    data = rng.normal(size=(4000, 64)).astype(np.float32).astype(float)
    once = vectors(spark, list(enumerate(data)))
    frame = once.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(99))))
    frame = frame.select((F.col("copy") * 4000 + F.col("vec_id")).alias("vec_id"), "embedding", "label")
    pivots = ann.choose_pivots(ann.usable(frame))
    assert len(np.unique(pivots, axis=0)) == ann.PIVOTS
    # what the copies leave of the index: recall over the distinct vectors with these pivots
    index, hits = ann.InvertedFile(data, pivots, ann.PREFIX), 0
    depth = int(ann.RERANK_SHARE * len(data))
    for q in range(0, 4000, 100):
        near = ann.prefixes(data[q : q + 1], pivots, ann.PREFIX)[0]
        picked = np.argpartition(index.footrule(near), depth - 1)[:depth]
        scores = data @ data[q]
        hits += len(set(np.argsort(-scores)[:20]) & set(picked))
    assert hits / (20 * 40) >= 0.9
