from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm import common, mixing, sharding
from strata.llm.common import running_total, save, table
from tests.llm.conftest import frame

SF = "/root/testdata/sf0.01"


def many(spark, n, hot=0):
    rng = random.Random(n)
    rows = [
        (k, "x" * rng.randrange(2000) + f" {k}", rng.choice(["en", "fr", None]), rng.choice(["a", "a", "a", "b", "c", None]), 0)
        for k in range(n)
    ]
    return frame(spark, rows + [(n + k, "the same text", "en", "a", 0) for k in range(hot)])


def check_shards(got, docs, shards):
    by_key = defaultdict(list)
    for r in docs:
        by_key[r.doc_id].append(r.text)
    assert len(got) == len(docs)
    sums, slots = Counter(), defaultdict(list)
    for r in got:
        assert any(r.size == len((t or "").encode()) + 8 and r.text_crc32 == zlib.crc32((t or "").encode()) for t in by_key[r.doc_id])
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        sums[r.shard] += r.size
        slots[r.shard].append(r.slot)
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))
    return sums


def test_near_equal_bytes(spark):
    docs = many(spark, 2000, hot=300)
    got = sharding.shard_documents(docs, shards=10).collect()
    sums = check_shards(got, docs.collect(), 10)
    mean = sum(sums.values()) / 10
    assert len(sums) == 10 and max(sums.values()) < 1.05 * mean and min(sums.values()) > 0.95 * mean
    again = sharding.shard_documents(docs, shards=10).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_equal_texts_stay_together_unless_heavy(spark):
    rows = [(k, f"text {k % 900} " + "y" * (k % 900), "en", f"s{k % 7}", 0) for k in range(1800)]
    got = save(sharding.shard_documents(frame(spark, rows), shards=4), "test")
    shards = got.groupBy("text_crc32").agg(F.countDistinct("shard").alias("n"))
    assert shards.filter("n > 1").count() == 0
    hot = frame(spark, [(k, "z" * 100, "en", "s", 0) for k in range(600)])
    sums = check_shards(sharding.shard_documents(hot, shards=4).collect(), hot.collect(), 4)
    assert len(sums) == 4 and max(sums.values()) < 2 * min(sums.values())


def test_target_bytes(spark):
    docs = many(spark, 500)
    total = docs.agg(F.sum(F.octet_length("text") + 8)).first()[0]
    got = sharding.shard_documents(docs, target_bytes=total // 3 + 1)
    assert got.select("shard").distinct().count() == 3
    with pytest.raises(ValueError):
        sharding.shard_documents(docs)


def test_shard_edges(edge_docs, no_docs):
    got = sharding.shard_documents(edge_docs, shards=3).collect()
    check_shards(got, edge_docs.collect(), 3)
    assert sharding.shard_documents(no_docs, shards=3).count() == 0


def test_running_total(spark):
    rows = save(spark.range(1000).select((F.col("id") % 3).alias("g"), "id", (F.col("id") % 5).alias("v")), "test")
    got = running_total(rows, group=["g"], bucket=F.expr("id div 64"), order=["id"], value=F.col("v"), out="t").collect()
    seen = Counter()
    for r in sorted(got, key=lambda r: r.id):
        assert r.t == seen[r.g]
        seen[r.g] += r.v


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, target, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not full:
            return target | {s: level * weight[s] for s in free}
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        free -= full
    return target


def check_mix(docs, got):
    sizes, taken, target = Counter(), Counter(), {}
    for r in docs:
        sizes[r.source] += words(r.text)
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        taken[r.source] += r.taken
        target[r.source] = r.target
    want = plain_targets(sizes)
    assert len(got) == len(docs) and sorted((r.doc_id or -1, r.size) for r in got) == sorted((r.doc_id or -1, words(r.text)) for r in docs)
    for s in want:
        assert abs(target[s] - want[s]) < 1e-6 * max(1, want[s]) and abs(taken[s] - want[s]) <= 1


def test_mix_of_documents(spark):
    docs = table(spark, SF, "documents")
    first = mixing.mix(docs)
    got = first.documents.collect()
    check_mix(docs.collect(), got)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs).documents.collect()))


def test_targets_are_capped_and_shared_again(spark):
    rows = [(k, "w " * n, "en", s, 0) for k, (s, n) in enumerate([("a", 10), ("b", 1000), ("c", 100), (None, 40), ("d", 0)] * 3)]
    docs = frame(spark, rows)
    check_mix(docs.collect(), mixing.mix(docs, block=7).documents.collect())


def test_schedule_ranks_and_balance(spark):
    rows = [(k, "w " * 50, "en", s, 0) for k, s in enumerate(["a"] * 40 + ["b"] * 30 + ["c"] * 30)]
    mix = mixing.mix(frame(spark, rows), block=10)
    slots = mix.schedule.orderBy("slot").collect()
    need = {r.source_no: r.need for r in mix.sources.collect()}
    ranks = defaultdict(list)
    for r in slots:
        ranks[r.source_no].append(r["rank"])
    assert {s: len(r) for s, r in ranks.items()} == need
    assert all(sorted(r) == list(range(len(r))) for r in ranks.values())
    share = {s: n / sum(need.values()) for s, n in need.items()}
    for upto in (50, 100, len(slots) // 2):
        seen = Counter(r.source_no for r in slots[:upto])
        assert all(abs(seen[s] - share[s] * upto) <= 6 for s in need)


def plain_slots(sources, slots):
    """Van der Corput points through the cumulative needs, one after another."""
    bounds, upto, total = [], 0, sum(r.need for r in sources)
    for r in sorted(sources, key=lambda r: r.source_no):
        bounds.append((r.source_no, upto / total, (upto + r.need) / total, r.need))
        upto += r.need
    ranks, out = Counter(), []
    for n in range(slots):
        x, half, k = 0.0, 0.5, n
        while k:
            x, half, k = x + half * (k & 1), half / 2, k >> 1
        no, _, _, need = next(b for b in bounds if b[1] <= x < b[2])
        if ranks[no] < need:
            out.append((n, no, ranks[no]))
            ranks[no] += 1
    late = [(no, k) for no, _, _, need in bounds for k in range(ranks[no], need)]
    return out + [(slots + n, no, k) for n, (no, k) in enumerate(late)]


def mixed_table(spark):
    rng = random.Random(5)
    rows = [(k, " ".join(f"{s}{k}w{j}" for j in range(rng.randrange(60))), "en", s, 0) for k, s in enumerate(rng.choices(["a", "b", "c", "d"], [6, 3, 2, 1], k=400))]
    rows += [(None, " ".join(f"n{j}" for j in range(3000)), "en", "a", 0), (7, "again  and\tagain", "en", "b", 0), (7, None, "en", None, 0)]
    return frame(spark, rows)


def test_slots_are_those_of_a_plain_van_der_corput_sequence(spark):
    mix = mixing.mix(mixed_table(spark), block=16)
    sources = mix.sources.collect()
    want = plain_slots(sources, sum(r.need for r in sources))
    assert [(r.slot, r.source_no, r["rank"]) for r in mix.schedule.orderBy("slot").collect()] == want


def test_mixed_blocks_hold_the_words_of_the_mix_in_slot_order(spark, no_docs):
    docs, block = mixed_table(spark), 16
    got = save(mixing.mixed_blocks(docs, block=block), "test")
    pieces, texts = got.orderBy("slot", "place").collect(), defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append((r.text or "").split())
    taken = Counter()
    for r in pieces:
        assert any(t[r.start : r.end] == r.text.split(" ") for t in texts[r.doc_id]) and r.end > r.start
        taken[r.doc_id, r.source] += r.end - r.start
    mix = mixing.mix(docs, block=block)
    want = Counter()
    for r in mix.documents.collect():
        want[r.doc_id, r.source] += r.taken
    assert taken == +want
    first = {}
    for r in pieces:
        first.setdefault((r.doc_id, r.source), r.slot)
    assert first[None, "a"] == next(r.first_slot for r in mix.documents.collect() if r.doc_id is None)
    filled, source_of = defaultdict(list), {}
    for r in pieces:
        assert r.place == sum(filled[r.slot])  # pieces of a block follow each other
        filled[r.slot].append(r.end - r.start)
        source_of[r.slot] = r.source
    plan = mix.schedule.orderBy("slot").collect()
    assert {r.slot: r.words for r in plan if r.words} == {s: sum(n) for s, n in filled.items()}
    # any stretch of slots is near the targets, by words
    target = {r.source: r.target for r in mix.sources.collect()}
    order = sorted(filled)
    for low, high in ((0, 64), (40, 104), (100, 180)):
        count = Counter()
        for slot in order[low:high]:
            count[source_of[slot]] += sum(filled[slot])
        for source, words_wanted in target.items():
            assert abs(count[source] / sum(count.values()) - words_wanted / sum(target.values())) < 0.08
    assert mixing.mixed_blocks(no_docs).count() == 0


def test_another_schedule_gives_another_mix(spark, monkeypatch):
    docs = mixed_table(spark)
    before = [(r.slot, r.text) for r in mixing.mixed_blocks(docs, block=16).orderBy("slot", "place").collect()]
    firsts = mixing.mix(docs, block=16).documents.select("doc_id", "first_slot").collect()
    real = mixing.schedule
    monkeypatch.setattr(mixing, "schedule", lambda plan, slots: real(plan, slots).withColumn("slot", 2 * slots - F.col("slot")))
    after = [(r.slot, r.text) for r in mixing.mixed_blocks(docs, block=16).orderBy("slot", "place").collect()]
    assert [t for _, t in before] != [t for _, t in after]
    assert sorted(map(str, firsts)) != sorted(map(str, mixing.mix(docs, block=16).documents.select("doc_id", "first_slot").collect()))


def test_sharded_documents_hold_every_text_by_shard_and_slot(spark, edge_docs, no_docs):
    for docs in (edge_docs, many(spark, 300, hot=60)):
        got = sharding.sharded_documents(docs, shards=4)
        parts = got.withColumn("part", F.spark_partition_id()).collect()
        check_shards(parts, docs.collect(), 4)
        assert Counter((r.doc_id, r.text) for r in parts) == Counter((r.doc_id, r.text) for r in docs.collect())
        assert all(r.text_crc32 == zlib.crc32((r.text or "").encode()) for r in parts)
        placed = [(r.part, r.shard, r.slot) for r in parts]
        assert placed == sorted(placed) and [p[1:] for p in placed] == sorted(p[1:] for p in placed)
    assert sharding.sharded_documents(no_docs, shards=3).count() == 0


def test_mix_edges(spark, edge_docs, no_docs):
    got = mixing.mix(edge_docs).documents.collect()
    check_mix(edge_docs.collect(), got)
    assert {r.taken for r in got if r.doc_id in (1, 2, 3)} == {0}
    assert mixing.mix(no_docs).documents.count() == 0
    blank = frame(spark, [(1, "", "en", "a", 0), (2, None, "en", None, 0)])
    assert [r.target for r in mixing.mix(blank).documents.collect()] == [0.0, 0.0]


def test_mixed_documents(edge_docs, no_docs):
    docs = mixing.mixed_documents(edge_docs)
    assert docs.columns == edge_docs.columns
    taken = {(r.doc_id, r.size): r.taken for r in mixing.mix(edge_docs).documents.collect()}
    copies = Counter(r.doc_id for r in docs.collect())
    for k in (4, 5, 8, 9, None):
        (size, t) = next((s, t) for (d, s), t in taken.items() if d == k)
        assert copies[k] == int(t / size + 0.5)
    assert mixing.mixed_documents(no_docs).count() == 0


def test_mixed_documents_decides_by_row(spark):
    # most of a source under null or one id: its own target must still be met
    rows = [(None if k % 2 else 7, " ".join(f"w{k}" for _ in range(20 + k % 5)), "en", "s01", 0) for k in range(300)]
    rows += [(1000 + k, "a b c d e f g h " * 4, "en", f"s{k % 20:02}", 0) for k in range(640) if k % 20 != 1]
    docs = frame(spark, rows)
    target = {r.source: r.target for r in mixing.mix(docs, block=32).sources.collect()}
    assert target["s01"] < 0.45 * sum(words(r[1]) for r in rows if r[3] == "s01")
    got = Counter()
    for r in mixing.mixed_documents(docs, block=32).collect():
        got[r.source] += words(r.text)
    for source, want in target.items():
        assert abs(got[source] - want) <= 64, source


@pytest.mark.parametrize("shared", [None, 7])
def test_equal_rows_under_one_id_are_spread(spark, shared):
    """A third of the rows are one text under one id, or under none."""
    rows = [(k, "y" * 400 + f"{k}", "en", "a", 0) for k in range(10_000, 12_000)]
    rows += [(shared, "z" * 400, "fr", "b", 0)] * 1000
    got = sharding.shard_documents(frame(spark, rows).repartition(4), shards=24).collect()
    sums, slots = Counter(), defaultdict(list)
    for r in got:
        sums[r.shard] += r.size
        slots[r.shard].append(r.slot)
    mean = sum(sums.values()) / 24
    assert len(got) == 3000 and len(sums) == 24
    assert max(sums.values()) < 1.05 * mean and min(sums.values()) > 0.95 * mean
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_stored_documents_are_not_saved_again(spark, edge_docs, tmp_path, monkeypatch):
    path = str(tmp_path / "docs")
    edge_docs.repartition(3).write.parquet(path)
    docs = spark.read.parquet(path)
    saved, real = [], sharding.save
    monkeypatch.setattr(sharding, "save", lambda df, purpose: saved.append(df.columns) or real(df, purpose))
    monkeypatch.setattr(sharding, "numbered", lambda df: pytest.fail("the texts were saved once more"))
    got = sharding.sharded_documents(docs, shards=4, stored=True)
    assert sorted(str(r.text) for r in got.collect()) == sorted(str(r.text) for r in edge_docs.collect())
    assert saved and not any("text" in columns for columns in saved)
    monkeypatch.undo()
    check_shards(got.collect(), edge_docs.collect(), 4)


def test_stored_documents_are_mixed_without_saving_texts(spark, edge_docs, tmp_path, monkeypatch):
    path = str(tmp_path / "docs")
    edge_docs.repartition(3).write.parquet(path)
    docs = spark.read.parquet(path)
    monkeypatch.setattr(mixing, "numbered", lambda df: pytest.fail("the texts were saved once more"))
    got = mixing.mixed_documents(docs, stored=True)
    assert got.columns == docs.columns
    # the rows that are taken are joined as bitmaps: texts stay where they are
    assert not any("text" in line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hash" in line)
    monkeypatch.undo()
    copies = Counter(r.doc_id for r in got.collect())
    for r in mixing.mix(edge_docs).documents.collect():
        if r.doc_id in (4, 5, 8, 9, None):
            assert copies[r.doc_id] == int(r.taken / r.size + 0.5)
    assert not set(copies) & {1, 2, 3}


def test_rows_are_repeated_as_often_as_marked(spark, tmp_path):
    path = str(tmp_path / "numbers")
    spark.range(0, 70_000, 1, 2).select(F.col("id").alias("doc_id"), F.lit("x").alias("_bits1")).write.parquet(path)
    rows, row = common.located(spark.read.parquet(path))
    times = rows.select(*row, F.pmod("doc_id", F.lit(3)).cast("int").alias("n")).filter("n > 0")
    got = common.repeated_rows(rows, row, times, "n", 2)
    assert got.columns == [*rows.columns, "n"]
    assert got.filter("n != doc_id % 3").count() == 0
    assert got.count() == got.select("doc_id").distinct().count() == sum(k % 3 > 0 for k in range(70_000))
