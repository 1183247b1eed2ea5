"""Every stage of the pipeline against a plain version over all its input."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import decontam
from strata.llm.common import BATCH_BYTES, save, table
from tests.llm.conftest import CLASHES
from tests.llm.test_decontam import overlaps
from tests.llm.test_sharding_mixing import check_mix, check_shards
from tests.llm.test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages_on_documents(spark, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "SHARDS", 5)
    docs = table(spark, SF, "documents")
    bench = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = save(stage(spark, docs, SF), f"test-{name}")
        after = docs.collect()
        texts = Counter((r.doc_id, r.text) for r in before)
        if name != "kd_sharding":
            assert docs.columns == columns
        if name == "language_id":
            want = Counter({k: n for k, n in texts.items() if any(c.isalpha() for c in k[1] or "")})
        elif name == "simhash_near_duplicates":
            ids = [r.doc_id for r in before]
            first = plain_components(ids, [plain_fingerprint(r.text) for r in before])
            want = Counter({k: n for k, n in texts.items() if first[k[0]] == k[0]})
        elif name == "decontamination":
            want = Counter({k: n for k, n in texts.items() if not any(overlaps(k[1], t) for _, t in bench)})
        elif name == "source_mixing":
            got = corpus_pipeline.mixing.mix(spark.createDataFrame(before)).documents.collect()
            check_mix(before, got)
            text = {r.doc_id: r.text for r in before}
            want = Counter({(r.doc_id, text[r.doc_id]): int(r.taken / max(1, r.size) + 0.5) for r in got})
            want = +want
        else:
            check_shards(after, before, 5)
            continue
        assert Counter((r.doc_id, r.text) for r in after) == want, name


def test_run_and_empty_tables(spark, no_docs, tmp_path):
    sf = str(tmp_path)
    no_docs.write.parquet(f"{sf}/documents.parquet")
    table(spark, SF, "benchmark").write.parquet(f"{sf}/benchmark.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "simhash_near_duplicates", "decontamination", "source_mixing", "kd_sharding",
    ]
    assert decontam.WINDOW > 0


def test_edge_rows(spark, edge_docs, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "SHARDS", 2)
    docs = edge_docs
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine")], "item_id long, text string")
    for name, stage in corpus_pipeline.STAGES:
        if name == "decontamination":
            docs = decontam.decontaminate(docs, bench)
        else:
            docs = save(stage(spark, docs, ""), "test-edges")
        rows = docs.collect()
        assert rows
        if name != "kd_sharding":  # extra columns keep their values, whatever they are called
            assert docs.columns == edge_docs.columns and all(r[c] == "clash" for r in rows for c in CLASHES), name


BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def largest_batch(spark):
    """Bytes of the largest Arrow batch that a worker gets of 40 MB of texts."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["bytes"])

    rows = spark.range(0, 4000, 1, 1).select(F.repeat(F.lit("x"), F.lit(10_000)).alias("text"))
    return rows.mapInArrow(sizes, "bytes long").agg(F.max("bytes")).first()[0]


@pytest.mark.parametrize("name", ["language_id", "simhash_near_duplicates", "decontamination"])
def test_stages_bound_the_bytes_of_a_batch(spark, edge_docs, tmp_path, name):
    table(spark, SF, "benchmark").write.parquet(f"{tmp_path}/benchmark.parquet")
    before = spark.conf.get(BATCH_CONF, None)
    try:
        spark.conf.unset(BATCH_CONF)
        dict(corpus_pipeline.STAGES)[name](spark, edge_docs, str(tmp_path))
        assert largest_batch(spark) < 2 * BATCH_BYTES
        spark.conf.set(BATCH_CONF, str(1 << 20))  # a bound that the session has stays
        dict(corpus_pipeline.STAGES)[name](spark, edge_docs, str(tmp_path))
        assert spark.conf.get(BATCH_CONF) == str(1 << 20)
    finally:
        spark.conf.unset(BATCH_CONF) if before is None else spark.conf.set(BATCH_CONF, before)
