"""Registered queries of the corpus operators and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import ann, bpe, decontam, langid, lexical, mixing, pii, preference, quality, runs, secrets, sharding, simhash
from strata.llm.common import table

SHARDS = 24
PII_KEY = "pseudonym key of the registered query"


def op1_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


def op2_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learn = docs.filter(~langid.held_out(F.col("doc_id")))
    return langid.identify(docs, langid.fit(learn))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=SHARDS)


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).documents


def op8_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen, rejected = preference.swapped_answers(table(spark, sf_dir, "conversations"))
    return preference.format_preferences(chosen, rejected)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op10_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents"), PII_KEY)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return runs.digests(runs.find_runs(docs.withColumn("text", runs.planted(F.col("text"), F.col("doc_id")))))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    file = bpe.read_file(public_tokenizers.path("word_bpe_49k.json"))
    coded = bpe.encode_documents(table(spark, sf_dir, "documents"), file)
    return bpe.digests(bpe.decode_documents(coded, file))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_permutation_index,
        op2_quality_pu,
        op3_language_id,
        op4_decontamination,
        op5_simhash,
        op6_kd_sharding,
        op7_source_mixing,
        op8_preference_format,
        op9_secret_scan,
        op10_pii_pseudonyms,
        op11_periodic_runs,
        op12_lexical_search,
        op13_bpe,
    )
}

#: Turn by turn with joins and running lengths, not over arrays of turns.
_OP8 = """
WITH turns AS (
  SELECT conv_id AS pair_id, turn, replace(coalesce(role, ''), '<|', '< |') AS role,
         replace(coalesce(text, ''), '<|', '< |') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
answers AS (
  SELECT pair_id, max(turn) AS last_turn FROM turns WHERE role = 'assistant' GROUP BY pair_id),
answer_text AS (
  SELECT t.pair_id, a.last_turn, max(t.text) AS text
  FROM turns t JOIN answers a ON t.pair_id = a.pair_id AND t.turn = a.last_turn AND t.role = 'assistant'
  GROUP BY t.pair_id, a.last_turn),
cut AS (
  SELECT t.*, t.role = 'assistant' AND t.turn = a.last_turn AS is_last, o.text AS other, o.pair_id IS NOT NULL AS has_other
  FROM turns t LEFT JOIN answers a USING (pair_id)
  LEFT JOIN answer_text o ON o.pair_id = xor(t.pair_id, 1)
  WHERE a.last_turn IS NULL OR t.turn <= a.last_turn),
chosen AS (
  SELECT pair_id, role, text, row_number() OVER (PARTITION BY pair_id ORDER BY turn, role, text) AS n FROM cut),
swapped AS (
  SELECT pair_id, turn, role, CASE WHEN is_last THEN other ELSE text END AS text
  FROM cut WHERE is_last IS NOT TRUE OR has_other),
rejected AS (
  SELECT pair_id, role, text, row_number() OVER (PARTITION BY pair_id ORDER BY turn, role, text) AS n FROM swapped),
sizes AS (
  SELECT pair_id, count(*) AS c, (SELECT count(*) FROM rejected r WHERE r.pair_id = chosen.pair_id) AS r
  FROM chosen GROUP BY pair_id),
differ AS (
  SELECT c.pair_id, min(c.n) AS n FROM chosen c JOIN rejected r ON c.pair_id = r.pair_id AND c.n = r.n
  WHERE c.role <> r.role OR c.text <> r.text GROUP BY c.pair_id),
prefix AS (
  SELECT s.pair_id, s.c, s.r, coalesce(d.n - 1, least(s.c, s.r)) AS shared
  FROM sizes s LEFT JOIN differ d ON s.pair_id = d.pair_id),
sides AS (
  SELECT 'c' AS side, * FROM chosen UNION ALL SELECT 'r', * FROM rejected),
placed AS (
  SELECT s.side, s.pair_id, s.n, s.role, p.shared,
         '<|' || s.role || '|>' || chr(10) || s.text || '<|end|>' || chr(10) AS shown,
         length('<|' || s.role || '|>' || chr(10)) AS head,
         coalesce(sum(length(s.role) + length(s.text) + 13) OVER (
           PARTITION BY s.side, s.pair_id, s.n > p.shared ORDER BY s.n
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos,
         length(s.text) + 7 AS body
  FROM sides s JOIN prefix p ON s.pair_id = p.pair_id),
shown AS (
  SELECT pair_id,
         string_agg(shown, '' ORDER BY n) FILTER (WHERE side = 'c' AND n <= shared) AS prompt,
         string_agg(shown, '' ORDER BY n) FILTER (WHERE side = 'c' AND n > shared) AS chosen,
         string_agg(shown, '' ORDER BY n) FILTER (WHERE side = 'r' AND n > shared) AS rejected,
         string_agg(CAST(pos + head AS BIGINT) || ':' || CAST(pos + head + body AS BIGINT), ',' ORDER BY n)
           FILTER (WHERE side = 'c' AND n > shared AND role = 'assistant') AS chosen_mask,
         string_agg(CAST(pos + head AS BIGINT) || ':' || CAST(pos + head + body AS BIGINT), ',' ORDER BY n)
           FILTER (WHERE side = 'r' AND n > shared AND role = 'assistant') AS rejected_mask
  FROM placed GROUP BY pair_id)
SELECT p.pair_id,
       CASE WHEN c = shared AND r = shared THEN 'equal' WHEN c = shared THEN 'chosen_empty'
            WHEN r = shared THEN 'rejected_empty' ELSE 'pair' END AS status,
       CAST(shared AS INTEGER) AS prompt_turns, coalesce(prompt, '') AS prompt, coalesce(chosen, '') AS chosen,
       coalesce(rejected, '') AS rejected, coalesce(chosen_mask, '') AS chosen_mask,
       coalesce(rejected_mask, '') AS rejected_mask
FROM prefix p JOIN shown s ON p.pair_id = s.pair_id
"""

#: Every item's terms against every document's counts, all sums at once.
_OP12 = r"""
WITH cut AS (
  SELECT row_number() OVER () AS place, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
sized AS (SELECT place, doc_id, CAST(len(terms) AS BIGINT) AS n FROM cut WHERE len(terms) > 0),
whole AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sized),
counted AS (
  SELECT place, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT place, unnest(terms) AS term FROM cut) t GROUP BY place, term),
wanted AS (
  SELECT DISTINCT item_id, term FROM (
    SELECT item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) t),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counted, whole GROUP BY term),
scored AS (
  SELECT item_id, place, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words)))) AS BIGINT) AS score
  FROM wanted JOIN counted USING (term) JOIN weights USING (term) JOIN sized USING (place), whole
  GROUP BY item_id, place),
ranked AS (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored JOIN sized USING (place) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""

ORACLE: dict[str, str] = {"op8_preference_format": _OP8, "op12_lexical_search": _OP12}
