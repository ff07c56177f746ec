"""The queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronopix.llm import ann, decontaminate, langid, lattice, licenses, mixing, quality, simhash, tokens, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_permutation_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "embeddings")
    return ann.search(e, e.where(F.col("vec_id") % 50 == 0), nearest=5)


def op2_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"), limit=512)


def op4_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("source")


def op5_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.report(_table(spark, sf_dir, "documents"), _vocabulary("piece_bpe_32k.model"), ranked=True)


def op6_nbsvm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_license_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op8_automaton_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_permutation_search, op2_simhash_components, op3_token_counts, op4_curriculum_mix, op5_lattice_score, op6_nbsvm_quality, op7_license_digest, op8_automaton_decontamination, op9_weak_toxicity, op10_rank_order_language)
    return {f.__name__: f for f in own}


_DECONTAMINATION_SQL = r"""WITH RECURSIVE iw AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iwin AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS width, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS k
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM iw WHERE len(w) > 0)),
widths AS (SELECT DISTINCT width FROM iwin),
dw AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
dwin AS (SELECT r, i, width, array_to_string(w[i:i + width - 1], ' ') AS k FROM (SELECT r, w, width, unnest(range(1, len(w) - width + 2)) AS i FROM dw, widths WHERE len(w) >= width)),
hit AS (SELECT r, i, d.width, item_id FROM dwin d JOIN iwin USING (k, width)),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + width)) AS p FROM hit) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS l FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN pos USING (r) LEFT JOIN its USING (r)"""


def oracle_sql() -> dict[str, str]:
    return {"op4_curriculum_mix": mixing.sql(), "op7_license_digest": licenses.sql(), "op8_automaton_decontamination": _DECONTAMINATION_SQL}
