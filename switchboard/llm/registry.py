"""The subpackage's queries: opN_<name> -> (spark, sf_dir) -> DataFrame, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle
from .codes import compressed_codes
from .conversations import render_chats
from .decontaminate import contaminated_spans
from .licences import license_matches
from .merkle import verified_manifest
from .minhash import near_duplicates
from .mixing import mixing_rates
from .quality import quality_scores
from .recurrent import language_model_scores
from .rules import quality_rules
from .surrogates import pseudonymize
from .toxicity import toxicity_scores
from .vectors import similar_vectors


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), k=2, threshold=80).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated_spans(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), window=10)
    n_hit = F.coalesce(F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.begin)"), F.lit(0).cast("bigint"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("bigint").alias("n_items"),
                        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def _crc(mod: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(mod))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model_scores(_table(spark, sf_dir, "documents"), _crc(5) == 1)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), _crc(5) == 0, threshold=0.3)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity_scores(docs, _table(spark, sf_dir, "labels"), _crc(3) == 1, threshold=0.7).select(
        "doc_id", F.col("_held_out").alias("held_out"), F.col("_score").alias("score"), F.col("_predicted").alias("predicted"))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_vectors(_table(spark, sf_dir, "embeddings"), cosine=0.98)


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render_chats(_table(spark, sf_dir, "conversations"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_matches(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = F.array_sort(F.array_distinct(F.transform("_licenses", lambda m: m["license"])))
    return found.select("doc_id", F.size("_licenses").cast("bigint").alias("n_matches"), F.array_join(names, ",").alias("licenses"))


#: The languages' shares that the mixing query asks for: the test tables' sources hold the same kind of text, their
#: languages are what a classifier can tell.
MIX = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing_rates(_table(spark, sf_dir, "documents"), "lang", MIX)
    return mixed.select("doc_id", F.col("_tokens").alias("n_tokens"), *[F.col(f"_p{i}").alias(f"p_{name}") for i, name in enumerate(sorted(MIX))],
                        F.col("_rate").alias("rate"), F.col("_copies").alias("copies"))


#: stands for the secret that a deployment keeps
PII_KEY = "example-key"


def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = pseudonymize(_table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)
    return done.select("doc_id", F.size("_entities").cast("bigint").alias("n_entities"), "text")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, _ = compressed_codes(_table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return verified_manifest(_table(spark, sf_dir, "documents"), _crc(5) == 0, {"text": lowered})


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules(_table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))
    return found.select("doc_id", *[f"_rules.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_minhash_near_dedup, op4_benchmark_decontamination, op5_lm_scoring,
        op9_quality_classifier, op10_toxicity, op6_embedding_near_dedup, op8_chat_formatting,
        op2_license_scan, op3_source_mixing, op7_pii_surrogates,
        op11_vector_codes, op12_merkle_manifest, op13_quality_rules)
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in oracle.ORACLE.items() if k in QUERIES}
