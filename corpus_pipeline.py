"""A corpus from raw documents: toxic ones go, near-duplicates and benchmark leaks go, personal data is replaced, rates are fitted.

Every stage is a function (spark, docs, sf_dir) -> DataFrame over all that the
one before kept; ``run`` writes each stage's rows as Parquet in the shared
checkpoint folder and reads them again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from switchboard.llm.decontaminate import contaminated_spans
from switchboard.llm.minhash import near_duplicates
from switchboard.llm.mixing import mixing_rates
from switchboard.llm.registry import MIX, PII_KEY
from switchboard.llm.scratch import Scratch
from switchboard.llm.surrogates import pseudonymize
from switchboard.llm.toxicity import toxicity_scores


#: the columns of documents, which every stage but the last returns (and others that the table may have)
DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")


def _plain(docs: DataFrame) -> DataFrame:
    """doc_id and text in the types that the operators' keys are hashes of, whatever integer type the table has."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose (doc_id, text) is none of ``gone``(doc_id, key), key being the hash of both."""
    doc_id = F.col("doc_id").cast("bigint")
    key = F.struct(doc_id, F.xxhash64(doc_id, F.col("text").cast("string")))
    g = gone.select(F.struct(F.col("doc_id").cast("bigint"), "key").alias("_gone")).distinct()
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), key.alias("_key"))
    return row.join(g, F.col("_key") == F.col("_gone"), "left_anti").select("_row.*")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.7 or more go; the classifier may learn from all labelled rows."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    beside = [c for c in docs.columns if c != "text"]
    scored = toxicity_scores(docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in beside]).alias("row")), labels, F.lit(False), threshold=0.7)
    return scored.where("_predicted = 0").select(*[F.col(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies (five-word shingles, 0.8) the smallest doc_id stays; exact repeats of a row are one."""
    found = near_duplicates(_plain(docs), k=5, threshold=80)
    return _without(docs, found.where("not kept")).dropDuplicates(["doc_id", "text"]).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item (or a whole shorter item) go."""
    found = contaminated_spans(_plain(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)
    return _without(docs, found.where("spans is not null"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by surrogates; n_chars follows the text."""
    beside = [c for c in docs.columns if c != "text"]
    done = pseudonymize(docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in beside]).alias("row")), PII_KEY)
    n_chars = F.when(F.size("_entities") > 0, F.length("text")).otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType)
    at = {"text": F.col("text"), "n_chars": n_chars.alias("n_chars")}
    return done.select(*[at.get(c, F.col(f"row.`{c}`")) for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus in the target weights: each document that is taken, with how often (``copies``, from the fitted ``rate``)."""
    key = F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    mixed = mixing_rates(docs.select(key.alias("doc_id"), "text", "lang"), "lang", MIX)
    rates = mixed.groupBy(F.col("doc_id").alias("_key")).agg(F.max(F.struct(
        F.col("_copies").alias("copies"), F.col("_rate").alias("rate"), F.col("_tokens").alias("n_tokens"),
        *[F.col(f"_p{i}").alias(f"p_{n}") for i, n in enumerate(sorted(MIX))])).alias("_mix")).where("_mix.copies > 0")
    row = docs.select(F.struct(*DOCUMENTS).alias("_row"), key.alias("_key"))
    return row.join(rates, "_key").select("_row.*", "_mix.*")


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("personal_data", personal_data), ("mixing", mixing)]

#: Learned scores, keyed surrogates and the fitted rates are not SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
