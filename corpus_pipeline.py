"""The corpus pipeline: five stages, each calling one training-data operator.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns
a DataFrame.  All but the last return the columns of ``docs``.  ``run`` writes the result of a
stage to the shared folder and reads it back as the next stage's ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import bpe, decontaminate, quality, secrets, simhash
from cartwheel.llm.common import benchmark, cut, documents, unused


#: What an encoder keeps here: executors have grown to their whole heap in the stages before, and each holds workers besides.
KEPT_STATES = 100_000
KEPT_MATCHES = 150_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest doc_id."""
    return simhash.one_per_group(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, or a passage within the edit distance of one, go."""
    return decontaminate.without_contaminated(docs, benchmark(spark, sf_dir))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by its kind in brackets; ``n_chars`` follows the text."""
    spans = unused(docs, "_spans")
    found = secrets.annotate(docs, into=spans)
    clean = found.withColumn("text", secrets.redact(F.col("text"), F.col(spans))).drop(spans)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the ids of every text that is left and the SHA-256 of the text decoded from them."""
    coded = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, KEPT_STATES, KEPT_MATCHES)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("text", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("byte-level BPE encoding and decoding", byte_bpe),
]

#: XXH64, SimHash and the tokenizer are beyond SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
