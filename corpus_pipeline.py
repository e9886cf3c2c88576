"""From documents to training pieces: quality, near copies, personal data, source mix, encoding.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of ``documents``. Between stages the
rows are written as Parquet in the shared folder and read again, so a lost
executor costs a file read.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import mixing, near_copies, pseudonyms, quality, sentence_pieces
from riskweave.llm.queries_corpus import DOMAIN, WEIGHTS
from riskweave.llm.queries_text import KEY
from riskweave.llm.staging import Staged
from riskweave.session import ship_package

#: Nine tenths of the tokens that reach the stage, each document once at most.
MIX = mixing.Plan(levels=(("domain", DOMAIN), ("lang", "lang"), ("source", "source")), weights=WEIGHTS, budget_share=900, max_epochs=1, seed=7)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules reject go."""
    return docs.where(quality.keep(F.col("text")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents alike by 0.8 or more in five-word shingles, directly or through others, the smallest id stays."""
    return near_copies.keep_one(docs, near_copies.Settings(words=5, percent=80))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by pseudonyms; n_chars follows the text."""
    return docs.withColumn("text", pseudonyms.pseudonymised(F.col("text"), KEY)).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken by the weights of domain, language and source."""
    return mixing.mixed(docs, MIX)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_pieces, n_byte_pieces, round_trip."""
    pieces = sentence_pieces.encoder(spark, public_tokenizers.path("piece_bpe_32k.model"))
    made = docs.select("doc_id", "lang", "source", pieces(F.col("text")).alias("made"))
    return made.select("doc_id", "lang", "source", "made.ids", F.coalesce(F.size("made.ids"), F.lit(0)).cast("long").alias("n_pieces"), "made.n_byte_pieces", "made.round_trip")


def _shipped(stage):
    """The stage after the package has been sent to the Python workers."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("quality rules", _shipped(quality_rules)),
    ("near-copy removal", _shipped(near_dedup)),
    ("personal data", _shipped(personal_data)),
    ("source mix", _shipped(source_mix)),
    ("piece encoding", _shipped(encoding)),
]

#: The last stage's search has no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = Staged(spark, "pipeline")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for place, (_, stage) in enumerate(STAGES):
        docs = staged.write(stage(spark, docs, sf_dir), f"stage{place}")
        if before:
            staged.drop(before)
        before = f"stage{place}"
    return docs
