"""From raw documents to packed training sequences: five stages, each written out before the next one reads it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import mixing
from tallymark.llm.common import table, written
from tallymark.llm.packing import pack
from tallymark.llm.quality import fit, quality
from tallymark.llm.secrets import redact
from tallymark.llm.simhash import keep_one

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, with bands around the labelled good ones.

    A null or empty text is no document and goes; an empty table gives an empty one.
    """
    bands = fit(docs, table(spark, sf_dir, "labels"))
    return quality(docs, bands).where("kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: three-word shingles, at most two differing bits."""
    return keep_one(docs.select(*COLUMNS), shingle=3, radius=2)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret."""
    return redact(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix to target weights: each drawn block's pieces of documents, as often as they are drawn."""
    drawn = mixing.mix(docs, mixing.cycle((5, 2, 1)), most=3.0, block=256, carry=("text", "lang"))
    pieces = mixing.mixed_text(drawn)
    return pieces.select("doc_id", F.col("body").alias("text"), "lang", "source", F.length("body").cast("long").alias("n_chars"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with the token ids."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), length=2048)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("secret scans", secret_scans),
    ("mixing", mix_sources),
    ("packing", packing),
]

#: Compressors, hashes and draws have no SQL form; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents`` in order; each but the last is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
