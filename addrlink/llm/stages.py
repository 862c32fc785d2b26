"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns documents, the last one packed pieces."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, jaccard, langid, packing, pii
from .common import table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a language (null, or no letter) go; the others get the one that is predicted, which packing goes by."""
    return langid.keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at five words and a similarity of 0.8 stays: the one of the least id."""
    return jaccard.keep_one(docs, k=5, percent=80)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.drop(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are masked in place; every document stays."""
    return pii.mask(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of what is left, each of one language."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), by="lang")


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("benchmarks", benchmarks), ("personal_data", personal_data), ("packing", sequences)]
