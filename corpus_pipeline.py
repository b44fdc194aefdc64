"""A corpus from documents: good ones, each text once, one of each near-duplicate group, mixed, encoded."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tickbars.llm import bpe, exact, mix, near, quality
from tickbars.llm.queries import documents, vocabulary
from tickbars.session import discard, settled


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one stays."""
    return exact.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one stays."""
    return near.keep(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a document is left out, stays, or is repeated."""
    return mix.keep(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in place of the text."""
    return bpe.encode(docs, vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("encode", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; each stage is written and read again by the next, and deleted when that is written."""
    docs, written = documents(spark, sf_dir), []
    for name, stage in STAGES[:-1]:
        docs = settled(partial(stage, spark, docs, sf_dir), name)
        discard(*written)
        written = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)


# EM, sketches, seeded blocks and BPE are beyond SQL; tests hold each operator against a brute-force version, run() only by its documents.
ORACLE_SQL = None
