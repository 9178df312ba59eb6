"""Stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame.

Each one works on all its predecessor kept and, but for the last, returns the
columns of ``documents``, whatever they are called.

Defined cases: a row without doc_id passes the middle stages; a null, empty or
letterless text leaves in the language stage, and in the others is one of many
equal, empty texts (one stays); repeated rows share the fate of their doc_id;
an empty table stays empty; a text of any length is handled whole, in one row.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tideline.llm import decontaminate as bench, language_mixture, packing, resemblance, suffix_index
from tideline.llm.common import kept_columns, table

LEAST_SHARE = 0.4          # of a document's words in its main language


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    return docs.join(ids.select("doc_id").distinct(), "doc_id", "left_anti").select(
        *[F.col(f"`{c}`") for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters and those in which no language has that share."""
    model = language_mixture.learn_from(docs)
    return kept_columns(language_mixture.keep_if(docs, model, LEAST_SHARE), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest document of each component of texts that share four fifths of their five-word shingles."""
    labels = resemblance.near_copies(docs)
    return _without(docs, labels.filter("doc_id <> component_id"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove repeated passages from the texts."""
    return kept_columns(suffix_index.without_repeats(docs), docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    found = bench.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, found)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents into sequences."""
    return packing.pack_documents(docs)
