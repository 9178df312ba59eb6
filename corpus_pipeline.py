"""Corpus pipeline over ``documents``: each stage is one operator, written and read again before the next."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tideline.llm import stages
from tideline.llm.common import table
from tideline.plans.registry import Registry
from tideline.session import cut_lineage

STAGES = [
    ("language", stages.language),
    ("near_duplicates", stages.near_duplicates),
    ("repeated_passages", stages.repeated_passages),
    ("decontaminate", stages.decontaminate),
    ("pack", stages.pack),
]

ORACLE_SQL = None          # models, hashes and byte strings have no SQL; tests compare with a brute-force run


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


pipeline = Registry()
pipeline.add("pipeline", ORACLE_SQL)(run)
