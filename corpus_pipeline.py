"""The corpus pipeline: quality rules, near duplicates, secrets, mixing, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillspan.llm import common
from quillspan.llm.mixing import stage_mixing
from quillspan.llm.ngram_join import stage_ngram_join
from quillspan.llm.pieces import stage_sentencepiece
from quillspan.llm.quality_rules import stage_quality_rules
from quillspan.llm.secrets import stage_secret_scans

#: (name, function of (spark, docs, sf_dir)); each works on all that the one before kept.
STAGES = [
    ("quality_rules", stage_quality_rules),
    ("ngram_join", stage_ngram_join),
    ("secret_scans", stage_secret_scans),
    ("mixing", stage_mixing),
    ("sentencepiece", stage_sentencepiece),
]

#: The robust estimates, the joins' classes and the sampler's keys are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written as Parquet and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with common.scratch() as keep:  # what a stage and the one before left goes once its result is written
            before, docs = docs, common.settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
            keep.append(docs)
        common.discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
