"""Corpus pipeline: stages over documents, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sqlweave.llm.decontaminate import decontaminate_stage
from sqlweave.llm.mixing import mixing_stage
from sqlweave.llm.quality import quality_stage
from sqlweave.llm.sketch_dedup import dedup_stage
from sqlweave.llm.token_files import token_stage
from sqlweave.session import scratch_path

#: (name, function of (spark, docs, sf_dir)); all but the last return the columns of docs
STAGES = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", dedup_stage),
    ("benchmark decontamination", decontaminate_stage),
    ("mixing sources to target weights", mixing_stage),
    ("token-ID output", token_stage),
]

#: SQL cannot express the stages (a trained model, sketches, a tokenizer): checked by brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "_"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
