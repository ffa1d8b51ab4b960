"""Documents to packed training sequences, in five stages."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from visittrail.llm import decontaminate, linededup, packing, simhash, toxicity
from visittrail.llm.common import prepare, stored
from visittrail.llm.registry import SEQUENCE, TOKENIZER


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored toxic go; the labels are those of sf_dir."""
    return toxicity.not_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that too many pages of a source hold go."""
    return linededup.line_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by SimHash the one with the smallest doc_id stays."""
    return simhash.one_of_each(docs, shingle=3, distance=3)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items are cut out; documents made of them go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, each with its sequence and place."""
    return packing.packed(docs, public_tokenizers.path(TOKENIZER), length=SEQUENCE)


STAGES = [
    ("toxicity", drop_toxic), ("line_dedup", drop_boilerplate), ("simhash", drop_near_copies),
    ("decontamination", drop_benchmark), ("packing", pack),
]

#: SQL can express neither the classifier nor the packing; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
