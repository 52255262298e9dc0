"""Corpus pipeline: quality filter, near-duplicate removal, repeated-passage
removal, benchmark decontamination and packing, each a Spark job over what
the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trackmart.llm.common import stored, table
from trackmart.llm.decontamination import drop_contaminated
from trackmart.llm.near_dedup import keep_first_of_group
from trackmart.llm.packing import pack_stage
from trackmart.llm.quality import drop_rejected
from trackmart.llm.suffix_dedup import remove_repeats

STAGES = [
    ("quality classifier", drop_rejected),
    ("minhash near-dedup", keep_first_of_group),
    ("suffix-array dedup", remove_repeats),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack_stage),
]

# BPE, trees, MinHash and latent vectors have no SQL form; tests/llm holds the
# stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each stage's output written as
    Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{place}")
    return docs
