"""The corpus pipeline: five stages over ``documents``, each written and read again.

quality rules -> MinHash near-dedup -> benchmark decontamination -> mixing to
target weights -> sharding.  Every stage takes (spark, docs, sf_dir) and
returns a DataFrame; all but the last return the columns of its input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hopgraph.llm.common import table, written
from hopgraph.llm.decontaminate import decontaminate
from hopgraph.llm.mixing import sample
from hopgraph.llm.near_dedup import near_dedup
from hopgraph.llm.quality_rules import quality_rules
from hopgraph.llm.sharding import shard_documents

#: share of the tokens that the mix draws
MIX_BUDGET = 0.9


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the host-level quality rules keep."""
    return quality_rules(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8)."""
    return near_dedup(docs, n=5, percent=80)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target shares of source, language and topic."""
    return sample(docs, budget=MIX_BUDGET, fill=True)


def shard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard: contiguous in doc_id order, near-equal in bytes."""
    own = {"size": "shard_size", "crc": "shard_crc32", "shard": "shard", "slot": "slot"}
    rows = [f"_row.`{c}`" for c in docs.columns if c.lower() not in own.values()]     # the new columns win
    return shard_documents(docs).selectExpr(*rows, *[f"{a} AS {b}" for a, b in own.items()])


STAGES = [
    ("quality_rules", rules_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontaminate_stage),
    ("mixing", mix_stage),
    ("sharding", shard_stage),
]

#: near-duplicate components need iteration; the pipeline is tested against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
