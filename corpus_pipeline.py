"""From raw documents to shards: rules, near-duplicates, benchmark, mixture, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written and read again as the docs
of the next one. All but the last keep the columns of documents.

In every stage NULL and empty texts are texts without a word, columns beyond those of documents are carried along whatever
their names, equal rows are judged alike and stay or go together, and an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gleanwell.llm.decontamination import without_benchmark
from gleanwell.llm.frames import table
from gleanwell.llm.mixing import sample
from gleanwell.llm.near_dups import keep_one_of_each
from gleanwell.llm.quality_rules import keep_good
from gleanwell.llm.resharding import reshard
from gleanwell.storage import write_scratch

#: Share of the tokens that the mixture keeps.
MIXTURE_BUDGET = 0.8


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighted votes of the rules, and the base rules, let pass. Texts under 50 words fail a base rule."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates (five-word shingles, similarity 0.8 or more).

    All rows of that document stay. Rows without id, and documents without a word, are near no other.
    """
    return keep_one_of_each(docs, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark. Rows without id stay."""
    return without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens meet the targets of sources, languages and topics, where NULL is a value of its own."""
    return sample(docs, budget=MIXTURE_BUDGET)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every row; repeated rows have slots of their own."""
    return reshard(docs, old_shards=16, shards=24, kept=("source", "lang"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: Neither the fit of the rules nor sketches and raking can be said in SQL; tests compare with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_scratch(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
