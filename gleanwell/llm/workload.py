"""Registered queries of this package, each an operator over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwell.llm.decontamination import overlaps
from gleanwell.llm.frames import remainder, table
from gleanwell.llm.id_files import id_index, write_ids
from gleanwell.llm.language_id import identify
from gleanwell.llm.lexical_search import top_documents
from gleanwell.llm.lm_scoring import score_texts
from gleanwell.llm.mixing import mix
from gleanwell.llm.near_dups import near_duplicates
from gleanwell.llm.prefix_trie import prefix_trie
from gleanwell.llm.quality_cnn import classify
from gleanwell.llm.quality_rules import judge
from gleanwell.llm.repeats import remove_repeats
from gleanwell.llm.resharding import reshard
from gleanwell.llm.token_counts import Vocabulary, count_tokens
from gleanwell.storage import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return score_texts(table(spark, folder, "documents"), remainder("doc_id", 5) == 1)


@query
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    texts = table(spark, folder, "documents").select("doc_id", "text")
    judged = judge(texts.select("doc_id", "text"), into="q")
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior", "votes")
    return judged.select("doc_id", *[f"q.{x}" for x in fields])


@query
def op6_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), percent=85)


@query
def op9_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    removed = remove_repeats(table(spark, folder, "documents"))
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = reshard(table(spark, folder, "documents"), old_shards=16, shards=24)
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown, "old_shard")


@query
def op4_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents"))


@query
def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return identify(table(spark, folder, "documents"), remainder("doc_id", 4) == 2)


@query
def op10_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    texts, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return classify(texts, labels, remainder("doc_id", 5) == 0)


@query
def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(table(spark, folder, "documents"), Vocabulary.read())


@query
def op11_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    files = scratch_path(spark, "token_ids")
    write_ids(table(spark, folder, "documents"), files, public_tokenizers.path("word_bpe_49k.json"))
    return id_index(spark, files)


@query
def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return top_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"), best=50)


@query
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(table(spark, folder, "conversations"))
