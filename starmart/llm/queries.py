"""The corpus operators as queries over the whole test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starmart.llm import (
    clustering,
    decontaminate,
    lm_scoring,
    mixing,
    near_dup,
    packing,
    quality_model,
    quality_rules,
    repeats,
    resampling,
    sharding,
    token_counts,
    token_files,
)
from starmart.sources.files import read_parquet, store

Query = Callable[[SparkSession, str], DataFrame]

# Records of one Arrow batch; with bytes bounded as well, a batch of long texts stays small.
BATCH_ROWS = 1_000
# The vocabulary files of the registered queries; every operator takes a path.
VOCABULARY = "byte_bpe_50k.json"
PACKED_VOCABULARY = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    rows = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    if not 0 < int(rows) <= BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    table = read_parquet(spark, sf_dir, name)
    return table.select(*columns) if columns else table


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return decontaminate.digest(decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark")))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(mixing.mix_sizes(table(spark, sf_dir, "documents", "doc_id", "source", "text")))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return token_files.digest(token_files.read_blocks(spark, token_files.write_token_files(docs, vocabulary_path())))


def op5_edited_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts before and after redaction of every document, from trees kept as a table."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    trees = store(token_counts.build_trees(docs, vocabulary_path()), "token_trees")
    edits = store(token_counts.redactions(docs), "token_edits")
    return token_counts.edited_counts(docs, trees, edits, vocabulary_path())


def op6_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(repeats.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text")))


def op7_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return sharding.digest(sharding.read_shards(docs, sharding.write_shards(docs)))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return near_dup.digest(near_dup.near_duplicates(docs, near_dup.Index(shingle=2)))


def op9_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    return quality_model.digest(quality_model.score_quality(docs, labels, carry=["doc_id"]))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "lang", "text")
    labels = table(spark, sf_dir, "labels")
    return quality_rules.digest(quality_rules.apply_rules(docs, labels, carry=["doc_id", "lang"]))


def op11_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.digest(*clustering.cluster(table(spark, sf_dir, "embeddings", "vec_id", "embedding")))


def op12_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.digest(packing.read_packed(spark, packing.write_packed(docs, vocabulary_path(PACKED_VOCABULARY))))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    weighed = resampling.weigh(docs, table(spark, sf_dir, "benchmark", "text"))
    return resampling.digest(resampling.draw(weighed))


def all_queries() -> dict[str, Query]:
    return {
        "op1_decontaminate": op1_decontaminate,
        "op2_mix_sources": op2_mix_sources,
        "op3_lm_score": op3_lm_score,
        "op4_token_files": op4_token_files,
        "op5_edited_token_counts": op5_edited_token_counts,
        "op6_remove_repeats": op6_remove_repeats,
        "op7_shard": op7_shard,
        "op8_near_duplicates": op8_near_duplicates,
        "op9_quality_score": op9_quality_score,
        "op10_quality_rules": op10_quality_rules,
        "op11_cluster": op11_cluster,
        "op12_pack": op12_pack,
        "op13_resample": op13_resample,
    }
