"""One query per operator, with production parameters over the whole intended table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoutline.llm import (
    collocations,
    conversation_repair,
    decontamination,
    language_id,
    packing,
    passages,
    quality_classifier,
    quality_rules,
    sharding,
    simhash,
    token_counts,
    url_filters,
    warc,
)

#: Where the vocabulary file is; another path can be given to the operator.
TOKENIZER = "word_bpe_49k.json"

URL_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the risk-controlled verdict of every document."""
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op2_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, read back and placed in the capture index."""
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, k=3)


def sequence_length(text: Column) -> Column:
    """Units that a text takes in a training sequence: its words and an end mark, or nothing."""
    words = F.size(quality_rules.words(F.coalesce(text, F.lit(""))))
    return F.when(words > 0, words + 1).otherwise(0)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its bin."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, sequence_length(F.col("text")))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by a model learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    rows = quality_classifier.scored(docs.select("doc_id", "text"), model)
    held_out = quality_classifier.held_out(F.col("doc_id"))
    return rows.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document under the public word BPE vocabulary."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path(TOKENIZER), limit=2048)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items found in them."""
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deciding rule and verdict of every page's URL."""
    rules = url_filters.rule_table(spark, URL_RULES)
    judged = url_filters.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages that a document shares with one of smaller id."""
    return passages.shared_passages(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards and slots of all documents under jump consistent hashing."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document by a model learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    rows = language_id.identified(docs.select("doc_id", "text"), language_id.train(docs))
    held_out = language_id.held_out(F.col("doc_id"))
    return rows.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best-scored phrases of two and three words of every language."""
    return collocations.phrases(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest edits of every damaged conversation."""
    return conversation_repair.repair(conversation_repair.damaged(table(spark, sf_dir, "conversations")))
