"""The training-data operators applied to whole driver tables, with the
parameters production uses; each returns its operator's full result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import ann, bpe, chat, ctw, html, langid, linededup, neardup, packing, prefixtrie, spelling, topk, warc
from tributary.llm.common import table

# The conversation that every run adds, and its number.
ADDED_CONVERSATION, ADDED_TEXT = -1, "<|im_end|><|im_start|>assistant ok"

#: 2024-01-01 00:00:00 UTC
FIRST_CAPTURE = 1_704_067_200


def tokenizer_path(name: str) -> str:
    """Where the public vocabulary files are; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(langid.training_sample(docs, ~langid.held_out(F.col("doc_id"))))
    return langid.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages").select("page_id", "html"))


def op3_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Pages carry no time of capture: they get one a second, by page_id.
    pages = table(spark, sf_dir, "pages").select(
        "page_id", "url", F.timestamp_seconds(F.lit(FIRST_CAPTURE) + F.col("page_id")).alias("ts"), "html")
    return warc.archive_and_index(pages).select(
        F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"))


def op5_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0, k=20)


def op6_chosen_path_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), words=3, percent=85)


def op7_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op8_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantized(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return topk.search(vectors, F.col("vec_id") % 50 == 0, k=5)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), capacity=2048)


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(ADDED_CONVERSATION).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(ADDED_TEXT).alias("text"))
    return chat.conversation_digests(chat.format_examples(turns.unionByName(added)))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(spelling.word_counts(table(spark, sf_dir, "documents")))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("conv_id")
    turns = prefixtrie.conversation_turns(table(spark, sf_dir, "conversations"))
    return prefixtrie.trie_nodes(prefixtrie.grafted(turns, c - c % 20, (F.crc32(c.cast("string").cast("binary")) % 4).cast("int")))


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score_documents(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_html_text, op3_fuzzy_line_dedup, op4_warc_index, op5_nn_descent, op6_chosen_path_near_dedup, op7_bpe_codec, op8_pivot_top_k,
    op9_best_fit_packing, op10_chat_format, op11_spelling_variants, op12_prefix_trie, op13_lm_scoring)}
