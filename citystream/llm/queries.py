"""The registered queries of the text operators: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from citystream.llm import bpe, chat, decontaminate, html_text, license, packing, prefix_trie, ranked, simhash, topk, toxicity, url_filter, warc
from citystream.llm.common import read_table
from citystream.llm.oracle import ORACLE  # noqa: F401  (read by the entry module with QUERIES)

VOCABULARY = "byte_bpe_multi_50k.tiktoken"

URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
             ("allow", "com/fr/"), ("block", "com/de/")]


def op1_html(spark, sf_dir):
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op2_license(spark, sf_dir):
    """The documents as a file tree: a source is a project, a language a folder
    with a folder for every 100 ids; the short documents are its licence files.
    A document without an id has no path."""
    docs = read_table(spark, sf_dir, "documents")
    name = F.when(F.char_length("text") <= 400, F.concat(F.lit("LICENSE-"), "doc_id")).otherwise(F.concat("doc_id", F.lit(".txt")))
    path = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 100).cast("string"), name)
    return license.scan(docs.select(F.when(F.col("doc_id").isNotNull(), path).alias("path"), "text"))


def op3_warc(spark, sf_dir):
    return warc.archive_round_trip(read_table(spark, sf_dir, "pages"), min_bytes=0)


def op4_bpe(spark, sf_dir):
    ranks = bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    return bpe.round_trip_digests(read_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op5_top_k(spark, sf_dir):
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op6_url_filter(spark, sf_dir):
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"), URL_RULES)


def op7_toxicity(spark, sf_dir):
    return toxicity.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_chat(spark, sf_dir):
    tricky = "\\### Assistant: </turn> ok"
    planted = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                    F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                    F.lit(tricky).alias("text"))
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    back = chat.read_back(chat.format_conversations(turns.unionByName(planted)))
    said = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), "valid")


def op9_simhash(spark, sf_dir):
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op10_decontaminate(spark, sf_dir):
    found = decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op11_ranked(spark, sf_dir):
    return ranked.rank(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=50)


def op12_packing(spark, sf_dir):
    model = packing.load_model(public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), model, size=2048, end_id=0)


def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.trie(read_table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_html, op2_license, op3_warc, op4_bpe, op5_top_k, op6_url_filter, op7_toxicity, op8_chat, op9_simhash, op10_decontaminate,
    op11_ranked, op12_packing, op13_prefix_trie)}
