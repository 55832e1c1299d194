"""The registered queries of the operators, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftwise.llm import (
    bpe,
    decontaminate,
    html_blocks,
    importance,
    licences,
    line_dedup,
    ngram_join,
    prefix_trie,
    quality,
    suffix_tree,
    token_counts,
    warc,
    wavelet,
)
from liftwise.llm.batches import table
from liftwise.session import scratch, tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = lambda spark, folder: build(tune(spark), folder)
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query("op1_edit_token_counts")
def _(spark, folder):
    """Three edits per document: a word put in a third of the way, twelve characters cut out
    two thirds of the way, a word at the end."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    size = F.coalesce(F.char_length("text"), F.lit(0))

    def edit(start, length, insert):
        return F.struct(
            start.cast("int").alias("start"), F.lit(length).alias("length"),
            F.coalesce(insert, F.lit("")).alias("insert"),
        )

    edits = F.array(
        edit(F.floor(size / 3), 5, F.concat(F.lit(" "), "lang", F.lit(" "))),
        edit(F.floor(size * 2 / 3), 12, F.lit("")),
        edit(size, 0, F.concat(F.lit(" "), "source")),
    )
    trees = token_counts.build_trees(docs, path).withColumnRenamed("n_tokens", "n_before")
    return token_counts.edit_trees(trees, edits, path).select(
        "doc_id", "n_before", "n_tokens", "n_leaves", "n_encoded",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
    )


@query("op2_bpe_automaton")
def _(spark, folder):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.encoding_digests(docs, path).drop("text")


@query("op3_quality_rules")
def _(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, folder, "labels"))
    return quality.judge(docs, model).drop("text")


@query("op4_jaccard_join")
def _(spark, folder):
    return ngram_join.jaccard_components(table(spark, folder, "documents"))


@query("op5_line_dedup", line_dedup.ORACLE)
def _(spark, folder):
    return line_dedup.line_digests(table(spark, folder, "documents"))


@query("op6_decontamination")
def _(spark, folder):
    return decontaminate.contaminated(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


@query("op7_wavelet_shards")
def _(spark, folder):
    path = public_tokenizers.path("word_bpe_49k.json")
    return wavelet.round_trip(table(spark, folder, "documents"), path)


@query("op10_suffix_tree_scores")
def _(spark, folder):
    return suffix_tree.score_documents(table(spark, folder, "documents"))


@query("op8_html_blocks")
def _(spark, folder):
    pages = table(spark, folder, "pages")
    return html_blocks.main_text(pages, html_blocks.fit(pages))


@query("op9_licence_scan")
def _(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return licences.scan_licences(docs).drop("text")


@query("op11_warc_revisits", warc.ORACLE)
def _(spark, folder):
    path = scratch(spark, "archives")
    warc.write_archives(warc.page_records(table(spark, folder, "pages")), path)
    return warc.read_archives(spark, path, payload=False).select(
        F.col("source_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", F.col("refers_to_source").cast("long").alias("refers_to"),
    )


@query("op12_importance_resampling", importance.ORACLE)
def _(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = importance.resampled(docs, table(spark, folder, "benchmark").select("text"))
    return found.drop("n_words")


@query("op13_prefix_trie")
def _(spark, folder):
    turns = prefix_trie.turn_ids(table(spark, folder, "conversations"))
    return prefix_trie.trie(prefix_trie.rebuilt(turns))
