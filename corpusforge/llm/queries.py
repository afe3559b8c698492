"""The registered queries of the training-data operators, with their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from corpusforge.llm import chat, html, idstore, lines, middle, mixing, near, packing, quality, resampling, sql, tokens, vectors, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"pipeline": corpus_pipeline.run}
SQL: dict[str, str] = dict(sql.ORACLES)


def register(table: str):
    """Registers a function of one table's DataFrame under its own name."""

    def deco(fn):
        QUERIES[fn.__name__] = lambda spark, sf_dir: fn(spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet"))
        return fn

    return deco


@register("documents")
def op1_order_minhash(documents: DataFrame) -> DataFrame:
    return near.near_classes(documents).drop("key")


@register("documents")
def op2_mix_sources(documents: DataFrame) -> DataFrame:
    return mixing.mix_table(documents)


@register("pages")
def op3_html_extract(pages: DataFrame) -> DataFrame:
    return html.main_text(pages)


@register("conversations")
def op4_chat_prefix_trees(conversations: DataFrame) -> DataFrame:
    return chat.format_table(conversations)


@register("embeddings")
def op5_embedding_dedup(embeddings: DataFrame) -> DataFrame:
    return vectors.vector_classes(embeddings)


@register("documents")
def op6_line_dedup(documents: DataFrame) -> DataFrame:
    return lines.line_digest(documents)


@register("documents")
def op7_token_counts(documents: DataFrame) -> DataFrame:
    return tokens.count_table(documents)


@register("documents")
def op8_pack_sequences(documents: DataFrame) -> DataFrame:
    return packing.pack(documents)


@register("documents")
def op9_quality_rules(documents: DataFrame) -> DataFrame:
    return quality.quality_table(documents)


@register("pages")
def op10_warc_zstd(pages: DataFrame) -> DataFrame:
    return warc.archive_table(pages)


def op11_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet") for t in ("documents", "benchmark"))
    return resampling.resample(documents, benchmark)


QUERIES["op11_importance_resample"] = op11_importance_resample


@register("documents")
def op12_fill_in_middle(documents: DataFrame) -> DataFrame:
    return middle.middle_table(documents)


@register("documents")
def op13_token_ids(documents: DataFrame) -> DataFrame:
    return idstore.id_table(documents)
