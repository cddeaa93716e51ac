"""The corpus operators as queries over the given tables, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm import bpe, fim, kdsearch, licenses, neardup, pagetext, quality, shards, sql, suffixes, tiling, urls, warc, whitening
from tallybrook.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("op1_decontamination")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that documents hold."""
    return tiling.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_quality")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and decision for every document."""
    return quality.score_documents(table(spark, sf_dir, "documents"))


@query("op3_shards", sql.OP3)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 contiguous shards of nearly equal bytes."""
    return shards.shard_documents(table(spark, sf_dir, "documents"), 24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op4_warc", sql.OP4)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through ARC archives to WARC files and back."""
    return warc.archive_round_trip(table(spark, sf_dir, "pages")).drop("record_id")


@query("op5_url_filter", sql.OP5)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    return urls.judge_pages(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query("op6_ngram_join")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's near-duplicate class and its number of links."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


@query("op7_kd_search", sql.OP7)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best partners of every fiftieth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return kdsearch.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


@query("op8_byte_bpe")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of every document's ids and decoded bytes."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.token_digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@query("op9_licenses")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licences of every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op10_suffix_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 400-byte strings that occur twice, and its repeated passages."""
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"), passages=True)


@query("op11_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's first 16 whitened components."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), 16)


@query("op12_page_text", sql.OP12)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return pagetext.extract_text(table(spark, sf_dir, "pages")).drop("n_template")


@query("op13_fill_in_middle", sql.OP13)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's cuts, form, and digests of the output and of the text rebuilt from it."""
    outputs = fim.transform(table(spark, sf_dir, "documents"), fim.Setting(seed=7, rate=100, spm_rate=50))
    return fim.restored(outputs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("text", 256).alias("restored_sha256"),
    )


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
