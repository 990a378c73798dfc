"""The queries of the subpackage, each over its whole table, and SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .alignment import align
from .block_names import SQL as EXACT_DEDUP_SQL, exact_dedup
from .bpe import bpe_encode
from .decontaminate import contamination
from .html_blocks import extract
from .jaccard_join import jaccard_join
from .language import held_out, predict, train
from .line_dedup import SQL as LINE_DEDUP_SQL, line_dedup
from .order_minhash import fingerprints
from .resample import resample
from .secrets import SQL as SECRETS_SQL, secret_report
from .unigram import token_counts
from .warc import warc_round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query
def op8_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join(_table(spark, folder, "documents"))


@_query
def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_encode(_table(spark, folder, "documents"), digests=True)


@_query
def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(_table(spark, folder, "documents"))


@_query
def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    digest = F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


@_query
def op10_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints(_table(spark, folder, "documents"))


@_query
def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    held = held_out(F.col("doc_id"))
    found = predict(train(docs.filter(~held)), docs)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


@_query
def op2_secret_links(spark: SparkSession, folder: str) -> DataFrame:
    return secret_report(_table(spark, folder, "documents"))


SQL["op2_secret_links"] = SECRETS_SQL


@_query
def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup(_table(spark, folder, "documents"))
    return found.select("doc_id", "source", "text", "n_lines", "n_dropped")


SQL["op7_line_dedup"] = LINE_DEDUP_SQL


@_query
def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc_round_trip(_table(spark, folder, "pages"))


@_query
def op4_html_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return extract(_table(spark, folder, "pages"))


@_query
def op11_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(_table(spark, folder, "documents"))


SQL["op11_exact_dedup"] = EXACT_DEDUP_SQL


@_query
def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align(_table(spark, folder, "documents"))


@_query
def op13_resample(spark: SparkSession, folder: str) -> DataFrame:
    return resample(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
