"""One query per operator over the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from zonalake.llm import (
    decontam, exact, lines, mixing, neardup, pages, periodic, phrases, pieces, quality, suffixes, tokens, warc,
)
from zonalake.llm.shipping import ship_package

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_components(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_report(table(spark, sf_dir, "pages"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(table(spark, sf_dir, "pages"))


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_report(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.keep_flags(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_report(table(spark, sf_dir, "documents"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_report(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def queries() -> dict[str, Query]:
    found = (
        op1_decontamination, op2_quality, op3_suffix_dedup, op4_near_dedup, op5_warc, op6_html_text, op7_token_output,
        op8_line_dedup, op9_exact_dedup, op10_mixing, op11_periodic_runs, op12_phrases, op13_pieces,
    )
    return {query.__name__: query for query in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op8_line_dedup": lines.REPORT_SQL,
        "op9_exact_dedup": exact.REPORT_SQL,
        "op10_mixing": mixing.report_sql(),
        "op12_phrases": phrases.REPORT_SQL,
    }
