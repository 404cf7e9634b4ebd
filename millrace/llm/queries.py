"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .boilerplate import OP3_SQL, line_dedup
from .decontaminate import decontaminate
from .divergence import OP11_SQL, divergence
from .jaccard import OP2_SQL, ngram_jaccard_join
from .line_crf import score_quality
from .lm import held_out_scores
from .merkle import OP13_SQL, verified_manifest
from .mixing import OP9_SQL, mix_sources
from .rules import quality_rules
from .surrogates import replace_pii
from .token_counts import token_counts
from .token_files import token_files
from .warc import OP7_SQL, warc_archive


def vocabulary(name: str) -> str:
    """The path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(_read(spark, sf_dir, "documents"), width=3, threshold=(90, 100))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(_read(spark, sf_dir, "pages"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(_read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_read(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_pii(_read(spark, sf_dir, "documents"), key="registered query")


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_archive(_read(spark, sf_dir, "pages"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_read(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_read(spark, sf_dir, "documents")).drop("distance")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(_read(spark, sf_dir, "documents"))


def op12_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return held_out_scores(_read(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verified_manifest(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_ngram_jaccard_join,
        op3_line_dedup,
        op4_token_files,
        op5_token_counts,
        op6_pii_surrogates,
        op7_warc_revisits,
        op8_quality_classifier,
        op9_source_mixing,
        op10_quality_rules,
        op11_source_divergence,
        op12_lm_scores,
        op13_merkle_manifest,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op2_ngram_jaccard_join": OP2_SQL,
    "op3_line_dedup": OP3_SQL,
    "op7_warc_revisits": OP7_SQL,
    "op9_source_mixing": OP9_SQL,
    "op11_source_divergence": OP11_SQL,
    "op13_merkle_manifest": OP13_SQL,
}
