"""Documents to a training file: quality rules, near copies, benchmark leaks, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and gets what its predecessor kept, written
as Parquet and read again. All stages but the last return the columns of documents.
No stage can be expressed in SQL as a whole, so ORACLE_SQL is None and the tests hold
each stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.decontaminate import decontaminate
from millrace.llm.jaccard import ngram_jaccard_join
from millrace.llm.mixing import curriculum
from millrace.llm.queries import vocabulary
from millrace.llm.rules import quality_rules
from millrace.llm.scratch import Scratch
from millrace.llm.token_files import token_files

ORACLE_SQL = None


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a 64-bit hash of each whole row, and that column's name: decisions are about rows, whatever their ids.

    Rows that agree in every column get the same decisions. Null and repeated ids are ids like others.
    """
    name = "_row"
    while name in docs.columns:
        name += "_"
    return docs.withColumn(name, F.xxhash64(*docs.columns)), name


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality rules reject."""
    rows, key = _keyed(docs)
    kept = quality_rules(rows, id_col=key).where("kept").select(key)
    return rows.join(kept, key, "left_semi").select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near copies (five words, 0.8), null ids last; of equal ids that with the smallest row hash.

    Rows that agree in every column are copies of each other, and one stays. Texts without words are no copies: all of them stay but equal rows.
    """
    rows, key = _keyed(docs)
    groups = ngram_jaccard_join(rows, id_col=key).select(key, "component_id").distinct()
    ids = rows.select(key, F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", key).alias("rank"))
    # least ids are found by aggregations that are combined before the shuffle
    first = groups.join(ids, key).groupBy("component_id").agg(F.min("rank").alias("rank")).select(F.col("rank")[key].alias(key))
    return rows.join(first, key, "left_semi").dropDuplicates([key]).select(*docs.columns)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a passage of the benchmark."""
    rows, key = _keyed(docs)
    found = decontaminate(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=key).select(key).distinct()
    return rows.join(found, key, "left_anti").select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, in training order."""
    return curriculum(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files and returns what they hold, a row per document."""
    return token_files(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [("quality rules", rules), ("n-gram jaccard join", near_copies), ("benchmark decontamination", leaks), ("mixing sources", mixing), ("token output", token_ids)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents in sf_dir."""
    scratch, docs = Scratch(spark, "pipeline"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
