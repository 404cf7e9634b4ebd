"""Typed CSV and JSON sources, and deterministic sinks."""

from __future__ import annotations

import csv
import hashlib
import json
import os
import shutil
import tempfile
from collections.abc import Iterator, Mapping, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schema import Table


def read_typed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header; an empty field is null; a row that does not fit the schema is an error when it is read."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("nullValue", "").option("mode", "FAILFAST").option("multiLine", True).option("escape", '"').option("dateFormat", "yyyy-MM-dd").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss").csv(path)


def read_dataset(spark: SparkSession, folder: str, tables: Mapping[str, Table]) -> dict[str, DataFrame]:
    """All tables of a schema from `<table>.csv` files, in the schema's order."""
    return {name: read_typed(spark, f"{folder}/{name}.csv", t.schema) for name, t in tables.items()}


def open_typed(spark: SparkSession, folder: str, tables: Mapping[str, Table]) -> dict[str, DataFrame]:
    """All tables of a schema as temporary views, for reading alone; a folder or table that is missing is an error before any view is made."""
    missing = [t for t in tables if not os.path.exists(os.path.join(folder, f"{t}.csv"))]
    if not os.path.isdir(folder) or missing:
        raise FileNotFoundError(f"{folder}: no tables {', '.join(missing) or list(tables)}")
    out = read_dataset(spark, folder, tables)
    for name, df in out.items():
        df.createOrReplaceTempView(name)
    return out


def bad_rows(spark: SparkSession, path: str, schema: T.StructType, name: str) -> DataFrame:
    """Rows with a value that does not fit its column, as a quality rule instead of an error."""
    rows = read_text(spark, path)
    wrong = F.lit(False)
    for f in schema:
        wrong = wrong | ((F.col(f.name) != "") & F.col(f.name).try_cast(f.dataType).isNull())
    return rows.where(wrong).agg(F.count("*").cast("long").alias("violations")).select(F.lit(name).alias("check_name"), "violations")


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, with empty fields kept as empty texts."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("emptyValue", "").csv(path).na.fill("")


def read_inferred(spark: SparkSession, path: str) -> DataFrame:
    """A column is a number if every value that is not empty reads as one, and whole if all are; else it is text."""
    text = read_text(spark, path)
    value = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    reads = lambda c, kind: F.coalesce(F.bool_and(F.when(value(c).isNotNull(), value(c).try_cast(kind).isNotNull())), F.lit(False))
    # one pass over the file finds the types of all columns
    found = text.agg(*(F.struct(reads(c, "double").alias("number"), reads(c, "long").alias("whole")).alias(c) for c in text.columns)).first()
    return text.select(*((value(c).cast("long") if found[c].whole else value(c).cast("double") if found[c].number else value(c)).alias(c) for c in text.columns))


def read_pairs(spark: SparkSession, path: str, defaults: Mapping[str, str]) -> DataFrame:
    """Question pairs: columns that a file lacks get their default, and domain and tier come from names like `crm_t3_pairs.csv` where they are missing."""
    rows = read_text(spark, path).withColumn("_file", F.lower(F.element_at(F.split(F.input_file_name(), "/"), -1)))
    for name, value in defaults.items():
        rows = rows.withColumn(name, F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit(value)) if name in rows.columns else F.lit(value))
    guess = {"domain": F.regexp_extract("_file", r"^([a-z]+(?:_management)?)_", 1), "tier": F.upper(F.regexp_extract("_file", r"(?:^|_)(t[1-5])(?:_|\.)", 1))}
    for name, value in guess.items():
        rows = rows.withColumn(name, F.coalesce(F.nullif(F.col(name), F.lit("")), F.nullif(value, F.lit(""))) if name in rows.columns else F.nullif(value, F.lit("")))
    return rows.drop("_file")


def read_runs(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """The rows of run documents, one JSON object a file, or a line, with an array `rows`, beside the run's other fields."""
    runs = spark.read.option("multiLine", not lines).json(path)
    return runs.select(*[c for c in runs.columns if c != "rows"], F.explode("rows").alias("row"))


def distinct_values(df: DataFrame, column: str, most: int = 10_000) -> list:
    """The values of a parameter in order, without null; more than `most` are an error."""
    found = [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column).limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} values")
    return found


def csv_rows(spark: SparkSession, path: str) -> int:
    """Logical records; line ends inside quotes do not count."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).count()


def csv_text(df: DataFrame) -> list[Column]:
    """Columns in their canonical text: lower-case booleans, ISO dates and times, null as the empty text."""
    out = []
    for f in df.schema:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        out.append(F.coalesce(c.cast("string"), F.lit("")).alias(f.name))
    return out


def write_csv(df: DataFrame, path: str, order: Sequence[str], fields: Sequence[str] | None = None) -> None:
    """One local file with a header, UTF-8 and line feeds, sorted by a total order; the same rows give the same bytes.

    With fields, a contract's columns, the file has these in this order, and a column that is missing or not among them is an error.
    Rows come to the driver a partition at a time; the file has its name only once it is whole.
    """
    if fields is not None:
        if set(fields) != set(df.columns):
            raise ValueError(f"columns {sorted(set(df.columns) ^ set(fields))} are in the contract or in the rows, but not in both")
        df = df.select(*fields)
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    handle, temporary = tempfile.mkstemp(dir=target.parent, prefix=f".{target.name}.")
    try:
        with os.fdopen(handle, "w", encoding="utf-8", newline="") as out:
            writer = csv.writer(out, lineterminator="\n")
            writer.writerow(df.columns)
            for row in df.orderBy(*order).select(*csv_text(df)).toLocalIterator():
                writer.writerow(row)
        os.replace(temporary, target)
    except BaseException:
        os.unlink(temporary)
        raise


def file_hash(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def write_manifest(path: str, content: Mapping) -> None:
    """JSON with sorted keys, written last and once; an existing manifest is an error."""
    if os.path.exists(path):
        raise FileExistsError(f"{path}: a release is written once")
    temporary = f"{path}.tmp"
    Path(temporary).write_text(json.dumps(content, sort_keys=True, indent=2, default=str) + "\n", encoding="utf-8")
    os.replace(temporary, path)


def publish(build, target: str) -> None:
    """Call build(folder) on a new folder beside `target` and rename it only if that succeeds."""
    parent = os.path.dirname(os.path.abspath(target))
    os.makedirs(parent, exist_ok=True)
    staging = tempfile.mkdtemp(dir=parent, prefix=".staging-")
    try:
        build(staging)
        old = f"{staging}.old"
        if os.path.exists(target):
            os.rename(target, old)
        os.rename(staging, target)
        shutil.rmtree(old, ignore_errors=True)
    except BaseException:
        shutil.rmtree(staging, ignore_errors=True)
        raise


def batches(df: DataFrame, rows: int, most_bytes: int) -> DataFrame:
    """df's rows as JSON lines in batches: (batch, n, bytes, lines); a batch ends before it passes either bound.

    Batches are made within partitions, so that no task sees more than its own rows; a row that is larger than the bound is a batch of its own.
    """
    import pandas as pd

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        task, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def emit() -> pd.DataFrame:
            return pd.DataFrame({"batch": [f"{task:06d}-{number:06d}"], "n": [len(held)], "bytes": [size], "lines": ["\n".join(held)]})

        for frame in frames:
            for line in frame["line"]:
                cost = len(line.encode())
                if held and (len(held) >= rows or size + cost > most_bytes):
                    yield emit()
                    number, held, size = number + 1, [], 0
                held.append(line)
                size += cost
        if held:
            yield emit()

    return df.select(F.to_json(F.struct(*df.columns)).alias("line")).mapInPandas(run, "batch string, n long, bytes long, lines string")
