"""Canonical answer strings of small results, their hashes, and digests of tables."""

from __future__ import annotations

import datetime
import hashlib
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Parts of a column's name that make it a percentage, looked for first, or money.
PERCENT_NAMES = ("pct", "percent", "rate", "ratio", "change")
MONEY_NAMES = ("budget", "amount", "value", "revenue", "spend", "cost")


def two_places(name: str) -> bool:
    low = name.lower()
    return any(x in low for x in PERCENT_NAMES + MONEY_NAMES)


def cell(value, name: str = "") -> str:
    """One value as text; null is empty, money and percentages have two decimals, whole numbers none."""
    match value:
        case None:
            return ""
        case bool():
            return str(value).lower()
        case datetime.datetime():
            plain = value.replace(microsecond=0)
            return value.date().isoformat() if value.time() == datetime.time() else plain.isoformat()
        case datetime.date():
            return value.isoformat()
        case Decimal() | float():
            exact = value if isinstance(value, Decimal) else Decimal(repr(value))
            if two_places(name):
                return str(exact.quantize(Decimal("0.01"), ROUND_HALF_UP))
            if exact == exact.to_integral_value():
                return str(int(exact))
            return str(value)
    return str(value)


@dataclass(frozen=True)
class Answer:
    """status is ok or blocked; a blocked result, with no row or a single null, has no text."""

    status: str
    text: str | None
    rows: int
    columns: tuple[str, ...]
    types: tuple[str, ...]

    @property
    def hash(self) -> str | None:
        return None if self.text is None else hashlib.sha256(self.text.encode()).hexdigest()


def answer(result: DataFrame, most_rows: int = 10_000) -> Answer:
    """The canonical answer of a query result; more rows than `most_rows` are no answer but an error."""
    rows = [tuple(r) for r in result.limit(most_rows + 1).collect()]
    if len(rows) > most_rows:
        raise ValueError(f"an answer has at most {most_rows} rows")
    types = tuple(f.dataType.simpleString() for f in result.schema)
    blocked = not rows or (len(rows) == 1 and len(result.columns) == 1 and rows[0][0] is None)
    text = None if blocked else "; ".join(" | ".join(map(cell, r, result.columns)) for r in rows)
    return Answer("blocked" if blocked else "ok", text, len(rows), tuple(result.columns), types)


def cell_column(df: DataFrame, name: str):
    """`cell` as a column expression, for results that stay distributed."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.BooleanType):
        out = F.when(c, "true").otherwise("false")
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        out = F.when(c == F.date_trunc("day", c), F.date_format(c, "yyyy-MM-dd")).otherwise(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"))
    elif isinstance(kind, (T.DecimalType, T.DoubleType, T.FloatType)):
        exact = c if isinstance(kind, T.DecimalType) else c.cast("string").cast("decimal(38,10)")
        trimmed = F.regexp_replace(exact.cast("string"), r"(\.\d*?)0+$", "$1")
        out = F.round(exact, 2).cast("decimal(38,2)").cast("string") if two_places(name) else F.regexp_replace(trimmed, r"\.$", "")
    else:
        out = c.cast("string")
    return F.when(c.isNull(), "").otherwise(out)


def answer_lines(df: DataFrame) -> DataFrame:
    """(line) for each row: its cells joined by ' | '."""
    return df.select(F.concat_ws(" | ", *(cell_column(df, c) for c in df.columns)).alias("line"))


def row_hash(columns: Sequence[str]) -> Column:
    """The MD5 of a row: its columns by name as text, with nulls as \\N."""
    return F.md5(F.concat_ws("|", *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(r"\N")) for c in sorted(columns))))


def hash_sums(hashed: str) -> list[Column]:
    """Two aggregates, s1 and s16: sums of 60 bits of each hash, which add up from the sums of parts."""
    part = lambda at: F.conv(F.substring(hashed, at, 15), 16, 10).cast("decimal(38,0)")
    return [F.coalesce(F.sum(part(at)), F.lit(0)).cast("decimal(38,0)").alias(f"s{at}") for at in (1, 16)]


def digest_of(*sums: str) -> Column:
    """The SHA-256 of a number of rows and their sums."""
    return F.sha2(F.concat_ws(":", *(F.col(s).cast("string") for s in sums)), 256)


def table_digest(df: DataFrame) -> DataFrame:
    """(rows, digest) of a table, whatever the order and partitioning of its rows; combined before any shuffle.

    The digest is the SHA-256 of the number of rows and two sums of 60 bits of each row's MD5, over its
    columns by name as text, with nulls as \\N. Repeated rows count as often as they occur.
    """
    sums = df.select(row_hash(df.columns).alias("h")).agg(F.count("*").alias("rows"), *hash_sums("h"))
    return sums.select("rows", digest_of("rows", "s1", "s16").alias("digest"))


def fingerprint(parts: Mapping[str, object]) -> str:
    """SHA-256 of versions, schemas, file hashes and digests, whatever their order."""
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str, separators=(",", ":")).encode()).hexdigest()


def stale(built: Mapping[str, object], now: Mapping[str, object]) -> list[str]:
    """What differs between a build's stamp and the present state; empty if it is fresh."""
    return [f"{k}: {built.get(k)!r} is now {now.get(k)!r}" for k in sorted({*built, *now}) if built.get(k) != now.get(k)]


def require_fresh(built: Mapping[str, object], now: Mapping[str, object]) -> None:
    """An error that names all differences between a build's stamp and the present state."""
    if found := stale(built, now):
        raise RuntimeError("the build is stale: " + "; ".join(found))


def even_sample(items: Sequence, n: int) -> list:
    """n items at even ranks, the first and the last among them."""
    if n >= len(items):
        return list(items)
    if n == 1:
        return [items[0]]
    return [items[round(i * (len(items) - 1) / (n - 1))] for i in range(n)]
