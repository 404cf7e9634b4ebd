"""Table schemas from a subset of DDL: columns for the reader, constraints as quality rules."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from millrace.operators import quality

_TYPES = {"INTEGER": T.IntegerType(), "BOOLEAN": T.BooleanType(), "DATE": T.DateType(), "TIMESTAMP": T.TimestampNTZType()}


def column_type(text: str) -> T.DataType:
    """INTEGER, BOOLEAN, DATE, TIMESTAMP, VARCHAR(n), CHAR(n) or DECIMAL(p, s); all else is an error."""
    name = re.sub(r"\s+", "", text.upper())
    if name in _TYPES:
        return _TYPES[name]
    if re.fullmatch(r"(VARCHAR|CHAR)\(\d+\)", name):
        return T.StringType()
    if m := re.fullmatch(r"DECIMAL\((\d+),(\d+)\)", name):
        return T.DecimalType(int(m[1]), int(m[2]))
    raise ValueError(f"unsupported column type: {text}")


@dataclass
class Table:
    name: str
    schema: T.StructType
    primary_key: tuple[str, ...] = ()
    unique: list[tuple[str, ...]] = field(default_factory=list)
    foreign: list[tuple[str, str, str]] = field(default_factory=list)
    checks: list[str] = field(default_factory=list)
    lengths: dict[str, int] = field(default_factory=dict)

    def rules(self, df: DataFrame, tables: dict[str, DataFrame]) -> list[DataFrame]:
        """Every declared constraint as a rule over loaded tables."""
        needed = [f.name for f in self.schema if not f.nullable]
        out = [quality.not_null(df, needed, f"{self.name}: not null")] if needed else []
        if self.primary_key:
            out.append(quality.primary_key(df, self.primary_key, f"{self.name}: primary key"))
        out += [quality.unique(df, keys, f"{self.name}: unique {', '.join(keys)}") for keys in self.unique]
        out += [quality.foreign_key(df, c, tables[t], k, f"{self.name}.{c}: references {t}") for c, t, k in self.foreign if t in tables]
        from pyspark.sql import functions as F

        out += [quality.where_violated(df, f"{self.name}: check {text}", ~F.expr(text)) for text in self.checks]
        out += [quality.where_violated(df, f"{self.name}.{c}: at most {n} characters", F.length(c) > n) for c, n in self.lengths.items()]
        return out


def _split(body: str) -> list[str]:
    """Parts between commas that are not inside parentheses or quotes."""
    parts, depth, quoted, now = [], 0, False, ""
    for c in body:
        quoted ^= c == "'"
        depth += (c == "(") - (c == ")") if not quoted else 0
        if c == "," and not depth and not quoted:
            parts.append(now.strip())
            now = ""
        else:
            now += c
    return [p for p in [*parts, now.strip()] if p]


def _names(text: str) -> tuple[str, ...]:
    return tuple(x.strip().strip('"') for x in text.split(","))


def parse_ddl(text: str) -> dict[str, Table]:
    """The tables of CREATE TABLE statements, in their order; other statements and comments are left out."""
    text = re.sub(r"--[^\n]*", "", text)
    tables = {}
    for statement in re.split(r";", text):
        if not (m := re.match(r"\s*CREATE\s+TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?\"?(\w+)\"?\s*\((.*)\)\s*$", statement, re.I | re.S)):
            continue
        table = Table(m[1], T.StructType())
        for part in _split(re.sub(r"\s+", " ", m[2])):
            part = re.sub(r"^CONSTRAINT \S+ ", "", part, flags=re.I)
            if k := re.match(r"PRIMARY KEY ?\(([^)]*)\)", part, re.I):
                table.primary_key = _names(k[1])
            elif k := re.match(r"UNIQUE ?\(([^)]*)\)", part, re.I):
                table.unique.append(_names(k[1]))
            elif k := re.match(r"FOREIGN KEY ?\((\w+)\) REFERENCES (\w+) ?\((\w+)\)", part, re.I):
                table.foreign.append((k[1], k[2], k[3]))
            elif k := re.match(r"CHECK ?\((.*)\)$", part, re.I):
                table.checks.append(k[1].strip())
            else:
                _column(table, part)
        tables[table.name] = table
    return tables


def _column(table: Table, part: str) -> None:
    m = re.match(r"\"?(\w+)\"? (\w+(?: ?\([^)]*\))?)(.*)$", part)
    if not m:
        raise ValueError(f"{table.name}: cannot read column {part!r}")
    name, kind, rest = m[1], m[2], m[3]
    primary = bool(re.search(r"PRIMARY KEY", rest, re.I))
    table.schema.add(name, column_type(kind), nullable=not (primary or re.search(r"NOT NULL", rest, re.I)))
    if size := re.match(r"(?:VAR)?CHAR ?\((\d+)\)", kind, re.I):
        table.lengths[name] = int(size[1])
    if primary:
        table.primary_key = (name,)
    if re.search(r"\bUNIQUE\b", rest, re.I):
        table.unique.append((name,))
    if k := re.search(r"REFERENCES (\w+) ?\((\w+)\)", rest, re.I):
        table.foreign.append((name, k[1], k[2]))
    if k := re.search(r"CHECK ?\((.*)\)", rest, re.I):
        table.checks.append(k[1].strip())
