"""Batches of an ordered table that keep bounds of rows and bytes over all of it, whatever its partitions.

Where a batch ends depends on where it began, and so on all rows before. What a block of rows makes of the open
batch that it is handed is a function with few arguments: how many of its first rows still fit. Each partition
gives this function as one row; functions of neighbours are composed in groups, level by level; the open batch
at the start of each partition follows from above, and one more pass numbers the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import cut

#: A line's part in a batch beside its own bytes: the array's brackets and separators, two bytes for each row.
AROUND = 2
FUNCTION = "block long, n long, total long, heads array<long>, starts array<long>, tail_n array<long>, tail_b array<long>"
CARRY = "block long, open_n long, open_b long, begun long"


@dataclass(frozen=True)
class Bounds:
    rows: int
    most_bytes: int

    def fitting(self, heads: np.ndarray, n, b):
        """How many of the rows with the cumulative costs `heads` still fit behind n rows of b bytes; a batch that has not begun takes none."""
        room = np.searchsorted(heads, self.most_bytes - np.asarray(b), side="right") - 1
        return np.where(np.asarray(n) == 0, 0, np.clip(np.minimum(self.rows - np.asarray(n), room), 0, None))


@dataclass(frozen=True)
class Block:
    """n rows of `total` bytes; heads are the cumulative costs of the rows that one batch can hold at most.

    If the first batch to begin in the block begins at its row s, starts[s] batches begin in it and the last has
    tail_n[s] rows of tail_b[s] bytes at its end.
    """

    n: int
    total: int
    heads: np.ndarray
    starts: np.ndarray
    tail_n: np.ndarray
    tail_b: np.ndarray

    @classmethod
    def of(cls, row) -> Block:
        return cls(int(row.n), int(row.total), *(np.asarray(getattr(row, c), dtype=np.int64) for c in ("heads", "starts", "tail_n", "tail_b")))

    def row(self, number: int) -> dict:
        return {"block": number, "n": self.n, "total": self.total, "heads": self.heads, "starts": self.starts, "tail_n": self.tail_n, "tail_b": self.tail_b}

    def after(self, bounds: Bounds, n, b):
        """(open rows, open bytes, batches begun) behind the block, for open batches before it."""
        s = bounds.fitting(self.heads, n, b)
        inside, at = s < self.n, np.minimum(s, self.n - 1)
        return np.where(inside, self.tail_n[at], n + self.n), np.where(inside, self.tail_b[at], b + self.total), np.where(inside, self.starts[at], 0)


def leaf(costs: np.ndarray, bounds: Bounds) -> Block:
    """The function of a partition's rows."""
    n, sums = len(costs), np.concatenate([[0], np.cumsum(costs)])
    at = np.arange(n)
    following = np.clip(np.minimum(at + bounds.rows, np.searchsorted(sums, sums[:-1] + bounds.most_bytes, side="right") - 1), at + 1, n)
    last, begun = np.where(following < n, following, at), (following < n).astype(np.int64)
    while True:
        further = last[last]
        if np.array_equal(further, last):
            break
        begun, last = begun + begun[last], further
    fit = min(bounds.rows, n, int(np.searchsorted(sums, bounds.most_bytes, side="right")) - 1)
    entries = last[: min(max(fit, 0), n - 1) + 1]
    return Block(n, int(sums[n]), sums[: max(fit, 0) + 1], 1 + begun[: len(entries)], n - entries, sums[n] - sums[entries])


def composed(blocks: Sequence[Block], bounds: Bounds) -> Block:
    """The function of consecutive blocks."""
    n, total, heads, entries = 0, 0, [np.zeros(1, dtype=np.int64)], []
    for i, block in enumerate(blocks):
        # the first batch's rows reach into this block only if all blocks before are part of it
        if n == sum(map(len, heads)) - 1:
            s = np.arange(len(block.starts))
            s = s[(s + n <= bounds.rows) & (block.heads[s] + total <= bounds.most_bytes)] if n else s
            open_n, open_b, begun = block.tail_n[s], block.tail_b[s], block.starts[s]
            for later in blocks[i + 1 :]:
                open_n, open_b, more = later.after(bounds, open_n, open_b)
                begun = begun + more
            entries.append((begun, open_n, open_b))
            reach = block.heads[1:] + total
            heads.append(reach[(reach <= bounds.most_bytes) & (np.arange(1, len(reach) + 1) + n <= bounds.rows)])
        n, total = n + block.n, total + block.total
    return Block(n, total, np.concatenate(heads), *(np.concatenate(c) for c in zip(*entries, strict=True)))


def numbered(costs: np.ndarray, bounds: Bounds, n: int, b: int, begun: int) -> tuple[np.ndarray, int, int, int]:
    """The batch of each row behind an open batch, and the open batch and the batches begun after them."""
    out, sums, at = np.empty(len(costs), dtype=np.int64), np.concatenate([[0], np.cumsum(costs)]), 0
    while at < len(costs):
        fit = int(min(bounds.rows - n, np.searchsorted(sums, sums[at] + bounds.most_bytes - b, side="right") - 1 - at))
        if n == 0:
            begun, fit = begun + 1, max(fit, 1)
        if fit <= 0:
            n = b = 0
            continue
        to = min(at + fit, len(costs))
        out[at:to] = begun - 1
        n, b, at = n + to - at, b + int(sums[to] - sums[at]), to
    return out, n, b, begun


def batch_rows(df: DataFrame, order: Sequence[str], rows: int, most_bytes: int, partitions: int | None = None, fan: int = 64, columns: Sequence[str] | None = None) -> DataFrame:
    """(row, line, bytes, batch): df's rows as structs, in batches from 0 in the order given.

    line is the row as JSON, or these columns of it, without fields that are null; a batch ends before it passes `rows` rows or `most_bytes` bytes of lines
    with two for each row around them, and a row that alone is larger is a batch of its own. Rows with the same order are
    put in that of their lines' MD5, so the batches are the same for any partitioning; an empty table gives none. Rows are written once to
    the shared folder, as their partitions have to be the same in both passes. A partition's costs (8 bytes a row) meet in one
    task, and so do the functions of `fan` blocks, each with at most `rows` entries. One row for each partition is broadcast.
    """
    if rows < 1 or most_bytes < 1:
        raise ValueError("a batch has room for a row and a byte at least")
    bounds = Bounds(rows, most_bytes)
    lines = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), F.to_json(F.struct(*(F.col(f"`{c}`") for c in columns or df.columns))).alias("line"))
    lines = lines.select("row", "line", F.octet_length("line").cast("long").alias("bytes"))
    keys = [*(F.col(f"row.`{c}`") for c in order), F.md5("line")]
    ordered = cut(lines.orderBy(*keys) if partitions is None else lines.repartitionByRange(partitions, *keys).sortWithinPartitions(*keys))

    def functions(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        costs = [f["bytes"].to_numpy() + AROUND for f in frames if len(f)]
        if costs:
            yield pd.DataFrame([leaf(np.concatenate(costs), bounds).row(TaskContext.get().partitionId())])

    def compose(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([composed([Block.of(r) for r in frame.sort_values("block").itertuples()], bounds).row(int(key[0]))])

    def hand_down(frame: pd.DataFrame) -> pd.DataFrame:
        frame, out = frame.sort_values("block"), []
        n, b, begun = int(frame["open_n"].iloc[0]), int(frame["open_b"].iloc[0]), int(frame["begun"].iloc[0])
        for r in frame.itertuples():
            out.append((r.block, n, b, begun))
            after = Block.of(r).after(bounds, n, b)
            n, b, begun = int(after[0]), int(after[1]), begun + int(after[2])
        return pd.DataFrame(out, columns=["block", "open_n", "open_b", "begun"])

    parent = F.floor(F.col("block") / fan).cast("long")
    levels, blocks = [cut(ordered.select("bytes").mapInPandas(functions, FUNCTION))], ordered.rdd.getNumPartitions()
    while blocks > fan:
        levels.append(cut(levels[-1].groupBy(parent).applyInPandas(compose, FUNCTION)))
        blocks = -(-blocks // fan)
    carry = None
    for level in reversed(levels):
        known = level.withColumn("parent", parent)
        if carry is None:
            known = known.withColumns({c: F.lit(0).cast("long") for c in ("open_n", "open_b", "begun")})
        else:
            known = known.join(carry.withColumnRenamed("block", "parent"), "parent")
        carry = known.groupBy("parent").applyInPandas(hand_down, CARRY)

    def number(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for part in parts:
            if not part.num_rows:
                continue
            state = state or tuple(part.column(c)[0].as_py() for c in ("open_n", "open_b", "begun"))
            batch, *state = numbered(part.column("bytes").to_numpy() + AROUND, bounds, *state)
            yield pa.RecordBatch.from_arrays([part.column("row"), part.column("line"), part.column("bytes"), pa.array(batch)], names=["row", "line", "bytes", "batch"])

    known = ordered.withColumn("block", F.spark_partition_id().cast("long")).join(F.broadcast(carry), "block").drop("block")
    return known.mapInArrow(number, T.StructType([*ordered.schema.fields, T.StructField("batch", T.LongType())]))


def ordered_batches(df: DataFrame, order: Sequence[str], rows: int, most_bytes: int, partitions: int | None = None) -> DataFrame:
    """(batch, n, bytes, lines): each batch of `batch_rows` as a JSON array's lines in order, bytes those of the array's whole text."""
    named = batch_rows(df, order, rows, most_bytes, partitions)
    keys = [F.col(f"row.`{c}`").alias(f"k{i}") for i, c in enumerate(order)]
    held = F.array_sort(F.collect_list(F.struct(*keys, F.md5("line").alias("tie"), "line")))
    return named.groupBy("batch").agg(F.count("*").alias("n"), F.sum(F.col("bytes") + AROUND).alias("bytes"), F.concat_ws("\n", held.getField("line")).alias("lines"))
