"""Token ids in binary shards with Elias-Fano document boundaries.

A shard is

    magic, ids of all documents (2 or 4 bytes each, little endian),
    boundaries (Elias-Fano), document ids (Elias-Fano), footer, footer's length, magic

The boundaries are the n + 1 offsets of the documents in the id array. Elias-Fano
keeps the low bits of each offset as they are and the high bits in unary, about
2 + log2(ids / documents) bits an offset; samples of every 256th set bit make
select(i), and so any offset, a look at a few bytes.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .files import committed, opened
from .pieces import byte_encoder
from .scratch import Scratch
from .text import slices

MAGIC = b"MILLTOK1"
#: Set bits from one select sample to the next.
SAMPLE = 256
#: Bytes that a reader holds of the id array at a time.
READ_BYTES = 4 << 20


class EliasFano:
    """A non-decreasing sequence of non-negative integers."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        v = values.astype(np.uint64)
        low = np.packbits(((v[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        ones = (v >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        flags = np.zeros((int(ones[-1]) if n else 0) + 1, np.uint8)
        flags[ones] = 1
        return cls(n, bits, low, np.packbits(flags, bitorder="little"), ones[::SAMPLE].astype(np.uint32))

    def pack(self) -> bytes:
        return struct.pack("<QBQQQ", self.n, self.low_bits, len(self.low), len(self.high), len(self.samples)) + self.low.tobytes() + self.high.tobytes() + self.samples.astype("<u4").tobytes()

    @classmethod
    def unpack(cls, data: bytes) -> EliasFano:
        n, bits, a, b, c = struct.unpack_from("<QBQQQ", data)
        at = struct.calcsize("<QBQQQ")
        return cls(n, bits, np.frombuffer(data, np.uint8, a, at), np.frombuffer(data, np.uint8, b, at + a), np.frombuffer(data, "<u4", c, at + a + b))

    def _select(self, i: int) -> int:
        """The place of the i-th set bit."""
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = at // 8
        flags = np.unpackbits(self.high[byte : byte + 1], bitorder="little")
        flags[: at % 8] = 0
        while True:
            ones = np.flatnonzero(flags)
            if left < len(ones):
                return byte * 8 + int(ones[left])
            left -= len(ones)
            byte += len(flags) // 8
            flags = np.unpackbits(self.high[byte : byte + 32], bitorder="little")

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        low = 0
        if self.low_bits:
            first, last = i * self.low_bits, (i + 1) * self.low_bits
            low = int.from_bytes(self.low[first // 8 : (last + 7) // 8].tobytes(), "little") >> (first % 8) & ((1 << self.low_bits) - 1)
        return (self._select(i) - i) << self.low_bits | low

    def range(self, first: int, last: int) -> np.ndarray:
        """Values first to last - 1, from the same select structure."""
        if last <= first:
            return np.zeros(0, np.int64)
        begin, end = self._select(first), self._select(last - 1)
        flags = np.unpackbits(self.high[begin // 8 : end // 8 + 1], bitorder="little")
        flags[: begin % 8] = 0
        ones = np.flatnonzero(flags)[: last - first] + begin // 8 * 8
        high = (ones - np.arange(first, last)).astype(np.int64) << self.low_bits
        if not self.low_bits:
            return high
        at = first * self.low_bits
        bits = np.unpackbits(self.low[at // 8 : (last * self.low_bits + 7) // 8], bitorder="little")[at % 8 :][: (last - first) * self.low_bits]
        return high | (bits.reshape(-1, self.low_bits).astype(np.int64) << np.arange(self.low_bits)).sum(1)


class Shard:
    """A written shard; document i's ids are a slice of the id array."""

    def __init__(self, uri: str):
        self.file = opened(uri)
        size = self.file.size()
        self.file.seek(size - 16)
        length, magic = struct.unpack("<Q8s", self.file.read(16))
        if magic != MAGIC:
            raise ValueError(f"{uri} is not a token shard")
        self.file.seek(size - 16 - length)
        self.footer = json.loads(self.file.read(length))
        self.width, self.documents, self.tokens = (self.footer[k] for k in ("width", "documents", "tokens"))
        self.bounds = EliasFano.unpack(self._part("bounds"))
        self._ids = EliasFano.unpack(self._part("ids"))

    def _part(self, name: str) -> bytes:
        at, size = self.footer[name]
        self.file.seek(at)
        return self.file.read(size)

    def doc_ids(self, first: int, last: int) -> list[int | None]:
        none = self.footer["nulls"]
        known = self._ids.range(max(0, first - none), max(0, last - none)) + self.footer["least"]
        return [None] * max(0, min(last, none) - first) + known.tolist()

    def tokens_of(self, first: int, last: int) -> np.ndarray:
        """The ids of documents first to last - 1."""
        a, b = self.bounds[first], self.bounds[last]
        self.file.seek(len(MAGIC) + a * self.width)
        return np.frombuffer(self.file.read((b - a) * self.width), f"<u{self.width}")

    def close(self) -> None:
        self.file.close()


def write_shard(uri: str, documents: Iterator[tuple[list[int | None], np.ndarray, np.ndarray]], width: int) -> tuple[int, int]:
    """Write runs of documents (their ids, their token ids, and the bounds of these) in ascending order of id, nulls first; returns how many, and their token ids."""
    ends, ids, nulls, tokens = [np.zeros(1, np.int64)], [], 0, 0
    with committed(uri) as out:
        out.write(MAGIC)
        for docs, flat, cut in documents:
            out.write(flat.astype(f"<u{width}").tobytes())
            ends.append(tokens + cut[1:])
            tokens += len(flat)
            nulls += docs.count(None)
            ids.extend(d for d in docs if d is not None)
        bounds, least = np.concatenate(ends), ids[0] if ids else 0
        at = len(MAGIC) + tokens * width
        footer = {"width": width, "documents": len(bounds) - 1, "tokens": tokens, "nulls": nulls, "least": least}
        for name, values in (("bounds", bounds), ("ids", np.array(ids, np.int64) - least)):
            data = EliasFano.of(values).pack()
            out.write(data)
            footer[name] = [at, len(data)]
            at += len(data)
        tail = json.dumps(footer).encode()
        out.write(tail + struct.pack("<Q8s", len(tail), MAGIC))
    return len(bounds) - 1, tokens


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, *, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and write all rows of docs to shards in `folder`; returns the written manifest (shard, uri, n_docs, n_tokens).

    Shards are ranges of ascending id (nulls first), of which each is one task's sorted
    partition. A null or empty text is just the end id. Rows with the same id stay next to each other.
    """
    scratch = Scratch(docs.sparkSession, "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(tokenizer)
        task = TaskContext.get().partitionId()
        uri = f"{folder}/shard-{task:08d}.tok"

        def documents() -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
            for batch in batches:
                for part in slices(batch, "text"):
                    yield part.column("id").to_pylist(), *encoder.encode(part.column("text"), end_id)

        n, tokens = write_shard(uri, documents(), 2 if max(encoder.vocabulary - 1, end_id) < 1 << 16 else 4)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([task], pa.int64()), pa.array([uri]), pa.array([n], pa.int64()), pa.array([tokens], pa.int64())], names=["shard", "uri", "n_docs", "n_tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    dealt = rows.repartitionByRange(F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first())
    return scratch.table(dealt.mapInArrow(run, "shard long, uri string, n_docs long, n_tokens long"), "manifest")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri, start in zip(batch.column("uri").to_pylist(), batch.column("start").to_pylist(), strict=True):
            shard, first = Shard(uri), 0
            while first < shard.documents:
                last = min(first + 4096, shard.documents)
                bounds = shard.bounds.range(first, last + 1)
                last = first + max(1, int(np.searchsorted(bounds, bounds[0] + READ_BYTES // shard.width, "right")) - 1)
                bounds = bounds[: last - first + 1]
                ids = shard.tokens_of(first, last).astype("<u4")
                cut = bounds - bounds[0]
                crc = [zlib.crc32(ids[cut[i] : cut[i + 1]]) for i in range(last - first)]
                yield pa.RecordBatch.from_arrays([pa.array(shard.doc_ids(first, last), pa.int64()), pa.array(start + bounds[:-1]), pa.array(np.diff(bounds)), pa.array(crc, pa.int64())], names=["_id", "start", "n_tokens", "ids_crc32"])
                first = last
            shard.close()


def read_tokens(manifest: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document in the shards of a manifest, from the files themselves."""
    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n_tokens")
    # a number of partitions that is given stays: one task a shard
    placed = manifest.withColumn("start", before).select("uri", "start").repartition(max(1, manifest.count()))
    return placed.mapInArrow(_read, "_id long, start long, n_tokens long, ids_crc32 long").withColumnRenamed("_id", id_col)


def token_files(docs: DataFrame, tokenizer: str, *, folder: str | None = None, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write docs as token shards and read them back: (id, start, n_tokens, ids_crc32) per row.

    start counts the ids of all documents before it in ascending order of id, with
    nulls first; n_tokens includes the end id; the checksum is over the ids as
    little-endian 32-bit integers. Rows that share an id keep next to each other in any order. Null and
    empty texts are the end id alone. Other columns are ignored. An empty table gives no rows.
    folder is one that all executors share; by default one of the shared scratch folder.
    """
    folder = folder or Scratch(docs.sparkSession, "token-files").root
    return read_tokens(write_tokens(docs, folder, tokenizer, end_id=end_id, id_col=id_col, text_col=text_col), id_col=id_col)
