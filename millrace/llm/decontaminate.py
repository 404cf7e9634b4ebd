"""Benchmark decontamination by latent semantic retrieval.

1. One pass over all documents counts in how many of them each hashed word is, and adds every
   passage, with a random sign, to one of a few rows: a sketch of the matrix of all passages. The tasks' sums are added by
   blocks of buckets, in whole numbers, so that they are the same however the documents are dealt out.
2. The driver weighs the sketch's columns by inverse frequencies, takes a power step in it, adds the benchmark's own randomised
   factorisation, and factors the small result: a latent space of all passages and all items.
3. Every passage of every document is projected and compared with every benchmark
   item by cosine; those above a floor are candidates. So is, at any cosine, a passage with
   as many of the item's rarest words as no leak can be without (a pigeonhole filter), so
   that no leak is lost to the projection.
4. A candidate is a leak if the longest common subsequence of its words and the item's
   covers enough of the item, and the item's answer is found in it.

Words are runs of letters and digits of any script, so case and punctuation make no difference. In scripts that are written without
spaces every character is a word. Texts are compared in Unicode's composed form.
"""

from __future__ import annotations

import functools
import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import Words, column_bytes, lower_ascii, mix, slices

#: Hashed vocabulary; rank of the latent space, and columns of the random matrix beyond it.
BUCKETS, RANK, SPARE = 1 << 16, 64, 16
#: Words of a step; passages are whole numbers of steps.
STEP = 12
#: Parts of the sums of all passages, and units of a summed value.
BLOCKS, UNITS = 64, 1 << 10
#: Benchmark items that one pass over the documents compares with.
BLOCK_ITEMS = 4_000
#: Least cosine of a candidate, as a part of what the item itself would score; leaks below it are found by their rarest words.
FLOOR = 0.4
#: One in so many of an item's words is asked for among its rarest ones.
ASKED = 6
#: Text that is worked on at a time: projected passages take far more room than their text.
PART_BYTES = 512 << 10

_SOLID = np.zeros(256, bool)
_SOLID[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


#: Blocks of scripts without spaces between words (Thai to Tibetan, Burmese, Khmer, kana, Han and its extensions, half-width kana).
UNSPACED = ((0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9D), (0x20000, 0x3FFFF))


@functools.cache
def _character(point: int, width: int) -> tuple[bool, bytes]:
    """Whether a character of `width` bytes is a letter, digit or accent, and its lower case if that has as many bytes."""
    c = chr(point)
    low = c.lower().encode("utf-8", "replace")
    return unicodedata.category(c)[0] in "LNM", low if len(low) == width else c.encode("utf-8", "replace")


def _folding(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of texts in lower case, which belong to letters and digits of any script, and before which a word ends."""
    out, solid, cut = lower_ascii(raw), _SOLID[raw], np.zeros(len(raw) + 4, bool)
    for width, least, most in ((2, 0xC2, 0xE0), (3, 0xE0, 0xF0), (4, 0xF0, 0xF5)):
        at = np.flatnonzero((raw >= least) & (raw < most))
        if not len(at):
            continue
        point = (raw[at] & (0xFF >> (width + 1))).astype(np.int64)
        for k in range(1, width):
            point = point << 6 | (raw[at + k] & 0x3F)
        points, place = np.unique(point, return_inverse=True)
        known = [_character(p, width) for p in points.tolist()]
        letter = np.array([k[0] for k in known])[place]
        low = np.frombuffer(b"".join(k[1] for k in known), np.uint8).reshape(-1, width)[place]
        for k in range(width):
            out[at + k] = low[:, k]
            solid[at[~letter] + k] = False
        alone = np.array([any(a <= p <= b for a, b in UNSPACED) for p in points.tolist()])[place]
        cut[at[alone]] = cut[at[alone] + width] = True
    return out, solid, cut[: len(raw)]


def _folded(col) -> Words:
    """Words of letters, digits and accents in lower case; a letter whose lower case has another length in UTF-8 stays."""
    raw, _ = column_bytes(col)
    # marks that combine with the letter before them begin with one of these bytes in UTF-8, but for rare scripts
    if np.isin(raw, (0xCC, 0xCD)).any():
        col = pa.array([None if t is None else unicodedata.normalize("NFC", t) for t in col.to_pylist()], pa.large_string())
    return Words(col, fold=_folding)


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(48)).astype(np.int64)


def _cells(rows: np.ndarray, bucket: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows (below most), buckets and counts of the distinct pairs, in order."""
    kind = np.uint32 if most <= BUCKETS else np.uint64
    key = (rows.astype(kind) << 16) | bucket.astype(kind)
    key.sort()
    heads = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return (key[heads] >> 16).astype(np.int64), (key[heads] & (BUCKETS - 1)).astype(np.int64), np.diff(np.append(heads, len(key)))


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By blocks of buckets: the sums of all passages in the sketch's rows, and last the number of texts with the bucket; and the number of texts, with the first block."""
    sums, n = np.zeros((BUCKETS, RANK + SPARE + 1), np.int32), 0
    for batch in batches:
        for part in slices(batch, "text"):
            w = _folded(part.column("text"))
            h, rows, many = w.hashes(), w.rows(), w.counts()
            bucket = _bucket(h)
            n += part.num_rows
            if not len(bucket):
                continue
            sums[:, -1] += np.bincount(_cells(rows, bucket, part.num_rows)[1], minlength=BUCKETS).astype(np.int32)
            lead = np.concatenate([[0], np.cumsum(-(-many // (4 * STEP)))])
            within = np.arange(int(lead[-1])) - np.repeat(lead[:-1], np.diff(lead))
            passage = lead[rows] + (np.arange(len(bucket)) - w.first[rows]) // (4 * STEP)
            # a passage's row and sign come from its text's mark, place and first word: copies have rows of their own
            mark = part.column("mark").to_numpy(zero_copy_only=False).view(np.uint64)
            first = h[np.repeat(w.first[:-1], np.diff(lead)) + within * 4 * STEP]
            mark = mix(mix(np.repeat(mark, np.diff(lead)) + within.astype(np.uint64)) ^ first)
            line, sign = ((mark >> np.uint64(8)) % np.uint64(RANK + SPARE)).astype(np.int64), (mark & np.uint64(1)).astype(np.float64) * 2 - 1
            row, col, count = _cells(passage, bucket, int(lead[-1]))
            scale = sign * UNITS / np.sqrt(np.bincount(row, count * count, int(lead[-1])))
            np.add.at(sums.reshape(-1), col * sums.shape[1] + line[row], np.rint(count * scale[row]).astype(np.int32))
    if n:
        for block, x in enumerate(np.split(sums, BLOCKS)):
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([n if block == 0 else 0]), pa.array([pa.compress(x.tobytes(), codec="zstd", asbytes=True)], pa.binary())], names=["block", "n", "sums"])


def _total(key: tuple, tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each block: the number of texts, sums, and numbers of texts with each bucket."""
    total, n = np.zeros((BUCKETS // BLOCKS, RANK + SPARE + 1), np.int64), 0
    for table in tables:
        n += sum(table.column("n").to_pylist())
        for x in table.column("sums"):
            total += np.frombuffer(pa.decompress(x.as_buffer(), total.size * 4, "zstd"), np.int32).reshape(total.shape)
    columns = [pa.array([key[0].as_py()], pa.int64()), pa.array([n], pa.int64()), pa.array([(total[:, :-1] / UNITS).astype(np.float32).tobytes()], pa.binary()), pa.array([total[:, -1].tobytes()], pa.binary())]
    yield pa.RecordBatch.from_arrays(columns, names=["block", "n", "sums", "texts"])


def survey(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Inverse frequencies of all buckets, and the sketch (BUCKETS, RANK + SPARE) of all passages, both from every text; BLOCKS rows, 21 MB, go to the driver."""
    parts = texts.select(F.xxhash64("_id").alias("mark"), "text").mapInArrow(_added, "block long, n long, sums binary")
    found = parts.groupBy("block").applyInArrow(_total, "block long, n long, sums binary, texts binary").toArrow()
    df, sums = np.zeros(BUCKETS), np.zeros((BUCKETS, RANK + SPARE), np.float32)
    for block, x, seen in zip(found.column("block").to_pylist(), found.column("sums"), found.column("texts"), strict=True):
        own = slice(block * BUCKETS // BLOCKS, (block + 1) * BUCKETS // BLOCKS)
        sums[own] = np.frombuffer(x.as_buffer(), np.float32).reshape(-1, RANK + SPARE)
        df[own] = np.frombuffer(seen.as_buffer(), np.int64)
    n = sum(found.column("n").to_pylist())
    return (np.log((n + 1) / (df + 1)) + 0.1).astype(np.float32), sums


def _random(rows: int, columns: int) -> np.ndarray:
    return np.random.default_rng(17).standard_normal((rows, columns), dtype=np.float32)


def _sketch(passage: np.ndarray, bucket: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Transpose(A) A R of the unit TF-IDF rows A of passages, given the passage and bucket of each word in order."""
    out = np.zeros((BUCKETS, RANK + SPARE), np.float32)
    if not len(passage):
        return out
    cell, count = np.unique(passage * BUCKETS + bucket, return_counts=True)
    row, col = cell // BUCKETS, cell % BUCKETS
    value = count.astype(np.float32) * idf[col]
    heads = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    size = np.diff(np.append(heads, len(row)))
    value /= np.repeat(np.sqrt(np.add.reduceat(value * value, heads)) + 1e-9, size)
    random = _random(BUCKETS, RANK + SPARE)
    y = np.add.reduceat(value[:, None] * random[col], heads, axis=0)
    order = np.argsort(col, kind="stable")
    col, part = col[order], (value[:, None] * np.repeat(y, size, axis=0))[order]
    heads = np.flatnonzero(np.append(True, col[1:] != col[:-1]))
    out[col[heads]] = np.add.reduceat(part, heads, axis=0)
    return out


def latent_space(sums: np.ndarray, items: pa.Array, idf: np.ndarray) -> np.ndarray:
    """(BUCKETS, RANK): the leading right singular vectors of the TF-IDF matrix of all passages, from their sketch, and of the items."""
    gram = lambda x: sum((part.T @ part).astype(np.float64) for part in np.split(x, BLOCKS))
    own = sums * idf[:, None]
    # a power step in the sketch: directions weigh by the cube of their part
    square = gram(own)
    own = own @ (square / max(float(np.trace(square)), 1e-9)).astype(np.float32)
    w = _folded(items)
    total = _sketch(w.rows(), _bucket(w.hashes()), idf)
    norm = float(np.linalg.norm(own))
    # the items have twice the weight of all passages
    total *= 2 / max(float(np.linalg.norm(total)), 1e-9)
    total += own / max(norm, 1e-9)
    # left singular vectors by the small Gram matrix: the large matrix is not copied
    size, turn = np.linalg.eigh(gram(total))
    size, turn = np.sqrt(np.maximum(size[::-1][:RANK], 0)), turn[:, ::-1][:, :RANK]
    return total @ (turn * np.where(size > 1e-6 * size[0], 1 / np.maximum(size, 1e-30), 0)).astype(np.float32)


@dataclass
class Items:
    """Benchmark items of one block, ready for workers."""

    ids: list
    words: list[np.ndarray]
    answers: list[np.ndarray]
    vectors: np.ndarray
    #: Steps of the passages that each item is compared with.
    steps: np.ndarray


def _items(ids: list, texts: list, answers: list, idf: np.ndarray, space: np.ndarray) -> Items:
    w = _folded(pa.array([t or "" for t in texts], pa.string()))
    h, first, n = w.hashes(), w.first, w.counts()
    bucket = _bucket(h)
    words = [h[first[i] : first[i + 1]] for i in range(len(texts))]
    given = _folded(pa.array([a or "" for a in answers], pa.string()))
    gh = given.hashes()
    answer = [gh[given.first[i] : given.first[i + 1]] for i in range(len(texts))]
    # where a benchmark has no answers, the last quarter of an item is what a model would have to give
    answer = [a if len(a) else x[-max(1, len(x) // 4) :] for a, x in zip(answer, words, strict=True)]
    vectors = np.stack([(idf[bucket[first[i] : first[i + 1]], None] * space[bucket[first[i] : first[i + 1]]]).sum(0) for i in range(len(texts))])
    # the space holds a part of each item; dividing by it makes an item's own passage score 1
    cell, count = np.unique(w.rows() * BUCKETS + bucket, return_counts=True)
    whole = np.bincount(cell // BUCKETS, (count * idf[cell % BUCKETS]) ** 2, len(texts)) ** 0.5
    vectors *= (whole / (np.square(vectors).sum(1) + 1e-9))[:, None]
    keep = [i for i in range(len(texts)) if n[i]]
    return Items([ids[i] for i in keep], [words[i] for i in keep], [answer[i] for i in keep], vectors[keep].astype(np.float32), np.maximum(2, -(-(n[keep] + STEP // 2) // STEP)))


def _rarest(items: Items, idf: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets' first positions in a list of items, that list, and how many of these words each item's leaks have at least.

    A passage that has `need` of an item's n words leaves out n - need at most; so of any n - need + k
    of them it has k. The rarest are taken.
    """
    pairs, asked = [], np.zeros(len(items.words), np.int64)
    for i, x in enumerate(items.words):
        need = max(1, math.ceil(least * len(x) - 1e-9))
        asked[i] = min(need, max(1, len(x) // ASKED))
        bucket = _bucket(x)
        rare = bucket[np.argsort(-idf[bucket], kind="stable")[: len(x) - need + int(asked[i])]]
        pairs.append(np.unique(rare) * len(items.words) + i)
    key = np.sort(np.concatenate(pairs))
    return np.searchsorted(key, np.arange(BUCKETS + 1) * len(items.words)), key % len(items.words), asked


def common_subsequence(item: np.ndarray, passage: np.ndarray) -> np.ndarray:
    """Which words of the item belong to one longest common subsequence with the passage."""
    match: dict[int, int] = {}
    for i, x in enumerate(item.tolist()):
        match[x] = match.get(x, 0) | 1 << i
    full = (1 << len(item)) - 1
    row, rows = full, []
    for x in passage.tolist():
        hit = row & match.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    # a zero bit in a row marks a step of the table there; walk back over the steps
    used, i, j = np.zeros(len(item), bool), len(item) - 1, len(rows) - 1
    while i >= 0 and j >= 0:
        if rows[j] >> i & 1:
            i -= 1
        elif j and not rows[j - 1] >> i & 1:
            j -= 1
        else:
            used[i] = True
            i, j = i - 1, j - 1
    return used


def _sharing(step: np.ndarray, item: np.ndarray, share: np.ndarray, wide: int, which: np.ndarray, asked: np.ndarray, fine: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Of passages (where fine) and items (which), those where the passage, with a step on either side, has enough of the item's rarest words."""
    place = np.full(len(asked), -1)
    place[which] = np.arange(len(which))
    own = place[item] >= 0
    step, col, share = step[own], place[item[own]], share[own]
    out = np.zeros((int(fine.sum()), len(which)), np.uint16)
    number = np.cumsum(fine) - 1
    for back in range(-1, wide + 1):
        begin = step - back
        ok = (begin >= 0) & (begin < len(fine))
        ok[ok] = fine[begin[ok]] & (row[begin[ok]] == row[step[ok]])
        # a step and item come once, so no cell is added to twice in one round
        out[number[begin[ok]], col[ok]] += share[ok].astype(np.uint16)
    return out >= asked[which]


def _matches(items: Items, idf: np.ndarray, space: np.ndarray, floor: float, verbatim: float, paraphrase: float, answered: float):
    # one bucket more, of weight 0, fills up the last step of a row
    weighted = np.concatenate([idf[:, None] * space, np.zeros((1, RANK), np.float32)])
    squares = np.append(np.square(idf), np.float32(0))
    times = [Counter(x.tolist()) for x in items.words]
    sets = [set(x) for x in times]
    least = min(verbatim, paraphrase)
    listed, owner, asked = _rarest(items, idf, least)
    scales = [(int(s), np.flatnonzero(items.steps == s)) for s in np.unique(items.steps)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", PART_BYTES):
                w = _folded(part.column("text"))
                h, first, n = w.hashes(), w.first, w.counts()
                if not len(h):
                    continue
                bucket = _bucket(h)
                steps = -(-n // STEP)
                lead = np.concatenate([[0], np.cumsum(steps)])
                within = np.arange(int(lead[-1])) - np.repeat(lead[:-1], steps)
                heads = np.repeat(first[:-1], steps) + within * STEP
                grid = np.full(len(heads) * STEP, BUCKETS)
                grid[np.repeat(lead[:-1] * STEP - first[:-1], n) + np.arange(len(h))] = bucket
                grid = grid.reshape(-1, STEP)
                each = weighted[grid[:, 0]]
                for k in range(1, STEP):
                    each += weighted[grid[:, k]]
                sums = np.zeros((len(heads) + 1, RANK), np.float64)
                np.cumsum(each, axis=0, out=sums[1:])
                mass = np.concatenate([[0], np.cumsum(squares[grid].sum(1), dtype=np.float64)])
                row = np.repeat(np.arange(len(n)), steps)
                # steps by the items whose rarest words they have, and how many
                many = listed[bucket + 1] - listed[bucket]
                step = np.repeat(lead[w.rows()] + (np.arange(len(h)) - first[w.rows()]) // STEP, many)
                held = owner[np.repeat(listed[bucket] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))]
                key, share = np.unique(step * len(asked) + held, return_counts=True)
                step, held = key // len(asked), key % len(asked)
                found: dict[tuple[int, int], tuple] = {}
                tried: set[tuple[int, int, int]] = set()
                for wide, which in scales:
                    end = np.minimum(np.arange(len(heads)) + wide, lead[row + 1])
                    # shorter passages than the scale only where a row has no longer one
                    fine = (np.arange(len(heads)) + wide <= lead[row + 1]) | (within == 0)
                    begin = np.flatnonzero(fine)
                    vector = (sums[end[begin]] - sums[begin]).astype(np.float32)
                    vector /= np.sqrt(mass[end[begin]] - mass[begin])[:, None].astype(np.float32) + 1e-9
                    cosine = vector @ items.vectors[which].T
                    near = cosine >= floor
                    near |= _sharing(step, held, share, wide, which, asked, fine, row)
                    at, col = np.nonzero(near)
                    for a, c in zip(at.tolist(), col.tolist(), strict=True):
                        item, doc = int(which[c]), int(row[begin[a]])
                        left = max(int(first[doc]), int(heads[begin[a]]) - STEP)
                        right = min(int(first[doc + 1]), int(heads[begin[a]]) + (wide + 1) * STEP)
                        if (left, right, item) in tried:
                            continue
                        tried.add((left, right, item))
                        words, target = h[left:right], items.words[item]
                        # no common subsequence is longer than what the item has of the passage's words
                        if sum(map(times[item].__getitem__, sets[item].intersection(words.tolist()))) < least * len(target) - 1e-9:
                            continue
                        used = common_subsequence(target, words)
                        ratio = float(used.mean())
                        answer = items.answers[item]
                        hit = float(common_subsequence(answer, words).mean())
                        if ratio >= verbatim or (ratio >= paraphrase and hit >= answered):
                            best = found.get((doc, item))
                            if best is None or (ratio, hit) > best[1:]:
                                found[doc, item] = (float(cosine[a, c]), ratio, hit)
                if found:
                    keys = sorted(found)
                    ids = part.column("_id").take(pa.array([d for d, _ in keys]))
                    values = [found[k] for k in keys]
                    yield pa.RecordBatch.from_arrays([ids, pa.array([items.ids[i] for _, i in keys], pa.int64()), *(pa.array([v[k] for v in values], pa.float64()) for k in range(3))], names=["_id", "item_id", "cosine", "lcs", "answer"])

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, floor: float = FLOOR, verbatim: float = 0.75, paraphrase: float = 0.6, answered: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, item_id, cosine, lcs, answer): a row for each row of docs and benchmark item that it leaks.

    benchmark has item_id, text and, if there are any, answer; without one the last quarter
    of the item counts as its answer. lcs is the part of the item's words in a longest
    common subsequence with the passage, answer the same for the item's answer. A leak
    has lcs >= verbatim, or lcs >= paraphrase and answer >= answered.
    Null and empty texts leak nothing, and items without words match nothing; repeated rows are each reported; null ids are
    reported as null. Other columns are ignored. Empty tables give no rows.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    texts = rows.where("length(text) > 0")
    schema = f"_id {kind}, item_id long, cosine double, lcs double, answer double"
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    wanted = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"), answer.alias("answer")).where("length(text) > 0")

    idf, sums, out, block = None, None, None, []

    def passed(block: list) -> DataFrame:
        space = latent_space(sums, pa.array([r.text for r in block], pa.string()), idf)
        items = _items([r.item_id for r in block], [r.text for r in block], [r.answer for r in block], idf, space)
        shared = spark.sparkContext.broadcast((items, idf, space))

        def run(batches):
            if items_of(shared):
                yield from _matches(*shared.value, floor, verbatim, paraphrase, answered)(batches)

        return rows.mapInArrow(run, schema)

    # the benchmark is a query set; it is compared in blocks of a bounded size
    for r in wanted.toLocalIterator():
        if idf is None:
            idf, sums = survey(texts)
        block.append(r)
        if len(block) == BLOCK_ITEMS:
            out = passed(block) if out is None else out.unionAll(passed(block))
            block = []
    if block:
        out = passed(block) if out is None else out.unionAll(passed(block))
    out = spark.createDataFrame([], schema) if out is None else out
    return out.withColumnRenamed("_id", id_col)


def items_of(shared) -> list:
    return shared.value[0].ids
