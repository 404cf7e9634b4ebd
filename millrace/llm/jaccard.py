"""N-gram Jaccard join by a token-group matrix.

Every distinct shingle set is one node, so exact copies meet in a single row before
anything is compared. Linked sets have at least the threshold's part of each other's
shingles in common, which three exact filters use, each with less data than the one before.

1. Shared shingles. Each task sends every shingle of a chunk of texts once, as 32 bits, to
   the bucket of its hash, and gets back how many shingles of each text nothing else has. A text with too
   many of them can link with nothing; only the others are read again.
2. Partition into groups of similar documents. Among those, shingles are counted, and each
   set shows its rarest ones: so many that linked sets have one of them in common (a
   prefix filter in ascending order of frequency; passages that many documents share are
   too frequent to show). Sets that show the same shingle are joined in a star; the
   components are the super-groups, and no link can leave one. Each is sorted by its smallest
   shingle and cut into groups of bounded size.
3. Token-group matrix. A group is stored in a shared file as the union of its members' shingles, which is
   the group's row of the matrix, and its members, as places in the union. Of a pair of
   groups the unions are read first: a member qualifies only if the other union has
   enough of its shingles. If any qualify on both sides, both groups are opened, and the
   counts of common shingles come from one blocked matrix product. Groups are read from their files, never shuffled.

A lost task can send its chunk anew under another name; then the replies for the first name
are ignored, which keeps more texts and loses none.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected
from .files import opened, written
from .scratch import Scratch
from .text import Words, mix, slices, windows

#: Bounds of a group: members, and shingles of all members.
GROUP_ROWS, GROUP_SHINGLES = 256, 400_000
#: Bounds of a chunk: shingles, and texts, whose numbers must fit 16 bits.
CHUNK_SHINGLES, CHUNK_TEXTS = 1_000_000, 30_000
#: Buckets of shingles for each partition of a shuffle; a bucket is what a task holds at a time.
BUCKETS = 16
#: Tables of at most so many rows (of four numbers) are broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 500_000
#: The text number of shingles that several texts of a chunk have, and of texts that are copies there.
MANY = 0xFFFF
#: Steps of a shingle's frequency per octave.
OCTAVE = 2048


def shingle_sets(col, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row; a text with fewer words is one shingle, without words none."""
    words = Words(col, lower=True)
    h = words.hashes()
    shingles, _ = windows(h, words.first, width)
    first, n = words.first, words.counts()
    for k in range(len(n)):
        if n[k] >= width:
            yield np.unique(shingles[first[k] : first[k] + n[k] - width + 1])
        elif n[k]:
            one = np.uint64(n[k])
            with np.errstate(over="ignore"):
                for x in h[first[k] : first[k] + n[k]]:
                    one = mix(np.array([one * np.uint64(0x9E3779B97F4A7C15) + x]))[0]
            yield np.array([one], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def node_of(tokens: np.ndarray) -> int:
    """A 63-bit identity of a set."""
    with np.errstate(over="ignore"):
        total = np.array([tokens.sum(dtype=np.uint64) + np.uint64(len(tokens)) * np.uint64(0x9E3779B97F4A7C15)], np.uint64)
        return int(mix(mix(total) ^ np.bitwise_xor.reduce(tokens))[0] >> np.uint64(1))


def spare(n, num: int, den: int):
    """How many shingles of a set of n another set that links with it can lack."""
    return n - -(-num * n // den)


def _stars(sigs: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each signature the smallest node; and edges from the other nodes to it."""
    order = np.lexsort((nodes, sigs))
    sigs, nodes = sigs[order], nodes[order]
    head = np.ones(len(sigs), bool)
    head[1:] = sigs[1:] != sigs[:-1]
    at = np.flatnonzero(head)
    pivot = np.repeat(nodes[at], np.diff(np.append(at, len(sigs))))
    off = nodes != pivot
    a, b = nodes[off], pivot[off]
    if len(a):
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        a, b = a[new], b[new]
    return sigs[at], nodes[at], a, b


#: What tasks send. The kinds: 0 a text (k its id's hash; id, node, n, and its number ref in its chunk), 1 a part of a
#: chunk for bucket k, 2 the reply to it, 3 a chunk of members, 4 a signature k of node, 5 an edge from node to id,
#: 6 a member (node, n, its smallest shingle in id).
_SQL = "kind int, k long, chunk long, ref int, id long, node long, n long, data binary"
_ROW = pa.schema([("kind", pa.int32()), ("k", pa.int64()), ("chunk", pa.int64()), ("ref", pa.int32()), ("id", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("data", pa.binary())])


def _rows(kind: int, **columns) -> Iterator[pa.RecordBatch]:
    """Rows of one kind; columns that are not given are null, single numbers are repeated."""
    n = max(len(c) for c in columns.values() if not np.isscalar(c))
    for i in range(0, n, 100_000):
        m, arrays = min(100_000, n - i), []
        for field in _ROW:
            value = kind if field.name == "kind" else columns.get(field.name)
            if value is None:
                arrays.append(pa.nulls(m, field.type))
            elif np.isscalar(value):
                arrays.append(pa.array(np.full(m, value), field.type))
            else:
                arrays.append(pa.array(value[i : i + m], field.type))
        yield pa.RecordBatch.from_arrays(arrays, schema=_ROW)


def _chunk_name() -> int:
    return uuid.uuid4().int >> 65


def _bucketed(tokens: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted shingles, and their end."""
    bucket = ((tokens >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))


def _low(tokens: np.ndarray) -> np.ndarray:
    return (tokens & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _counted(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of some sets in ascending order, how many have each, the number of one of these, and all shingles' places."""
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(tokens, kind="stable")
    ranked = tokens[order]
    head = np.ones(len(ranked), bool)
    head[1:] = ranked[1:] != ranked[:-1]
    at = np.flatnonzero(head)
    place = np.empty(len(tokens), np.int64)
    place[order] = np.cumsum(head) - 1
    return ranked[at], np.diff(np.append(at, len(ranked))), owner[order[at]], place


def _scan(width: int, buckets: int):
    """Texts (id, text) to rows of kinds 0 and 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, np.ndarray]] = {}
        texts: list[tuple[int, int, int]] = []
        copied, size = set(), 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal size
            chunk = _chunk_name()
            if texts:
                ids, nodes, n = (np.array(x, np.int64) for x in zip(*texts, strict=True))
                ref = np.array([MANY if node in copied or not node + 1 else held[node][0] for node in nodes.tolist()], np.int32)
                yield from _rows(0, k=mix(ids.view(np.uint64)).view(np.int64), chunk=chunk, ref=ref, id=ids, node=nodes, n=n)
            if held:
                distinct, count, owner, _ = _counted([t for _, t in held.values()])
                copy = np.array([node in copied for node in held])
                ref = np.where((count > 1) | copy[owner], MANY, owner).astype(np.uint16)
                low, bounds = _low(distinct), _bucketed(distinct, buckets)
                full = np.flatnonzero(np.diff(bounds))
                yield from _rows(1, k=full, chunk=chunk, data=[low[a:b].tobytes() + ref[a:b].tobytes() for a, b in zip(bounds[full].tolist(), bounds[full + 1].tolist(), strict=True)])
            held.clear()
            texts.clear()
            copied.clear()
            size = 0

        for batch in batches:
            for part in slices(batch, "text"):
                for i, tokens in zip(part.column("id").to_pylist(), shingle_sets(part.column("text"), width), strict=True):
                    node = node_of(tokens) if len(tokens) else -1
                    texts.append((i, node, len(tokens)))
                    if node in held:
                        copied.add(node)
                    elif len(tokens):
                        held[node] = len(held), tokens
                        size += len(tokens)
                    if size > CHUNK_SHINGLES or len(texts) >= CHUNK_TEXTS:
                        yield from close()
        yield from close()

    return run


def _by_bucket(answer):
    """Passes rows of kind 0 on, and gives those of kind 1 to `answer`, all of a bucket at a time; rows come sorted by kind and k."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, chunks, parts = None, [], []
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            texts = int(np.searchsorted(kind, 1))
            if texts:
                yield batch.slice(0, texts)
            rest = batch.slice(texts)
            for k, chunk, data in zip(*(rest.column(c) for c in ("k", "chunk", "data")), strict=True):
                if k.as_py() != now:
                    if parts:
                        yield from answer(now, chunks, parts)
                    now, chunks, parts = k.as_py(), [], []
                chunks.append(chunk.as_py())
                parts.append(data.as_buffer())
        if parts:
            yield from answer(now, chunks, parts)

    return run


def _alone(bucket: int, chunks: list[int], parts: list) -> Iterator[pa.RecordBatch]:
    """Replies to each chunk: texts, and how many shingles in this bucket only each of them has."""
    size = np.array([len(p) // 6 for p in parts])
    low = np.concatenate([np.frombuffer(p, np.uint32, n) for p, n in zip(parts, size, strict=True)])
    ref = np.concatenate([np.frombuffer(p, np.uint16, n, 4 * n) for p, n in zip(parts, size, strict=True)])
    row = np.repeat(np.arange(len(parts)), size)
    order = np.argsort(low, kind="stable")
    ranked = low[order]
    other = np.zeros(len(ranked) + 1, bool)
    other[1:-1] = ranked[1:] == ranked[:-1]
    only = order[~(other[1:] | other[:-1])]
    only = only[ref[only] != MANY]
    key, count = np.unique(row[only].astype(np.uint64) << np.uint64(16) | ref[only], return_counts=True)
    at = np.searchsorted(key >> np.uint64(16), np.arange(len(parts) + 1, dtype=np.uint64))
    texts, count = (key & np.uint64(MANY)).astype(np.uint16), count.astype(np.uint32)
    some = np.flatnonzero(np.diff(at))
    if len(some):
        yield from _rows(2, k=bucket, chunk=np.array(chunks, np.int64)[some], data=[texts[at[i] : at[i + 1]].tobytes() + count[at[i] : at[i + 1]].tobytes() for i in some.tolist()])


def _judge(num: int, den: int):
    """Replies and texts, sorted by chunk with replies first, to (id, node, n, shared)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, alone = None, np.zeros(MANY + 1, np.int64)
        for batch in batches:
            chunk = batch.column("chunk").to_numpy()
            cut = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1]))
            for i, j in zip(cut, np.append(cut[1:], len(chunk)), strict=True):
                if chunk[i] != now:
                    now = chunk[i]
                    alone[:] = 0
                part = batch.slice(i, j - i)
                replies = int(np.searchsorted(-part.column("kind").to_numpy(), 0))
                for data in part.column("data").slice(0, replies):
                    data = data.as_buffer()
                    n = len(data) // 6
                    alone[np.frombuffer(data, np.uint16, n)] += np.frombuffer(data[2 * n :], np.uint32)
                if replies < len(part):
                    ids, node, n, ref = (part.column(c).slice(replies).to_numpy() for c in ("id", "node", "n", "ref"))
                    shared = (n > 0) & ((ref == MANY) | (alone[ref] <= spare(n, num, den)))
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(node), pa.array(n), pa.array(shared)], names=["id", "node", "n", "shared"])

    return run


def _members(width: int):
    """Texts (node, text) to rows of kind 3: nodes, sizes and shingles of a chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal size
            if held:
                data = np.array(list(held), np.int64).tobytes() + np.array([len(t) for t in held.values()], np.int64).tobytes() + b"".join(t.tobytes() for t in held.values())
                yield from _rows(3, k=np.array([-1]), chunk=_chunk_name(), n=len(held), data=[data])
            held.clear()
            size = 0

        for batch in batches:
            for part in slices(batch, "text"):
                for node, tokens in zip(part.column("node").to_pylist(), shingle_sets(part.column("text"), width), strict=True):
                    # another row with the same id is another node
                    if len(tokens) and node_of(tokens) == node and node not in held:
                        held[node] = tokens
                        size += len(tokens)
                        if size > CHUNK_SHINGLES // 4 or len(held) >= CHUNK_TEXTS:
                            yield from close()
        yield from close()

    return run


def _chunk(n: int, data) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes, sizes and shingles of a row of kind 3."""
    head = np.frombuffer(data, np.int64, 2 * n)
    return head[:n], head[n:], np.frombuffer(data, np.uint64, offset=16 * n)


def _ask(buckets: int):
    """Rows of kind 3 to those of kind 1: distinct shingles, and how many members have each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, n, data in zip(*(batch.column(c) for c in ("chunk", "n", "data")), strict=True):
                distinct, count = np.unique(_chunk(n.as_py(), data.as_buffer())[2], return_counts=True)
                low, bounds, count = _low(distinct), _bucketed(distinct, buckets), count.astype(np.uint16)
                full = np.flatnonzero(np.diff(bounds))
                yield from _rows(1, k=full, chunk=chunk.as_py(), data=[low[a:b].tobytes() + count[a:b].tobytes() for a, b in zip(bounds[full].tolist(), bounds[full + 1].tolist(), strict=True)])

    return run


def _frequent(bucket: int, chunks: list[int], parts: list) -> Iterator[pa.RecordBatch]:
    """Replies to each chunk: of each of its shingles in this bucket the frequency on a logarithmic scale, 0 for one."""
    size = np.array([len(p) // 6 for p in parts])
    low = np.concatenate([np.frombuffer(p, np.uint32, n) for p, n in zip(parts, size, strict=True)])
    count = np.concatenate([np.frombuffer(p, np.uint16, n, 4 * n) for p, n in zip(parts, size, strict=True)])
    _, place = np.unique(low, return_inverse=True)
    total = np.bincount(place, count)
    code = np.minimum(np.floor(np.log2(total) * OCTAVE), MANY).astype(np.uint16)[place]
    at = np.concatenate([[0], np.cumsum(size)])
    yield from _rows(2, k=bucket, chunk=np.array(chunks, np.int64), data=[code[a:b].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)])


def _show(num: int, den: int):
    """Chunks of members, each after the replies to it in order of buckets, to rows of kinds 4, 5 and 6."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, codes = None, []
        for batch in batches:
            for kind, chunk, n, data in zip(*(batch.column(c) for c in ("kind", "chunk", "n", "data")), strict=True):
                if chunk.as_py() != now:
                    now, codes = chunk.as_py(), []
                if kind.as_py() == 2:
                    codes.append(data.as_buffer())
                    continue
                nodes, sizes, tokens = _chunk(n.as_py(), data.as_buffer())
                _, place = np.unique(tokens, return_inverse=True)
                code = np.concatenate([np.frombuffer(c, np.uint16) for c in codes])[place]
                row = np.repeat(np.arange(len(nodes)), sizes)
                order = np.lexsort((tokens, code, row))
                off = np.concatenate([[0], np.cumsum(sizes)])
                rank = np.arange(len(order)) - off[row]
                shown = order[(rank <= spare(sizes, num, den)[row]) & (code[order] > 0)]
                sig, pivot, a, b = _stars(tokens[shown], nodes[row[shown]])
                some = np.unique(row[shown]).tolist()
                if some:
                    yield from _rows(4, k=sig.view(np.int64), node=pivot)
                    yield from _rows(6, k=nodes[some], node=nodes[some], n=sizes[some], id=(tokens[off[some]] >> np.uint64(1)).astype(np.int64), data=[tokens[off[i] : off[i + 1]].tobytes() for i in some])
                if len(a):
                    yield from _rows(5, k=a, node=a, id=b)

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signatures and nodes, sorted by signature, to edges; a signature may go on in the next batch."""
    last, pivot = None, 0
    for batch in batches:
        k, a = batch.column("k").to_numpy(), batch.column("node").to_numpy()
        if last is not None:
            k, a = np.append(last, k), np.append(pivot, a)
        if not len(k):
            continue
        at = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
        least = np.minimum.reduceat(a, at)
        first = np.repeat(least, np.diff(np.append(at, len(k))))
        off = a != first
        pairs = np.unique(np.stack([a[off], first[off]]), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])
        # where a signature goes on, its old pivot is among the next rows and gets an edge to a new one
        last, pivot = k[-1], least[-1]


class Group:
    """Members of one group: node, weight, and sorted shingles as places in the sorted union."""

    def __init__(self, nodes: np.ndarray, weight: np.ndarray, sizes: np.ndarray, union: np.ndarray, places: np.ndarray):
        self.nodes, self.weight, self.sizes, self.union, self.places = nodes, weight, sizes, union, places
        self.off = np.concatenate([[0], np.cumsum(sizes)])

    @classmethod
    def of(cls, nodes: list[int], weight: list[int], sets: list[np.ndarray]) -> Group:
        union, places = np.unique(np.concatenate(sets), return_inverse=True)
        return cls(np.array(nodes, np.int64), np.array(weight, np.int64), np.array([len(s) for s in sets], np.int64), union, places)

    def pack(self) -> tuple[bytes, bytes]:
        """The union, and the members."""
        return self.union.tobytes(), b"".join(x.tobytes() for x in (self.nodes, self.weight, self.sizes, self.places.astype(np.uint32)))

    @classmethod
    def unpack(cls, n: int, union: np.ndarray, members: bytes) -> Group:
        head = np.frombuffer(members, np.int64, 3 * n)
        return cls(head[:n], head[n : 2 * n], head[2 * n :], union, np.frombuffer(members, np.uint32, offset=24 * n).astype(np.int64))

    def qualifying(self, union: np.ndarray, num: int, den: int) -> np.ndarray:
        """Members of which the other union holds at least threshold x size shingles; others link with nothing behind it."""
        at = np.minimum(np.searchsorted(union, self.union), len(union) - 1)
        hit = (union[at] == self.union)[self.places]
        common = np.concatenate([[0], np.cumsum(hit)])
        return np.flatnonzero(den * (common[self.off[1:]] - common[self.off[:-1]]) >= num * self.sizes)

    def take(self, which: np.ndarray) -> Group:
        keep = np.zeros(len(self.nodes), bool)
        keep[which] = True
        return Group(self.nodes[which], self.weight[which], self.sizes[which], self.union, self.places[np.repeat(keep, self.sizes)])


def common_counts(x: Group, y: Group, columns: int = 16384) -> np.ndarray:
    """Matrix of the sizes of the intersections of x's members with y's."""
    out = np.zeros((len(x.nodes), len(y.nodes)), np.float32)
    shared = np.intersect1d(x.union, y.union, assume_unique=True)
    if not len(shared):
        return out.astype(np.int64)
    cells = []
    for g in (x, y):
        at = np.minimum(np.searchsorted(shared, g.union), len(shared) - 1)
        at = np.where(shared[at] == g.union, at, -1)[g.places]
        cells.append((np.repeat(np.arange(len(g.nodes)), g.sizes)[at >= 0], at[at >= 0]))
    for lo in range(0, len(shared), columns):
        wide, sides = min(columns, len(shared) - lo), []
        for g, (row, col) in zip((x, y), cells, strict=True):
            m = np.zeros((len(g.nodes), wide), np.float32)
            here = (col >= lo) & (col < lo + wide)
            m[row[here], col[here] - lo] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    return out.astype(np.int64)


def _linked(x: Group, y: Group, num: int, den: int) -> np.ndarray:
    common = common_counts(x, y)
    either = x.sizes[:, None] + y.sizes[None, :] - common
    return den * common >= num * either


def _answers(nodes: np.ndarray, link: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, node of a spanning forest's root, linked documents) from a symmetric link matrix."""
    root = np.arange(len(nodes))
    reach = link | np.eye(len(nodes), dtype=bool)
    while True:
        new = np.where(reach, root[None, :], len(nodes)).min(1)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return nodes, nodes[root], (link * weight[None, :]).sum(1)


#: Links of a node (grp is null: node, its root, linked documents), and groups with their place in a file.
_GROUP_SQL = "super long, grp long, a long, b long, n long, uri string, at long, union_bytes long, member_bytes long"
_GROUP = pa.schema([(c, pa.string() if c == "uri" else pa.int64()) for c in ("super", "grp", "a", "b", "n", "uri", "at", "union_bytes", "member_bytes")])


def _links(nodes, roots, links) -> pa.RecordBatch:
    none = pa.nulls(len(nodes), pa.int64())
    return pa.RecordBatch.from_arrays([none, none, pa.array(nodes), pa.array(roots), pa.array(links), pa.nulls(len(nodes), pa.string()), none, none, none], schema=_GROUP)


def _build(folder: str, num: int, den: int):
    """Members, sorted by super-group and smallest shingle, to groups in a file of this task; opens each with itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, uri, at = TaskContext.get().partitionId(), 0, f"{folder}/{uuid.uuid4().hex}.groups", 0
        held: dict[int, tuple[int, np.ndarray]] = {}
        now, members, shingles = None, 0, 0

        def close(out) -> Iterator[pa.RecordBatch]:
            nonlocal made, shingles, at
            if not held:
                return
            g = Group.of(list(held), [w for w, _ in held.values()], [t for _, t in held.values()])
            if len(held) > 1:
                link = _linked(g, g, num, den)
                np.fill_diagonal(link, False)
                yield _links(*_answers(g.nodes, link, g.weight))
            if len(held) < members:
                made += 1
                union, rest = g.pack()
                out.write(union)
                out.write(rest)
                values = (now, (task << 32) + made, int(g.sizes.min()), int(g.sizes.max()), len(held), uri, at, len(union), len(rest))
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _GROUP, strict=True)], schema=_GROUP)
                at += len(union) + len(rest)
            held.clear()
            shingles = 0

        with written(uri) as out:
            for batch in batches:
                for group, node, weight, size, data in zip(*(batch.column(c) for c in ("super", "node", "copies", "members", "data")), strict=True):
                    tokens = np.frombuffer(data.as_buffer(), np.uint64)
                    if group.as_py() != now or len(held) >= GROUP_ROWS or shingles + len(tokens) > GROUP_SHINGLES:
                        yield from close(out)
                        now, members = group.as_py(), size.as_py()
                    if node.as_py() not in held:
                        held[node.as_py()] = weight.as_py(), tokens
                        shingles += len(tokens)
            yield from close(out)

    return run


def _open(num: int, den: int):
    """Pairs of groups of one super-group: the unions and the bound first, then the exact counts of those that qualify."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, last, x = {}, None, None

        def read(uri: str, at: int, size: int) -> bytes:
            if uri not in files:
                if len(files) > 20:
                    for f in files.values():
                        f.close()
                    files.clear()
                files[uri] = opened(uri)
            files[uri].seek(at)
            return files[uri].read(size)

        def group(r: dict, side: str, union: np.ndarray) -> Group:
            return Group.unpack(r[f"n{side}"], union, read(r[f"uri{side}"], r[f"at{side}"] + r[f"union{side}"], r[f"member{side}"]))

        def union(r: dict, side: str) -> np.ndarray:
            return np.frombuffer(read(r[f"uri{side}"], r[f"at{side}"], r[f"union{side}"]), np.uint64)

        for batch in batches:
            for r in batch.to_pylist():
                if r["grp1"] != last:
                    last, x = r["grp1"], group(r, "1", union(r, "1"))
                other = union(r, "2")
                qx = x.qualifying(other, num, den)
                if not len(qx):
                    continue
                y = group(r, "2", other)
                qy = y.qualifying(x.union, num, den)
                if not len(qy):
                    continue
                some, y = x.take(qx), y.take(qy)
                link = _linked(some, y, num, den)
                if not link.any():
                    continue
                n, both = len(some.nodes), len(some.nodes) + len(y.nodes)
                square = np.zeros((both, both), bool)
                square[:n, n:], square[n:, :n] = link, link.T
                yield _links(*_answers(np.concatenate([some.nodes, y.nodes]), square, np.concatenate([some.weight, y.weight])))
        for f in files.values():
            f.close()

    return run


def _linked_nodes(known: DataFrame, nodes: DataFrame, few: bool, scratch: Scratch, width: int, num: int, den: int) -> DataFrame:
    """(a, b, n): a node, a node of its component, and linked documents; several rows for a node, and none for one without links."""
    spark = known.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    small = F.broadcast if few else lambda df: df
    again = known.join(small(nodes.select(F.col("first").alias("id"), "node")), "id").select("node", "text")
    members = scratch.table(again.mapInArrow(_members(width), _SQL), "members")
    asked = members.mapInArrow(_ask(BUCKETS * parts), _SQL).repartition(parts, "k").sortWithinPartitions("kind", "k")
    replies = asked.mapInArrow(_by_bucket(_frequent), _SQL)
    met = replies.unionAll(members).repartition(parts, "chunk").sortWithinPartitions("chunk", "kind", "k")
    shown = scratch.table(met.mapInArrow(_show(num, den), _SQL), "shown")
    scratch.drop(members)

    sigs = shown.where("kind = 4").select("k", "node").repartition(parts, "k").sortWithinPartitions("k")
    edges = sigs.mapInArrow(_meet, "a long, b long").unionAll(shown.where("kind = 5").select(F.col("node").alias("a"), F.col("id").alias("b")))
    supers = scratch.table(connected(edges, scratch), "supers")
    size = supers.groupBy("root").agg(F.count("*").alias("members"))
    placed = supers.join(size, "root").join(nodes.select("node", "copies"), "node").select(F.col("root").alias("super"), "node", "copies", "members")
    ready = shown.where("kind = 6").select("node", F.col("id").alias("least"), "data").join(small(placed), "node")
    ranged = ready.repartitionByRange("super", "least", "node").sortWithinPartitions("super", "least", "node")
    built = scratch.table(ranged.mapInArrow(_build(scratch.path("files"), num, den), _GROUP_SQL), "groups")
    scratch.drop(shown)

    side = lambda k: built.where("grp is not null").select("super", *(F.col(c).alias(f"{d}{k}") for c, d in (("grp", "grp"), ("a", "low"), ("b", "high"), ("n", "n"), ("uri", "uri"), ("at", "at"), ("union_bytes", "union"), ("member_bytes", "member"))))
    pairs = side(1).join(side(2), "super").where("grp1 < grp2").where(f"{den} * high1 >= {num} * low2 and {den} * high2 >= {num} * low1")
    dealt = pairs.repartition(parts, "grp1", F.pmod("grp2", F.lit(8))).sortWithinPartitions("grp1")
    crossed = dealt.mapInArrow(_open(num, den), _GROUP_SQL)
    return scratch.table(built.where("grp is null").select("a", "b", "n").unionAll(crossed.select("a", "b", "n")), "links")


def ngram_jaccard_join(docs: DataFrame, *, width: int = 5, threshold: tuple[int, int] = (8, 10), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, n_links) per row of docs; exact at threshold = (numerator, denominator).

    Words are lower-cased (A-Z) runs of non-space bytes. Two rows link when the
    Jaccard similarity of their sets of `width`-word shingles reaches the threshold;
    component_id is the smallest id reachable by links and n_links counts the rows
    linked with this one. A text with fewer than `width` words is one shingle; a null
    or empty text has none and links with nothing (component_id is its own id). A row
    with a null id takes no part: its component_id is null and n_links 0. Repeated rows are
    copies of each other. Other columns are ignored. An empty table gives no rows.
    Sets are compared by 64-bit hashes of shingles.
    """
    num, den = threshold
    if not 0 < num <= den:
        raise ValueError("threshold must be in (0, 1]")
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    known = rows.where("id is not null")

    sent = known.mapInArrow(_scan(width, BUCKETS * parts), _SQL).repartition(parts, "k").sortWithinPartitions("kind", "k")
    replied = scratch.table(sent.mapInArrow(_by_bucket(_alone), _SQL), "scan")
    by_chunk = replied.repartition(parts, "chunk").sortWithinPartitions("chunk", F.desc("kind"))
    seen = scratch.table(by_chunk.mapInArrow(_judge(num, den), "id long, node long, n long, shared boolean"), "seen")
    scratch.drop(replied)
    nodes = scratch.table(seen.where("shared").groupBy("node").agg(F.min("id").alias("first"), F.count("*").alias("copies")), "nodes")
    few = nodes.count() <= BROADCAST_ROWS

    found = _linked_nodes(known, nodes, few, scratch, width, num, den)
    comps = connected(found.select("a", "b"), scratch)
    links = found.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    placed = nodes.join(comps, "node", "left").join(links, "node", "left").select("node", "first", "copies", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    smallest = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    by_node = scratch.table(placed.join(smallest, "root").select("node", "component_id", (F.col("links") + F.col("copies") - 1).cast("long").alias("n_links")), "placed")
    shared = seen.where("shared").join(F.broadcast(by_node) if few else by_node, "node")
    answer = lambda df, component, links: df.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col(component).alias("component_id"), links.alias("n_links"))
    out = answer(shared, "component_id", F.col("n_links")).unionAll(answer(seen.where("not shared"), "id", F.lit(0).cast("long")))

    def without_id(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                n = np.array([len(t) for t in shingle_sets(part.column("text"), width)], np.int64)
                none = pa.nulls(len(n), pa.int64())
                yield pa.RecordBatch.from_arrays([none, pa.array(n), none, pa.array(np.zeros(len(n), np.int64))], names=[id_col, "n_shingles", "component_id", "n_links"])

    nameless = rows.where("id is null").select("text").mapInArrow(without_id, f"`{id_col}` long, n_shingles long, component_id long, n_links long")
    return out.unionAll(nameless)


#: For three words and 90 %: all pairs that share a shingle are counted, so it is for small tables only.
OP2_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM w),
n AS (SELECT w.doc_id, CAST(count(s.g) AS BIGINT) AS n FROM w LEFT JOIN s ON s.doc_id = w.doc_id GROUP BY w.doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
e AS (SELECT p.a, p.b FROM p JOIN n AS x ON x.doc_id = p.a JOIN n AS y ON y.doc_id = p.b WHERE 100 * c >= 90 * (x.n + y.n - c)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS d, doc_id AS t FROM w UNION SELECT r.d, u.b FROM r JOIN u ON r.t = u.a)
SELECT n.doc_id, n.n AS n_shingles, (SELECT min(t) FROM r WHERE r.d = n.doc_id) AS component_id, CAST((SELECT count(*) FROM u WHERE u.a = n.doc_id) AS BIGINT) AS n_links FROM n
"""
