"""Removal of long byte strings that an earlier document holds too, by a suffix sort that compares on prefix hashes.

Only suffixes that two documents can share have to be sorted. The string of SPAN bytes at each place is filed under the smallest hash of its
strings of SEED bytes, so that equal strings are filed together; neighbouring places with one such key are one piece, sent as bytes. Keys
that one document has alone end there. The suffixes of the pieces of a key are sorted by mergesort: two are compared by a binary search for their
common extension on polynomial prefix hashes, and the finished order is verified byte by byte.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import hashing
from ._util import filesystem, new_folder, partitions, small_batches, table, written

#: Bytes of a string that counts, and of the shorter strings whose smallest hash is its key.
SPAN, SEED = 50, 24
#: Places of a piece at most: as many as can share a string of SEED bytes.
REACH = SPAN - SEED + 1
#: Text bytes and documents of a block at most (a longer document is a block), and places that are worked on at a time.
BLOCK_BYTES, BLOCK_DOCS, CHUNK = 8 << 20, 60_000, 1 << 16
#: Text bytes for each part of the keys.
PART_BYTES = 8 << 20
#: A key with more places than this in all blocks is hot: its strings are filed under their own hashes instead, so that only equal ones meet.
HOT = 1 << 18
_U = np.uint64
_NONE = np.zeros(0, np.int64)


class Block:
    """Texts end to end in one array; strings never cross two texts."""

    def __init__(self, ids: list[int], texts: pa.Array) -> None:
        texts = texts.cast(pa.large_binary())
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        raw = texts.buffers()[2] if len(texts) else None
        self.data = np.frombuffer(raw, np.uint8)[at[0] : at[-1]] if raw is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
        self.begins, self.ends, self.docs = at[:-1] - at[0], at[1:] - at[0], np.array(ids, np.int64)

    def pieces(self, bits: int, named: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts, numbers of places, keys and, if named, hashes of the bytes of all pieces, in their order."""
        n = len(self.data) - SPAN + 1
        if n <= 0:
            return _NONE, _NONE, _NONE.astype(_U), _NONE.astype(_U)
        step = np.zeros(len(self.data) + 1, np.int8)
        np.add.at(step, np.maximum(self.begins, self.ends - SPAN + 1), 1)
        np.add.at(step, self.ends, -1)
        whole = np.cumsum(step[:n], dtype=np.int8) == 0  # a string that starts here ends inside the text
        out = []
        for a in range(0, n, CHUNK):
            b = min(a + CHUNK, n)
            data, ok = self.data[a : b + SPAN - 1], whole[a:b]
            m = _least_seeds(data)
            same = np.zeros(b - a + 1, bool)
            same[1:-1] = (m[1:] == m[:-1]) & ok[1:] & ok[:-1]
            starts, ends = np.flatnonzero(ok & ~same[:-1]), np.flatnonzero(ok & ~same[1:]) + 1
            lengths = ends - starts
            if len(lengths) and lengths.max() > REACH:
                times = -(-lengths // REACH)
                nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                starts, ends = np.repeat(starts, times) + REACH * nth, np.repeat(ends, times)
                lengths = np.minimum(ends - starts, REACH)
            keys = hashing.mixed(m[starts]) >> _U(64 - bits)
            out.append((starts + a, lengths, keys, _named(hashing.prefixes(data), starts, lengths) if named else _NONE.astype(_U)))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def owners(self, starts: np.ndarray) -> np.ndarray:
        """Places of the texts in which these starts are."""
        return np.searchsorted(self.ends, starts, side="right")


def _least_seeds(data: np.ndarray) -> np.ndarray:
    """For each string of SPAN bytes, the smallest hash of the strings of SEED = 3 * 8 bytes in it."""
    w = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), strides=(1,)).astype(_U)
    n = len(data) - SEED + 1
    h = w[:n] * _U(0x9E3779B97F4A7C15)
    h += w[8 : 8 + n]
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    h += w[16 : 16 + n]
    h ^= h >> _U(29)
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(32)
    width = 1
    while 2 * width <= REACH:
        h = np.minimum(h[:-width], h[width:])
        width *= 2
    return np.minimum(h[: len(h) - (REACH - width)], h[REACH - width :]) if REACH > width else h


def _named(prefix: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hashes of pieces and of their lengths."""
    h = (prefix[starts + lengths + (SPAN - 1)] - prefix[starts]) * hashing.powers(len(prefix), hashing.INVERSE, "down")[starts]
    return hashing.mixed(h + lengths.astype(_U) * _U(0x94D049BB133111EB))


def _planes(x: np.ndarray, width: int) -> bytes:
    """Unsigned numbers as planes of their bytes, which pack well where high bytes are 0."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _from_planes(raw: bytes, at: int, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T
    return out.reshape(-1).view("<u8").astype(_U)


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the bytes from a and from b on are the same, as many as sizes says."""
    same = np.ones(len(a), bool)
    for i in range(0, len(a), 1 << 16):
        x, y, n = a[i : i + (1 << 16), None], b[i : i + (1 << 16), None], sizes[i : i + (1 << 16), None]
        k = np.arange(SPAN + REACH - 1)[None, :]
        k = np.minimum(k, n - 1)
        same[i : i + (1 << 16)] = (data[x + k] == data[y + k]).all(axis=1)
    return same


def distinct(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, keys: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, first): pieces sorted by key and content, and which of them are the first of their content. Equal hashes are verified."""
    names = names.copy()
    while True:
        order = np.lexsort((names, keys))
        k, h = keys[order], names[order]
        first = np.ones(len(order), bool)
        first[1:] = (k[1:] != k[:-1]) | (h[1:] != h[:-1])
        of = order[np.flatnonzero(first)[np.cumsum(first) - 1]] if len(order) else order
        again = np.flatnonzero(~first)
        x, y = order[again], of[again]
        wrong = x[(lengths[x] != lengths[y]) | ~_same_bytes(data, starts[x], starts[y], np.minimum(lengths[x], lengths[y]) + (SPAN - 1))]
        if not len(wrong):
            return order, first
        names[wrong] += _U(0x9E3779B97F4A7C15)  # a collision: they get a name of their own


class Suffixes:
    """Order of the first SPAN bytes from some places of an array on."""

    def __init__(self, data: np.ndarray) -> None:
        self.prefix = hashing.prefixes(data)
        self.down = hashing.powers(len(data) + 1, hashing.INVERSE, "down")
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        self.words = np.ndarray((len(data) + 1,), ">u8", padded, strides=(1,)).astype(_U)

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bytes that the suffixes at a and b have in common, SPAN at most: a binary search on prefix hashes."""
        pa_, pb, da, db = self.prefix[a], self.prefix[b], self.down[a], self.down[b]
        n, step = np.zeros(len(a), np.int64), 1 << (SPAN.bit_length() - 1)
        while step:
            t = np.minimum(n + step, SPAN)
            n = np.where((self.prefix[a + t] - pa_) * da == (self.prefix[b + t] - pb) * db, t, n)
            step >>= 1
        return n

    def compared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 for each pair. Their first eight bytes mostly decide; the common extension does where they are the same."""
        x, y = self.words[a], self.words[b]
        out = (x > y).astype(np.int8) - (x < y).astype(np.int8)
        tie = np.flatnonzero(out == 0)
        if len(tie):
            a, b = a[tie], b[tie]
            n = self.extension(a, b)
            x, y = self.words[a + n] >> _U(56), self.words[b + n] >> _U(56)
            out[tie] = np.where(n >= SPAN, 0, (x > y).astype(np.int8) - (x < y).astype(np.int8))
        return out

    def sort(self, at: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Order of the suffixes at these places inside their groups (which stand together): merges of runs of 1, 2, 4, ... in all groups at once."""
        n = len(at)
        cut = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if n else _NONE
        size = np.diff(np.append(cut, n))
        begin, end = np.repeat(cut, size), np.repeat(cut + size, size)
        order, width, level = np.arange(n), 1, 0
        while len(size) and width < size.max():
            active = np.flatnonzero(end - begin > width)
            q = (active - begin[active]) >> level
            right = active[(q & 1) == 1]
            left = active[(q & 1) == 0]
            lo = begin[left] + ((((left - begin[left]) >> level) + 1) << level)
            stop = np.minimum(lo + width, end[left])
            paired = lo < stop
            left, lo, stop = left[paired], lo[paired], stop[paired]
            first, lo = lo, lo.copy()
            while True:  # how many of the run beside it are smaller
                todo = np.flatnonzero(lo < stop)
                if not len(todo):
                    break
                mid = (lo[todo] + stop[todo]) >> 1
                after = self.compared(at[order[left[todo]]], at[order[mid]]) > 0
                lo[todo] = np.where(after, mid + 1, lo[todo])
                stop[todo] = np.where(after, stop[todo], mid)
            merged, taken = order.copy(), np.zeros(n, bool)
            to = left + (lo - first)
            taken[to] = True
            merged[to] = order[left]
            both = np.sort(np.concatenate([left, right]))
            merged[both[~taken[both]]] = order[right]
            order, width, level = merged, 2 * width, level + 1
        return order

    def checked(self, at: np.ndarray, order: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Whether each but the first of the ordered suffixes is the same as the one before, by its bytes. Raises ValueError where the order is wrong."""
        a, b = at[order[:-1]], at[order[1:]]
        same = group[order[1:]] == group[order[:-1]]
        for k in (*range(0, SPAN - 7, 8), SPAN - 8):
            left = np.flatnonzero(same)
            x, y = self.words[a[left] + k], self.words[b[left] + k]
            if (x > y).any():
                raise ValueError("suffixes out of order")
            same[left[x != y]] = False
        return same

    def classes(self, at: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(order, first): suffixes of each group in order, and which of them differ from the one before."""
        order = self.sort(at, group)
        try:
            same = self.checked(at, order, group)
        except ValueError:  # a collision misled the sort: compare bytes instead
            columns = [self.words[at + k] for k in (*range(0, SPAN - 7, 8), SPAN - 8)]
            order = np.lexsort((*columns[::-1], group))
            same = self.checked(at, order, group)
        return order, np.concatenate([[True], ~same])


def _store(docs: DataFrame, folder: str) -> DataFrame:
    """(doc_id, block, place, n_bytes, sha) of every row, once its text stands in a block file in the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)
        ids: list[int | None] = []
        texts: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal ids, texts, size
            name = f"{base}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.parquet"
            pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.large_binary())}), name, filesystem=fs, compression="zstd", compression_level=3, use_dictionary=False, write_statistics=False)
            out = pa.RecordBatch.from_pydict(
                {"doc_id": pa.array(ids, pa.int64()), "block": [name] * len(ids), "place": pa.array(range(len(ids)), pa.int32()), "n_bytes": pa.array([len(t) for t in texts], pa.int64()), "sha": pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())}
            )
            ids, texts, size = [], [], 0
            return out

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                text = text or b""
                if texts and (size + len(text) > BLOCK_BYTES or len(texts) >= BLOCK_DOCS):
                    yield flush()
                ids.append(doc)
                texts.append(text)
                size += len(text)
        if texts:
            yield flush()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, block string, place int, n_bytes long, sha binary")


def _read(fs: pa.fs.FileSystem, block: str, places: list[int] | None = None) -> tuple[list[int | None], pa.Array]:
    got = pq.read_table(block, filesystem=fs)
    texts = got.column("text").combine_chunks()
    return got.column("doc_id").to_pylist(), texts if places is None else texts.take(pa.array(places, pa.int32()))


def _grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, list[dict]]]:
    rows = (row for batch in batches for row in batch.to_pylist())
    for k, group in groupby(rows, key=lambda r: r[key]):
        yield k, list(group)


def _cuts(keys: np.ndarray, bits: int, n: int) -> list[int]:
    """Where sorted keys are cut into n ranges of their values."""
    return [0, *np.searchsorted(keys, np.array([(i << bits) // n for i in range(1, n)], _U)).tolist(), len(keys)]


def _dealt(block: str, cuts: list[int], packed: Callable[[int, int], bytes]) -> pa.RecordBatch:
    parts = [(i, packed(a, b)) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
    return pa.RecordBatch.from_pydict({"part": pa.array([i for i, _ in parts], pa.int32()), "block": pa.array([block] * len(parts), pa.string()), "data": pa.array([x for _, x in parts], pa.binary())})


def _answered(sent: DataFrame, n: int, answer: Callable[[list[bytes]], list[bytes]]) -> DataFrame:
    """(block, part, mask): the answer to each block's message to a part, given all messages to that part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _grouped(batches, "part"):
            yield pa.RecordBatch.from_pydict({"block": [r["block"] for r in rows], "part": pa.array([part] * len(rows), pa.int32()), "mask": pa.array(answer([r["data"] for r in rows]), pa.binary())})

    return sent.repartition(n, "part").sortWithinPartitions("part", "block").mapInArrow(run, "block string, part int, mask binary")


def _by_block(blocks: DataFrame, answers: DataFrame | None, n: int, work: Callable, schema: str) -> DataFrame:
    """work(block, codes of its texts, answers) for each block, those without answers too."""
    rows = blocks.select("block", F.lit(-2).alias("part"), F.lit(None).cast("binary").alias("mask"), "places")
    if answers is not None:
        rows = rows.unionByName(answers.withColumn("places", F.lit(None).cast("array<int>")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, group in _grouped(batches, "block"):
            yield from work(block, sorted(group[0]["places"]), group[1:])

    return rows.repartition(n, "block").sortWithinPartitions("block", "part").mapInArrow(run, schema)


# The first exchange: keys of a block, and whether others have them.


def _key_message(keys: np.ndarray, many: np.ndarray, width: int) -> bytes:
    return len(keys).to_bytes(8, "little") + _planes(np.diff(keys, prepend=_U(0)), width) + _planes(many, 4)


def _key_answers(messages: list[bytes], width: int, hot: int) -> list[bytes]:
    """For each key 1 if another block has it, 2 more if all blocks together have more than hot places of it."""
    sizes = [int.from_bytes(m[:8], "little") for m in messages]
    keys = [np.cumsum(_from_planes(m, 8, k, width), dtype=_U) for m, k in zip(messages, sizes, strict=True)]
    many = [_from_planes(m, 8 + k * width, k, 4) for m, k in zip(messages, sizes, strict=True)]
    every, times = np.concatenate(keys), np.concatenate(many)
    order = np.argsort(every, kind="stable")
    k = every[order]
    first = np.concatenate([[True], k[1:] != k[:-1]])
    cut, group = np.flatnonzero(first), np.cumsum(first) - 1
    says = (np.diff(np.append(cut, len(k))) > 1).astype(np.uint8) | (np.add.reduceat(times[order], cut) > _U(hot)).astype(np.uint8) << 1
    out = np.empty(len(k), np.uint8)
    out[order] = says[group]
    ends = np.cumsum(sizes).tolist()
    return [out[e - s : e].tobytes() for e, s in zip(ends, sizes, strict=True)]


# The second exchange: pieces of shared keys, and which of their strings a smaller document has.


class Pieces:
    """A block's pieces whose key two documents share; order and first as distinct() gives them, least: the smallest document of each content.

    said: the answers for the block's distinct keys in their order, see _key_answers.
    """

    def __init__(self, block: Block, bits: int, said: np.ndarray) -> None:
        starts, lengths, keys, names = block.pieces(bits, named=True)
        inverse, inside = _shares(block, starts, keys)
        code = said | inside
        use = code[inverse] & 1 == 1
        hot = use & (code[inverse] & 2 == 2)
        cool = use & ~hot
        if hot.any():
            # a piece for each string, under the string's own hash
            times = lengths[hot]
            one = np.repeat(starts[hot], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            ones = np.ones(len(one), np.int64)
            own = np.concatenate([_named(hashing.prefixes(block.data[a : a + CHUNK + SPAN]), one[x:y] - a, ones[x:y]) for a, x, y in _spans(one)])
            starts, lengths = np.concatenate([starts[cool], one]), np.concatenate([lengths[cool], ones])
            keys, names = np.concatenate([keys[cool], hashing.mixed(own) >> _U(64 - bits)]), np.concatenate([names[cool], own])
        else:
            starts, lengths, keys, names = starts[cool], lengths[cool], keys[cool], names[cool]
        self.starts, self.lengths, self.keys = starts, lengths, keys
        self.docs = block.docs[block.owners(starts)]
        self.order, self.first = distinct(block.data, starts, lengths, keys, names)
        cut = np.flatnonzero(self.first)
        self.heads = self.order[cut]
        self.least = np.minimum.reduceat(self.docs[self.order], cut) if len(cut) else _NONE


def _spans(starts: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Parts of ascending starts that CHUNK covers: (begin, from, to)."""
    x = 0
    while x < len(starts):
        y = int(np.searchsorted(starts, starts[x] + CHUNK))
        yield int(starts[x]), x, y
        x = y


def _shares(block: Block, starts: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each piece's place among the distinct keys, and for each of those 1 if two documents of the block have it."""
    kept, inverse = np.unique(keys, return_inverse=True)
    docs = block.docs[block.owners(starts)]
    least, most = np.full(len(kept), np.iinfo(np.int64).max), np.full(len(kept), np.iinfo(np.int64).min)
    np.minimum.at(least, inverse, docs)
    np.maximum.at(most, inverse, docs)
    return inverse, (least < most).astype(np.uint8)


def _piece_message(block: Block, p: Pieces, a: int, b: int, width: int) -> bytes:
    heads = p.heads[a:b]
    names, place = np.unique(p.least[a:b], return_inverse=True)
    sizes = p.lengths[heads] + (SPAN - 1)
    text = block.data[np.repeat(p.starts[heads] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())].tobytes()
    head = np.array([len(heads), len(names)], "<u8").tobytes()
    return zstandard.compress(head + _planes(np.diff(p.keys[heads], prepend=_U(0)), width) + p.lengths[heads].astype(np.uint8).tobytes() + names.astype("<i8").tobytes() + _planes(place, 4) + text, 1)


def _piece_answers(messages: list[bytes], width: int) -> list[bytes]:
    """For each piece of each block a bit for each place: whether a smaller document than the block's smallest has the string there."""
    sizes, keys, lengths, docs, texts = [], [], [], [], []
    for packed in messages:
        raw = zstandard.decompress(packed)
        n, m = (int(x) for x in np.frombuffer(raw, "<u8", 2))
        at = 16
        keys.append(np.cumsum(_from_planes(raw, at, n, width), dtype=_U))
        at += n * width
        lengths.append(np.frombuffer(raw, np.uint8, n, at).astype(np.int64))
        names = np.frombuffer(raw, "<i8", m, at + n)
        at += n + 8 * m
        docs.append(names[_from_planes(raw, at, n, 4).astype(np.int64)])
        texts.append(np.frombuffer(raw, np.uint8, offset=at + 4 * n))
        sizes.append(n)
    keys, lengths, docs, data = (np.concatenate(x) for x in (keys, lengths, docs, texts))
    starts = np.cumsum(lengths + (SPAN - 1)) - (lengths + (SPAN - 1))
    suffixes = Suffixes(data)
    order, first = distinct(data, starts, lengths, keys, _named(suffixes.prefix, starts, lengths))
    cut = np.flatnonzero(first)
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(first) - 1
    heads, least = order[cut], np.minimum.reduceat(docs[order], cut)
    # the smallest document of each place of each content; contents that share a key with others are sorted by suffix
    smallest = np.repeat(least[:, None], REACH, axis=1)
    k = keys[heads]
    alone = np.ones(len(k), bool)
    alone[1:] &= k[1:] != k[:-1]
    alone[:-1] &= k[1:] != k[:-1]
    some = np.flatnonzero(~alone)
    if len(some):
        times = lengths[heads[some]]
        of, off = np.repeat(some, times), np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        at, group = starts[heads[of]] + off, k[of]
        by, new = suffixes.classes(at, group)
        begins = np.flatnonzero(new)
        found = np.empty(len(at), np.int64)
        found[by] = np.minimum.reduceat(least[of[by]], begins)[np.cumsum(new) - 1]
        smallest[of, off] = found
    inside = np.arange(REACH) < lengths[:, None]
    out = np.packbits((smallest[which] < docs[:, None]) & inside, axis=1, bitorder="little")
    ends = np.cumsum(sizes).tolist()
    return [out[e - s : e].tobytes() for e, s in zip(ends, sizes, strict=True)]


def _removed(block: Block, p: Pieces, bits: np.ndarray) -> list[tuple[int, int, str] | None]:
    """(bytes removed, runs, hash of what is left) of each text, None where nothing goes."""
    cover = np.zeros(len(block.data) + 1, np.int32)
    which = np.empty(len(p.order), np.int64)
    which[p.order] = np.cumsum(p.first) - 1
    later = p.docs > p.least[which] if len(which) else np.zeros(0, bool)
    # a content that an earlier document of the block has goes whole
    np.add.at(cover, p.starts[later], 1)
    np.add.at(cover, (p.starts + p.lengths + (SPAN - 1))[later], -1)
    own = np.flatnonzero(~later)
    row, off = np.nonzero(bits[which[own]]) if len(own) else (_NONE, _NONE)
    at = p.starts[own[row]] + off
    np.add.at(cover, at, 1)
    np.add.at(cover, at + SPAN, -1)
    covered = np.cumsum(cover)[:-1] > 0
    out: list[tuple[int, int, str] | None] = []
    for a, b in zip(block.begins.tolist(), block.ends.tolist(), strict=True):
        gone = covered[a:b]
        n = int(np.count_nonzero(gone))
        out.append((n, int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1])), hashlib.sha256(block.data[a:b][~gone].tobytes()).hexdigest()) if n else None)
    return out


def repeats_removed(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of docs (doc_id, text); other columns aren't read.

    Each byte goes that is covered by a string of SPAN bytes that also starts in a document with a smaller doc_id. Null texts are empty;
    rows that repeat a doc_id don't count as earlier than each other; rows without doc_id lose nothing and take nothing.
    Texts that an earlier document has whole are settled by their SHA-256 and stay out of the search.
    """
    spark = docs.sparkSession
    small_batches(spark)
    folder, n = new_folder(spark, "blocks"), partitions(spark)
    rows = written(_store(docs, folder), "stored")
    # the aggregate is written so that the join meets two plain exchanges, whose large partitions adaptive execution can split
    firsts = written(rows.where("doc_id is not null").groupBy("sha").agg(F.min("doc_id").alias("first")), "firsts")
    marked = rows.join(firsts, "sha", "left").withColumn("searched", F.col("doc_id").isNotNull() & (F.col("doc_id") == F.col("first")) & (F.col("n_bytes") >= SPAN))
    copy = F.col("doc_id").isNotNull() & (F.col("doc_id") > F.col("first")) & (F.col("n_bytes") >= SPAN)
    # a block has BLOCK_DOCS documents at most
    code = F.when(F.col("searched"), F.col("place")).when(copy, -1 - F.col("place"))
    blocks = written(marked.groupBy("block").agg(F.collect_list(code).alias("places"), F.sum(F.col("n_bytes") * F.col("searched").cast("int")).alias("bytes")), "blocks").coalesce(n)
    total = blocks.agg(F.sum("bytes")).first()[0] or 0
    # so many bits that few keys meet by chance, and parts of a bounded size
    bits = min(64, max(24, int(total // 14 + 1).bit_length() + 9))
    width, parts = -(-bits // 8), max(n, -(-total // PART_BYTES))

    def opened(block: str, places: list[int]) -> Block:
        fs, _base = filesystem(folder)
        mine = [p for p in places if p >= 0]
        ids, texts = _read(fs, block, mine)
        return Block([ids[p] for p in mine], texts)

    def first(block: str, places: list[int], _: list[dict]) -> Iterator[pa.RecordBatch]:
        held = opened(block, places)
        starts, lengths, keys, _names = held.pieces(bits)
        kept, at = np.unique(keys, return_inverse=True)
        many = np.bincount(at, lengths, len(kept)).astype(np.int64)
        yield _dealt(block, _cuts(kept, bits, parts), lambda a, b: _key_message(kept[a:b], many[a:b], width))

    def pieces(held: Block, answers: list[dict]) -> Pieces:
        return Pieces(held, bits, np.frombuffer(b"".join(r["mask"] for r in answers), np.uint8))

    def second(block: str, places: list[int], answers: list[dict]) -> Iterator[pa.RecordBatch]:
        held = opened(block, places)
        p = pieces(held, answers)
        yield _dealt(block, _cuts(p.keys[p.heads], bits, parts), lambda a, b: _piece_message(held, p, a, b, width))

    def last(block: str, places: list[int], answers: list[dict]) -> Iterator[pa.RecordBatch]:
        held = opened(block, places)
        p = pieces(held, [r for r in answers if r["part"] < parts])
        masks = np.frombuffer(b"".join(r["mask"] for r in answers if r["part"] >= parts), np.uint8).reshape(-1, -(-REACH // 8))
        found = _removed(held, p, np.unpackbits(masks, axis=1, count=REACH, bitorder="little").astype(bool))
        fs, _base = filesystem(folder)
        ids, texts = _read(fs, block)
        mine, copies = [x for x in places if x >= 0], {-1 - x for x in places if x < 0}
        result, nothing = dict(zip(mine, found, strict=True)), hashlib.sha256(b"").hexdigest()
        sizes = [len(x.as_buffer()) for x in texts]
        out = [(size, 1, nothing) if i in copies else result.get(i) or (0, 0, hashlib.sha256(x.as_buffer()).hexdigest()) for i, (x, size) in enumerate(zip(texts, sizes, strict=True))]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), *[pa.array([x[j] for x in out], t) for j, t in enumerate((pa.int64(), pa.int64(), pa.string()))]], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    sends = "part int, block string, data binary"
    shared = written(_answered(_by_block(blocks, None, n, first, sends), n, lambda m: _key_answers(m, width, hot)), "shared")
    # pieces move once and aren't kept; the last step gets both answers, those for pieces with parts from `parts` on
    earlier = written(_answered(_by_block(blocks, shared, n, second, sends), n, lambda m: _piece_answers(m, width)), "earlier")
    answers = shared.unionByName(earlier.withColumn("part", (F.col("part") + parts).cast("int")))
    return _by_block(blocks, answers, n, last, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the byte strings of 50 that an earlier one holds too, as sizes and the hash of what is left."""
    return repeats_removed(table(spark, sf_dir, "documents"))


#: Every string of 50 bytes of every document, which SQL can do on small tables.
OP2_SQL = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, strlen(coalesce(text, '')) AS n FROM documents),
p AS (SELECT doc_id, i, array_slice(b, i + 1, i + 50) AS s FROM (SELECT doc_id, b, unnest(range(n - 49)) AS i FROM d WHERE n >= 50)),
g AS (SELECT s, min(doc_id) AS first FROM p GROUP BY s HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT p.doc_id, p.i FROM p JOIN g ON p.s = g.s WHERE g.first < p.doc_id),
runs AS (SELECT doc_id, i, sum(CASE WHEN i - before <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (SELECT doc_id, i, coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -1000) AS before FROM hit)),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS e FROM runs GROUP BY doc_id, run),
cuts AS (SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY a), 0) AS f, a AS t, e - a AS gone FROM spans),
ends AS (SELECT s.doc_id, max(s.e) AS f, any_value(d.n) AS t, 0 AS gone FROM spans s JOIN d USING (doc_id) GROUP BY s.doc_id),
kept AS (SELECT c.doc_id, sum(c.gone) AS n_removed, count(*) FILTER (c.gone > 0) AS n_spans, sha256(unhex(string_agg(hex(array_slice(d.b, c.f + 1, c.t)), '' ORDER BY c.f))) AS h FROM (FROM cuts UNION ALL FROM ends) c JOIN d USING (doc_id) GROUP BY c.doc_id)
SELECT d.doc_id, d.n AS n_bytes, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed, coalesce(k.n_spans, 0) AS n_spans, coalesce(k.h, sha256(d.b)) AS kept_sha256 FROM d LEFT JOIN kept k USING (doc_id)
"""
