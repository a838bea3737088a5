"""Token ids in one compressed file: a wavelet matrix with rank and select.

Level k holds bit (levels - 1 - k) of every id; after each level the ids with a 0 go before those with a 1,
both in their order. A plane is cut into blocks of BLOCK bits, each compressed by itself, with the
number of ones before it: token access, rank and select read one block of each plane.

File: MAGIC, uint32 length of the header, header (JSON), then the sections that it names. All numbers are little-endian.
"""

from __future__ import annotations

import json
import struct

import numpy as np
import zstandard

MAGIC = b"LLWM0001"
BLOCK = 1 << 18  # bits, 32 KiB


def build(ids: np.ndarray, doc_ids: list[int | None], counts: list[int], levels: int = 16, level: int = 1) -> bytes:
    """One file with the ids (below 2 ** levels) of documents that follow each other; counts has the ids of each."""
    if len(ids) and int(ids.max()) >> levels:
        raise ValueError("an id doesn't fit into the planes")
    pack = zstandard.ZstdCompressor(level=level)
    body: list[bytes] = []
    at = 0

    def put(part: bytes) -> list[int]:
        nonlocal at
        body.append(part)
        at += len(part)
        return [at - len(part), len(part)]

    x = ids.astype(np.uint16 if levels <= 16 else np.uint32)
    planes = []
    for k in range(levels):
        one = (x >> x.dtype.type(levels - 1 - k) & x.dtype.type(1)).astype(bool)
        bits = np.packbits(one, bitorder="little").tobytes()
        cuts = range(0, len(x), BLOCK)
        ones = [0, *np.cumsum([np.count_nonzero(one[c : c + BLOCK]) for c in cuts]).tolist()]
        planes.append({"blocks": [put(pack.compress(bits[c // 8 : (c + BLOCK) // 8])) for c in cuts], "ones": ones})
        x = np.concatenate([np.compress(~one, x), np.compress(one, x)])
    known = np.array([d is not None for d in doc_ids], np.uint8)
    keys = np.array([0 if d is None else d for d in doc_ids], "<i8")
    head = {
        "tokens": len(ids), "docs": len(doc_ids), "levels": levels, "block": BLOCK, "planes": planes,
        "doc_ids": put(pack.compress(keys.tobytes())), "known": put(pack.compress(known.tobytes())), "counts": put(pack.compress(np.array(counts, "<u4").tobytes())),
    }
    raw = json.dumps(head, separators=(",", ":")).encode()
    return MAGIC + struct.pack("<I", len(raw)) + raw + b"".join(body)


class WaveletFile:
    """Reads such a file; data is its bytes."""

    def __init__(self, data: bytes) -> None:
        if data[:8] != MAGIC:
            raise ValueError("not a wavelet matrix file")
        (n,) = struct.unpack_from("<I", data, 8)
        self.head = json.loads(data[12 : 12 + n])
        self._body = memoryview(data)[12 + n :]
        self._unpack = zstandard.ZstdDecompressor()
        self._blocks: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        self.tokens, self.levels, self.planes = self.head["tokens"], self.head["levels"], self.head["planes"]
        known = np.frombuffer(self._part(self.head["known"]), np.uint8)
        self.doc_ids = [int(d) if k else None for d, k in zip(np.frombuffer(self._part(self.head["doc_ids"]), "<i8"), known, strict=True)]
        self.counts = np.frombuffer(self._part(self.head["counts"]), "<u4").astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)]).astype(np.int64)

    def _part(self, where: list[int]) -> bytes:
        return self._unpack.decompress(self._body[where[0] : where[0] + where[1]])

    def _block(self, k: int, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Words of 64 bits of a block of plane k, and the ones before each word; kept once unpacked."""
        held = self._blocks.get((k, block))
        if held is None:
            raw = self._part(self.planes[k]["blocks"][block])
            words = np.frombuffer(raw + b"\0" * (-len(raw) % 8), "<u8")
            ones = np.bitwise_count(words).astype(np.int64)
            held = self._blocks[k, block] = words, np.cumsum(ones) - ones
        return held

    def _zeros(self, k: int) -> int:
        return self.tokens - self.planes[k]["ones"][-1]

    def _looked_up(self, k: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bit of plane k at each position, and the ones before it. A position at the end has a 0."""
        bits, ranks = np.zeros(len(at), bool), np.full(len(at), self.planes[k]["ones"][-1], np.int64)
        block = at // BLOCK
        for b in np.unique(block[at < self.tokens]).tolist():
            here = np.flatnonzero((block == b) & (at < self.tokens))
            words, before = self._block(k, b)
            rest = at[here] - b * BLOCK
            word, bit = words[rest >> 6], (rest & 63).astype(np.uint64)
            bits[here] = word >> bit & np.uint64(1)
            ranks[here] = self.planes[k]["ones"][b] + before[rest >> 6] + np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
        return bits, ranks

    def _select(self, k: int, bit: int, n: int) -> int:
        """Position of the n-th (from 0) such bit of plane k."""
        ones = np.asarray(self.planes[k]["ones"])
        held = ones if bit else np.minimum(np.arange(len(ones)) * BLOCK, self.tokens) - ones
        block = int(np.searchsorted(held, n, side="right")) - 1
        words, before = self._block(k, block)
        before = before if bit else 64 * np.arange(len(words)) - before
        rest = n - int(held[block])
        word = int(np.searchsorted(before, rest, side="right")) - 1
        inside = np.unpackbits(words[word : word + 1].view(np.uint8), bitorder="little")
        return block * BLOCK + 64 * word + int(np.flatnonzero(inside == bit)[rest - int(before[word])])

    def accessed(self, at: np.ndarray) -> np.ndarray:
        """The token ids at these positions; each plane's blocks are unpacked once."""
        at = np.array(at, np.int64)
        if len(at) and not (0 <= at.min() and at.max() < self.tokens):
            raise IndexError("position outside the file")
        value = np.zeros(len(at), np.int64)
        for k in range(self.levels):
            bits, ranks = self._looked_up(k, at)
            at = np.where(bits, self._zeros(k) + ranks, at - ranks)
            value = value << 1 | bits
        return value

    def access(self, i: int) -> int:
        """The i-th token id."""
        return int(self.accessed(np.array([i]))[0])

    def _down(self, token: int, i: int) -> tuple[int, int]:
        ends = np.array([0, i])
        for k in range(self.levels):
            ranks = self._looked_up(k, ends)[1]
            ends = self._zeros(k) + ranks if token >> (self.levels - 1 - k) & 1 else ends - ranks
        return int(ends[0]), int(ends[1])

    def rank(self, token: int, i: int) -> int:
        """Occurrences of token before position i."""
        a, b = self._down(token, i) if 0 <= token < 1 << self.levels else (0, 0)
        return b - a

    def count(self, token: int) -> int:
        return self.rank(token, self.tokens)

    def select(self, token: int, n: int) -> int:
        """Position of the n-th (from 0) occurrence of token."""
        if not 0 <= n < self.count(token):
            raise IndexError(n)
        i = self._down(token, 0)[0] + n
        for k in reversed(range(self.levels)):
            bit = token >> (self.levels - 1 - k) & 1
            i = self._select(k, bit, i - self._zeros(k) if bit else i)
        return i

    def ids(self) -> np.ndarray:
        """All ids in their order."""
        kind = np.uint16 if self.levels <= 16 else np.uint32
        below = np.zeros(self.tokens, kind)
        for k in reversed(range(self.levels)):
            one = np.unpackbits(np.frombuffer(b"".join(map(self._part, self.planes[k]["blocks"])), np.uint8), count=self.tokens, bitorder="little").astype(bool)
            zeros, bit = self._zeros(k), kind(1 << (self.levels - 1 - k))
            below[zeros:] |= bit
            here = np.empty(self.tokens, kind)
            here[np.flatnonzero(~one)] = below[:zeros]
            here[np.flatnonzero(one)] = below[zeros:]
            below = here
        return below

    def document(self, n: int) -> np.ndarray:
        """The ids of the n-th document of the file, by token access."""
        return self.accessed(np.arange(self.starts[n], self.starts[n + 1]))
