"""Token ids of documents, written as wavelet matrix files in ascending order of their keys."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import hashing, wavelet
from ._util import filesystem, new_folder, partitions, small_batches, table, written

#: Ids of a file at most, unless a single document has more: what a task holds at a time.
FILE_TOKENS = 1 << 22
#: Pieces that a worker remembers, about 40 bytes each.
REMEMBERED = 1 << 22
#: Bytes of texts that are cut at once, unless a single text has more: some 50 bytes are held for each of them.
AT_ONCE = 1 << 19

# The tokenizer's own split, for lower-cased text of Latin-1, where a code point is a byte: runs of letters, single digits, runs of other signs.
_SPACE, _LETTER, _DIGIT, _OTHER = 0, 1, 2, 3
_LATIN = bytes(range(256)).decode("latin-1")
_CLASSES = np.array([_LETTER if c.isalpha() else _DIGIT if c.isnumeric() else _SPACE if c in "\t\n\v\f\r \x85\xa0" else _OTHER for c in _LATIN], np.uint8)
_LOWER = bytes(ord(c.lower()) for c in _LATIN)
# A byte's sign in the tokenizer's vocabulary: itself where it is printable, else the next beyond Latin-1.
_SHOWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_SIGNS = {b: chr(b) for b in _SHOWN} | {b: chr(256 + n) for n, b in enumerate(x for x in range(256) if x not in set(_SHOWN))}
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)
_U = np.uint64


def pieces(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the pieces of lower-cased Latin-1 bytes that end with eight blanks. An apostrophe that begins a run takes s, t, re, ve, m, ll or d with it."""
    kind = _CLASSES[data]
    begins = kind != _SPACE
    begins[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    starts = np.flatnonzero(begins)
    ends = kind != _SPACE
    ends[:-1] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    stops = np.flatnonzero(ends) + 1
    quote = np.flatnonzero(data[starts] == 39)
    if len(quote):
        at = starts[quote]
        one, two = data[at + 1], data[at + 2]
        size = np.where(np.isin(one, np.frombuffer(b"stmd", np.uint8)), 1, np.where(((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108), 2, 0))
        # the run of signs is the apostrophe alone, and the letters after it are the next run
        hit = np.flatnonzero((size > 0) & (stops[quote] == at + 1))
        quote, size = quote[hit], size[hit]
        stops[quote] += size
        starts[quote + 1] += size
        keep = starts < stops
        starts, stops = starts[keep], stops[keep]
    return starts, stops - starts


class PieceEncoder:
    """Encodes whole texts by their pieces, whose ids are remembered: no token crosses a piece.

    Texts in Latin-1 are lower-cased and cut for a whole group at once. Others go to the tokenizer as they are, and so do texts that may hold one
    of its special tokens. Pieces are looked up by a hash of 64 bits and told apart by their length, first and last eight bytes.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.keys, self.checks = np.zeros(0, _U), np.zeros(0, _U)
        self.at, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _whole(self, text: bytes) -> np.ndarray:
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, np.uint32)

    def _tokenized(self, piece: bytes) -> list[int]:
        signs = piece.decode() if piece.isascii() and piece.isalpha() else "".join(map(_SIGNS.__getitem__, piece.decode("latin-1").encode()))
        return [t.id for t in self.tokenizer.model.tokenize(signs)]

    def _places(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in the pool each piece's ids are, and how many."""
        words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
        head = words[starts] & _MASKS[np.minimum(lengths, 8)]
        tail = words[starts + np.maximum(lengths - 8, 0)] & _MASKS[np.minimum(lengths, 8)]
        checks = hashing.mixed(head + tail * _U(0x9E3779B97F4A7C15) + lengths.astype(_U))
        one, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        if (checks != checks[first][inverse]).any():
            raise ValueError("two pieces share a hash")

        def known() -> tuple[np.ndarray, np.ndarray]:
            slot = np.minimum(np.searchsorted(self.keys, one), max(len(self.keys) - 1, 0))
            return slot, self.keys[slot] == one if len(self.keys) else np.zeros(len(one), bool)

        slot, has = known()
        if not has.all():
            if len(self.keys) + np.count_nonzero(~has) > REMEMBERED:
                self._forget()
                has[:] = False
            fresh = np.flatnonzero(~has)
            a, n = starts[first[fresh]].tolist(), lengths[first[fresh]].tolist()
            raw = data.tobytes()
            ids = [self._tokenized(raw[x : x + k]) for x, k in zip(a, n, strict=True)]
            sizes = np.array([len(x) for x in ids], np.int64)
            at = len(self.pool) + np.cumsum(sizes) - sizes
            self.pool = np.concatenate([self.pool, np.array([t for x in ids for t in x], np.uint32)])
            keys = np.concatenate([self.keys, one[fresh]])
            order = np.argsort(keys, kind="stable")
            self.keys = keys[order]
            self.checks, self.at, self.sizes = (np.concatenate(x)[order] for x in ((self.checks, checks[first[fresh]]), (self.at, at), (self.sizes, sizes)))
            slot, has = known()
        if (self.checks[slot] != checks[first]).any():
            raise ValueError("two pieces share a hash")
        return self.at[slot][inverse], self.sizes[slot][inverse]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text. Texts are taken in groups of at most AT_ONCE bytes, so that what is held doesn't grow with a batch's texts."""
        out: list[np.ndarray] = []
        group: list[bytes] = []
        size = 0
        for text in texts:
            if group and size + len(text) > AT_ONCE:
                out += self._group(group)
                group, size = [], 0
            group.append(text)
            size += len(text)
        return out + self._group(group)

    def _group(self, texts: list[bytes]) -> list[np.ndarray]:
        plain: list[bytes] = []
        out: list[np.ndarray | None] = []
        for text in texts:
            latin = text
            if not text.isascii():
                try:
                    latin = text.decode().encode("latin-1")
                except UnicodeEncodeError:
                    latin = None
            if latin is None or b"<|" in latin:
                out.append(self._whole(text))
            else:
                out.append(None)
                plain.append(latin.translate(_LOWER))
        if not plain:
            return out
        data = np.frombuffer(b"".join(x + b" " for x in plain) + b" " * 8, np.uint8)
        starts, lengths = pieces(data)
        ends = np.cumsum([len(x) + 1 for x in plain])
        prefix = hashing.prefixes(data)
        keys = hashing.mixed((prefix[starts + lengths] - prefix[starts]) * hashing.powers(len(data), hashing.INVERSE, "down")[starts] + lengths.astype(_U) * _U(0xD6E8FEB86659FD93))
        try:
            at, sizes = self._places(data, starts, lengths, keys)
        except ValueError:  # never seen: the tokenizer does the group
            own = iter([self._whole(t) for t, o in zip(texts, out, strict=True) if o is None])
            return [next(own) if o is None else o for o in out]
        total = np.cumsum(sizes)
        ids = self.pool[np.arange(total[-1] if len(total) else 0) + np.repeat(at - (total - sizes), sizes)]
        cuts = np.concatenate([[0], total])[np.searchsorted(starts, ends)]
        own = iter(np.split(ids, cuts[:-1]))
        return [next(own) if o is None else o for o in out]


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """This process's encoder for the tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, key: str = "doc_id", text: str = "text", order: Column | None = None) -> DataFrame:
    """Writes the ids of every whole text, each with end_id appended, and returns the list of files.

    Files (file, part, piece, n_docs, n_tokens) hold documents in ascending order of key (or of order, if given), null keys first; documents that
    repeat a key stay beside each other, by their text. A null text is empty: it has the end id only.
    A task that is run again writes files of other names, and only those of the run that counts are listed.
    """
    small_batches(docs.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        encode, part = encoder(tokenizer), TaskContext.get().partitionId()
        end, held, ids, counts, piece = np.array([end_id], "<u4"), 0, [], [], 0
        keys: list[int | None] = []

        def flush() -> pa.RecordBatch:
            nonlocal held, ids, counts, keys, piece
            name = f"{base}/{part:06d}-{piece:04d}-{uuid.uuid4().hex}.llwm"
            fs.create_dir(base, recursive=True)
            with fs.open_output_stream(name) as to:
                to.write(wavelet.build(np.concatenate(ids), keys, counts))
            row = pa.RecordBatch.from_pydict({"file": [name], "part": [part], "piece": [piece], "n_docs": [len(keys)], "n_tokens": [held]}, schema=listed)
            held, ids, counts, keys, piece = 0, [], [], [], piece + 1
            return row

        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            for doc, own in zip(batch.column("key").to_pylist(), encode.encode(texts), strict=True):
                ids += [own, end]
                counts.append(len(own) + 1)
                keys.append(doc)
                held += len(own) + 1
                if held >= FILE_TOKENS:
                    yield flush()
        if keys:
            yield flush()

    listed = pa.schema([("file", pa.string()), ("part", pa.int32()), ("piece", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), (F.col(key).cast("long") if order is None else order).alias("order"))
    dealt = rows.repartitionByRange(partitions(docs.sparkSession), "order").sortWithinPartitions("order", "key", "text")
    return written(dealt.mapInArrow(write, "file string, part int, piece int, n_docs long, n_tokens long"), "token-files")


def read_tokens(files: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the listed files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(folder)
        for batch in batches:
            for name, before in zip(batch.column("file").to_pylist(), batch.column("before").to_pylist(), strict=True):
                with fs.open_input_stream(name) as of:
                    held = wavelet.WaveletFile(of.read())
                ids = held.ids().astype("<u4")
                raw, at = memoryview(ids.view(np.uint8)), held.starts
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(held.doc_ids, pa.int64()), "start": pa.array(at[:-1] + before), "n_tokens": pa.array(held.counts), "ids_crc32": pa.array(crc, pa.int64())})

    # one row a file: a running sum over the list of files
    before = Window.orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    return placed.repartition(partitions(files.sparkSession)).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def token_files(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2, key: str = "doc_id", order: Column | None = None) -> DataFrame:
    """Writes docs and reads them back: see write_tokens and read_tokens."""
    folder = new_folder(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, folder, tokenizer or default_tokenizer(), end_id, key, order=order), folder)


def op9_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"))
