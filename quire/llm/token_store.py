"""Token ids as raw binary shards, with a minimal perfect hash index in each for keyed access.

Writing: rows are range-partitioned by key, so that shard after shard holds ascending keys; each task encodes its rows
and writes one file. A file name is never used twice, and only the names that successful tasks return enter the
manifest, so retried and speculative tasks do no harm.

A shard file, all numbers little-endian::

    0   payload     n_tokens ids, in document order
    ..  offsets     n_docs + 1 uint64, in ids
    ..  keys        n_docs int64 (0 where null), then n_docs uint8 null flags
    ..  levels      n_levels uint64: bits of each level of the hash
    ..  level bits  packed, each level padded to whole bytes
    ..  slots       n_keys of (uint32 fingerprint, uint32 first document, uint32 documents)
    -72 tail        magic b"QTOK0001", then eight uint64: n_docs, n_tokens, bytes per id (2 or 4), n_keys, n_levels, 0, 0, 0

The index hashes a key level by level: the first level where the key's bit is set gives the slot, namely the number of
set bits before it. Slots are as many as distinct keys (minimal), the fingerprint turns away keys that are not in the
shard, and a lookup costs a few bit tests whatever the number of documents. Repeated keys share a slot and are adjacent.
"""

from __future__ import annotations

import gc
import os
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep_until_exit, make_folder, new_path, slices, stash, tidy

MAGIC = b"QTOK0001"
#: Bits per key in each level of the hash.
GAMMA = 2.0
#: Pieces of text that an encoder keeps the ids of; those that come later are encoded again each time.
KEPT_PIECES = 800_000
#: What counts as white space in any reading, for Arrow's regular expressions.
_WHITE = r"[\x09-\x0D\x1C-\x20\x{85}\x{180E}\x{200B}\pZ]"
#: Marks that are cut off the end of a word.
_MARKS = ".,;:!?"
MANIFEST = "shard long, file string, lowest long, highest long, has_null boolean, n_docs long, n_tokens long"


# ------------------------------------------------------------------ encoding


class _Places(dict):
    """The place of each piece; asking for a new piece gives it the next place and notes it in ``new``."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        n = self[piece] = len(self)
        self.new.append(piece)
        return n


class Encoder:
    """Encodes texts with a tokenizers file whose pre-tokenizer is the byte-level one with a leading space.

    Such a pre-tokenizer always cuts before a space, and around a line feed, that stands alone between other
    characters. So text is cut there, each distinct piece is encoded once by the library, and ids are put together.
    A text in which white space is adjacent to white space, or that holds NUL, is given to the library as it is.
    """

    def __init__(self, path: str, end_id: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end_id = end_id
        self.dtype = np.dtype("<u2" if max(self.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1) <= 1 << 16 else "<u4")
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = "|".join([rf"{_WHITE}{_WHITE}", rf"^{_WHITE}", rf"{_WHITE}$", r"\x00", *special])
        self.known: dict[str, list[int]] = {}
        self.places = _Places()
        self.flat = np.zeros(1 << 20, self.dtype)
        self.start = np.zeros(1 << 16, np.int64)

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The place of each piece of all texts, and the pieces of each text: a word stands for itself with a space before
        it, and after NUL for itself alone. Texts are cut, and their distinct pieces found, by Arrow."""
        texts = texts.cast(pa.large_string()).fill_null("")
        odd = pc.match_substring_regex(texts, self.odd)
        counts = np.ones(len(texts), np.int64)
        counts[pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)] = 0
        whole = odd.to_numpy(zero_copy_only=False)
        plain = texts.filter(pa.array(~whole & (counts > 0)))
        lists = pc.split_pattern(pc.binary_join_element_wise(pa.scalar("", pa.large_string()), pc.replace_substring(plain, "\n", " \n \0"), pa.scalar("\0", pa.large_string())), " ")
        counts[~whole & (counts > 0)] = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        coded = pc.dictionary_encode(pc.list_flatten(lists))
        of_piece = np.fromiter(map(self.places.__getitem__, coded.dictionary.to_numpy(zero_copy_only=False)), np.int64, len(coded.dictionary))
        at = np.empty(int(counts.sum()), np.int64)
        single = np.repeat(whole, counts)
        at[~single] = of_piece[coded.indices.to_numpy(zero_copy_only=False)] if len(of_piece) else 0
        at[single] = np.fromiter((self.places["\0" + t] for t in texts.filter(odd).to_pylist()), np.int64, int(whole.sum()))
        return at, counts

    def _ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces, and how many each has. Marks at the end of a word of letters are cut off first: the
        pre-tokenizer does so too, and far fewer distinct words are left."""
        stems, marks = [], []
        for p in pieces:
            p = p[1:] if p[0] == "\0" else p if p == "\n" else " " + p
            if p[-1:] not in _MARKS or not (stem := p.rstrip(_MARKS)).removeprefix(" ").isalpha():
                stem = p
            stems.append(stem)
            marks.append(p[len(stem) :])
        new = [x for x in dict.fromkeys(chain(stems, filter(None, marks))) if x not in self.known]
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            self.known.update(zip(part, [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)], strict=True))
        known = self.known
        ids = [known[s] + known[m] if m else known[s] for s, m in zip(stems, marks, strict=True)]
        if len(known) > KEPT_PIECES // 4:
            known.clear()
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), self.dtype, int(lengths.sum())), lengths

    def _learn(self, first: int, pieces: list[str]) -> None:
        collects = gc.isenabled()
        gc.disable()  # a list of ids for each piece, and no cycles: looking for some would only take time
        try:
            ids, lengths = self._ids(pieces)
        finally:
            if collects:
                gc.enable()
        used, n = int(self.start[first]), first + len(pieces)
        while used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + 1 > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
        self.flat[used : used + len(ids)] = ids
        self.start[first + 1 : n + 1] = used + np.cumsum(lengths)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, each text's followed by the end id, and the number of ids of each text; null counts as empty."""
        before = len(self.places)
        at, counts = self._cut(texts)
        n = len(at)
        if self.places.new:
            self._learn(before, self.places.new)
            if len(self.places) > KEPT_PIECES:
                for p in self.places.new:
                    del self.places[p]
            self.places.new = []
        first, length = self.start[at], self.start[at + 1] - self.start[at]
        ends = np.cumsum(length)
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        total = int(ends[-1]) if n else 0
        source = np.arange(total, dtype=np.int64) + np.repeat(first - (ends - length), length)
        sizes = np.diff(bounds) + 1
        out = np.full(total + len(texts), self.end_id, self.dtype)
        last = np.zeros(total + len(texts), bool)
        last[np.cumsum(sizes) - 1] = True
        out[~last] = self.flat[source]
        return out, sizes


@lru_cache(1)
def _encoder(path: str, end_id: int) -> Encoder:
    """One encoder a Python worker, whatever the number of its tasks: what it has learned stays."""
    return Encoder(path, end_id)


# ------------------------------------------------------------------ the minimal perfect hash


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each key (the finaliser of splitmix64)."""
    x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, 1 << 20) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys: a cascade of bit arrays, in which a key that falls alone on a bit
    of a level sets it and the others go on to the next level."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        bits = np.concatenate(levels) if levels else np.zeros(0, bool)
        self.rank = np.concatenate([[0], np.cumsum(bits)])
        self.base = np.concatenate([[0], np.cumsum([len(x) for x in levels])]).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys.astype(np.uint64)
        while len(left):
            spot = _mix(left, len(levels)) % np.uint64(max(64, int(GAMMA * len(left))))
            count = np.bincount(spot.astype(np.int64), minlength=max(64, int(GAMMA * len(left))))
            levels.append(count == 1)
            left = left[count[spot.astype(np.int64)] > 1]
        return cls(levels)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 where the key surely isn't one of those that were hashed."""
        out, keys = np.full(len(keys), -1, np.int64), keys.astype(np.uint64)
        open_ = np.arange(len(keys))
        for k, bits in enumerate(self.levels):
            spot = (_mix(keys[open_], k) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[spot]
            out[open_[hit]] = self.rank[self.base[k] + spot[hit]]
            open_ = open_[~hit]
        return out


# ------------------------------------------------------------------ a shard


def _place(path: str) -> tuple[pafs.FileSystem, str]:
    fs, at = pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else "file://" + path)
    return fs, at


def _footer(keys: np.ndarray, null: np.ndarray, sizes: np.ndarray) -> tuple[list[bytes], int, int]:
    nulls = int(null.sum())  # they come first, and have no slot
    fresh = np.concatenate([[True], keys[nulls + 1 :] != keys[nulls:-1]]) if len(keys) > nulls else np.zeros(0, bool)
    first = nulls + np.flatnonzero(fresh)
    code = keys[first].view(np.uint64)
    hashed = PerfectHash.build(code)
    slots = np.zeros(len(first), np.dtype([("f", "<u4"), ("first", "<u4"), ("n", "<u4")]))
    at = hashed.slot(code)
    slots["f"][at], slots["first"][at], slots["n"][at] = fingerprint(code), first, np.diff(np.append(first, len(keys)))
    parts = [
        np.concatenate([[0], np.cumsum(sizes)]).astype("<u8").tobytes(), keys.astype("<i8").tobytes(), null.astype("u1").tobytes(),
        np.array([len(x) for x in hashed.levels], "<u8").tobytes(), b"".join(np.packbits(x).tobytes() for x in hashed.levels), slots.tobytes(),
    ]
    return parts, len(first), len(hashed.levels)


def _write_shards(folder: str, make: Callable[[], Encoder]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        fs, at = _place(folder)
        encoder, name = None, f"{uuid.uuid4().hex}.bin"
        keys, nulls, sizes, total, out = [], [], [], 0, None
        try:
            for batch in batches:
                for part in slices(batch, 1, 4 << 20):
                    encoder = encoder or make()
                    if out is None:
                        out = fs.open_output_stream(f"{at}/{name}.open")
                    ids, n = encoder.encode(part.column(1))
                    out.write(ids.tobytes())
                    total += len(ids)
                    sizes.append(n)
                    nulls.append(part.column(0).is_null().to_numpy(zero_copy_only=False))
                    keys.append(part.column(0).fill_null(0).to_numpy())
            if out is None:
                return
            keys, nulls, sizes = np.concatenate(keys), np.concatenate(nulls), np.concatenate(sizes)
            parts, n_keys, n_levels = _footer(keys, nulls, sizes)
            for p in parts:
                out.write(p)
            head = MAGIC + np.array([len(keys), total, encoder.dtype.itemsize, n_keys, n_levels, 0, 0, 0], "<u8").tobytes()
            out.write(head)
            out.close()
            fs.move(f"{at}/{name}.open", f"{at}/{name}")
        finally:
            if out is not None and not out.closed:
                out.close()
        real = keys[~nulls]
        low, high = (int(real[0]), int(real[-1])) if len(real) else (None, None)
        row = [TaskContext.get().partitionId(), name, low, high, bool(nulls.any()), len(keys), total]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()), strict=True)], names=[x.split()[0] for x in MANIFEST.split(", ")])

    return write


class Shard:
    """One file, opened for reading. ``ids(i)`` reads the ids of the i-th document; ``find(keys)`` looks keys up."""

    def __init__(self, folder: str, name: str):
        fs, at = _place(folder)
        self.file = fs.open_input_file(f"{at}/{name}")
        size = self.file.size()
        head = self.file.read_at(72, size - 72)
        if head[:8] != MAGIC:
            raise ValueError(f"{folder}/{name} isn't a token shard")
        self.n_docs, self.n_tokens, width, n_keys, n_levels = np.frombuffer(head, "<u8", 5, 8).astype(np.int64).tolist()
        self.dtype = np.dtype(f"<u{width}")
        rest = self.file.read_at(size - 72 - self.n_tokens * width, self.n_tokens * width)
        self.offsets = np.frombuffer(rest, "<u8", self.n_docs + 1).astype(np.int64)
        here = 8 * (self.n_docs + 1)
        self.keys = np.frombuffer(rest, "<i8", self.n_docs, here)
        here += 8 * self.n_docs
        self.null = np.frombuffer(rest, "u1", self.n_docs, here).astype(bool)
        here += self.n_docs
        lengths = np.frombuffer(rest, "<u8", n_levels, here).astype(np.int64)
        here += 8 * n_levels
        levels = []
        for n in lengths:
            levels.append(np.unpackbits(np.frombuffer(rest, "u1", (n + 7) // 8, here), count=n).astype(bool))
            here += (n + 7) // 8
        self.hash = PerfectHash(levels)
        self.slots = np.frombuffer(rest, np.dtype([("f", "<u4"), ("first", "<u4"), ("n", "<u4")]), n_keys, here)

    def find(self, keys: np.ndarray, null: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The first document and the number of documents of each key, or of rows without one; (-1, 0) for a key that the shard doesn't hold."""
        if null:  # they come first
            n = int(self.null.sum())
            return np.full(len(keys), 0 if n else -1, np.int64), np.full(len(keys), n, np.int64)
        code = np.asarray(keys, np.int64)
        slot = self.hash.slot(code.view(np.uint64))
        hit = np.flatnonzero(slot >= 0)
        hit = hit[self.slots["f"][slot[hit]] == fingerprint(code[hit].view(np.uint64))]
        first, n = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        first[hit], n[hit] = self.slots["first"][slot[hit]], self.slots["n"][slot[hit]]
        return first, n

    def read(self, first: int, last: int) -> np.ndarray:
        """The ids of documents first to last - 1, one after another."""
        a, b, w = int(self.offsets[first]), int(self.offsets[last]), self.dtype.itemsize
        return np.frombuffer(self.file.read_at((b - a) * w, a * w), self.dtype)

    def ids(self, i: int) -> np.ndarray:
        return self.read(i, i + 1)


class TokenStore:
    """A folder of shards and its manifest, a DataFrame with one row per shard."""

    def __init__(self, spark: SparkSession, folder: str, manifest: DataFrame):
        self.spark, self.folder, self.manifest = spark, folder, manifest
        self.shards = sorted(manifest.collect())  # a row a file: bounded by the number of write tasks

    def get(self, key: int | None) -> list[np.ndarray]:
        """The ids of each document with this key: the manifest's bounds give the shards, the index gives the place."""
        if key is None:
            shards = [s for s in self.shards if s.has_null]
        else:
            lows = [s for s in self.shards if s.lowest is not None]
            stop = bisect_right([s.lowest for s in lows], key)
            shards = []
            while stop and lows[stop - 1].highest >= key:
                shards.insert(0, lows[stop - 1])
                stop -= 1
        out = []
        for s in shards:
            shard = Shard(self.folder, s.file)
            first, n = shard.find(np.array([key or 0]), null=key is None)
            out += [shard.ids(int(first[0]) + i) for i in range(int(n[0]))]
        return out

    def documents(self) -> DataFrame:
        """Read back: ``doc_id, start, n_tokens, ids_crc32`` of each document; start counts the ids of all documents before it.

        Each shard's documents are found through its index and read in blocks of bounded size.
        """
        base, rows = 0, []
        for s in self.shards:
            rows.append((s.file, base))
            base += s.n_tokens
        schema = T.StructType([T.StructField("file", T.StringType()), T.StructField("base", T.LongType())])
        files = self.spark.createDataFrame(rows, schema)
        return files.repartition(max(1, len(rows)), "file").mapInArrow(_reader(self.folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def _reader(folder: str, most: int = 1 << 20):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = Shard(folder, name)
                first, n = shard.find(shard.keys[~shard.null])
                if (n < 1).any() or (first < 0).any() or (shard.keys[first] != shard.keys[~shard.null]).any():
                    raise ValueError(f"the index of {name} doesn't give its documents")
                at = 0
                while at < shard.n_docs:
                    stop = max(at + 1, int(np.searchsorted(shard.offsets, shard.offsets[at] + most, "right")) - 1)
                    ids, here = shard.read(at, stop).astype("<u4"), shard.offsets[at : stop + 1] - shard.offsets[at]
                    crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(here[:-1], here[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard.keys[at:stop], pa.int64(), mask=shard.null[at:stop]), pa.array(base + shard.offsets[at:stop], pa.int64()), pa.array(np.diff(here), pa.int64()), pa.array(crc, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )
                    at = stop

    return read


@tidy
def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text", folder: str | None = None) -> TokenStore:
    """Encode every whole text and write the shards, in ascending order of the key (null first).

    Null text counts as empty, which gives the end id alone. Rows with the same key are kept, next to each other, in an
    order of their text only. An empty table gives a store without shards. Other columns are not read. The
    sort key has a hash of the text besides the key, so that one key with very many rows is dealt over several shards.
    """
    spark = docs.sparkSession
    folder, own = folder or new_path(spark, "tokens"), folder is None
    folder = make_folder(spark, folder)
    if own:
        keep_until_exit(spark, folder)
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"), F.xxhash64(text).alias("salt"))
    rows = rows.repartitionByRange(F.col("k").asc_nulls_first(), "salt").sortWithinPartitions(F.col("k").asc_nulls_first(), "salt", "t").select("k", "t")
    manifest = stash(rows.mapInArrow(_write_shards(folder, lambda: _encoder(tokenizer, end_id)), MANIFEST), "tokens-manifest")
    return TokenStore(spark, folder, manifest)
