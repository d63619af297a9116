"""Benchmark decontamination by spaced-seed hashing.

A spaced seed hashes the words of a window at the places that its mask marks and ignores the others, so that substituted
words there don't matter. The masks together find every overlap of 13 words with at most 2 substituted ones. Seeds of
benchmark items are joined with those of all windows of all documents: the benchmark is a stated query set, which goes
in blocks of bounded bytes to the tasks, as a hash table of seeds, while documents stream past and are never shuffled. Around a hit, document and item are
compared word by word along its diagonal. The best stretch, in which a match counts 1 and a substitution -2, is an overlap
if its share of matches suffices, else the longest stretch that has the share; what is left on both sides is judged in the
same way. Items of fewer words than an overlap have masks of their own and are compared as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stash, tidy, total_bytes, utf8

#: Fixed masks: 6 words each. The test suite tries all ways to substitute 2 of 13 words.
MASKS = ("11101011", "110100111")
#: An overlap counts from so many words (or the whole item, if that is shorter), of which this share must match.
MIN_WORDS, IDENTITY = 13, 0.8
#: Bytes of benchmark text in a block.
BLOCK = 8 << 20

_WORDS = bytes(c if c >= 0x80 or chr(c).isdigit() or chr(c).islower() else ord(chr(c).lower()) if chr(c).isupper() else 32 for c in range(256))
_PLACES = [np.array([i for i, c in enumerate(m) if c == "1"]) for m in MASKS]
_SALT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def words_of(text: bytes) -> list[bytes]:
    """A-Z lower-cased; words of digits, letters and characters outside ASCII."""
    return text.translate(_WORDS).split()


def masks_of(n: int) -> list[np.ndarray]:
    """Places in an item of n words, under 13: whichever words may be substituted, one of these leaves them all out."""
    gone = int(n * (1 - IDENTITY) + 1e-9)
    parts = np.array_split(np.arange(n), gone + 2)
    return [np.concatenate([p for k, p in enumerate(parts) if k not in out]) for out in combinations(range(len(parts)), gone)]


def _seeds(ids: np.ndarray, places: np.ndarray, salt: int) -> np.ndarray:
    n = len(ids) - int(places[-1])
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, np.uint64(salt + 1))
    for p, s in zip(places.tolist(), chain(_SALT, repeat(_SALT[0])), strict=False):
        h = (h ^ ids[p : p + n]) * s
        h ^= h >> np.uint64(29)
    return h


@dataclass
class Index:
    """Of one block of items: the words' ids, the items as ids, and a sorted table of seeds."""

    vocabulary: dict[bytes, int] = field(default_factory=dict)
    items: list[tuple[int, np.ndarray]] = field(default_factory=list)
    kinds: list[np.ndarray] = field(default_factory=list)  # the places of each mask
    seeds: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)  # of each mask: seeds, items, places
    bits: list[np.ndarray] = field(default_factory=list)

    @classmethod
    def build(cls, rows: list[tuple[int, str | None]]) -> Index:
        out = cls()
        for item, text in rows:
            words = words_of((text or "").encode())
            if words:
                out.items.append((item, np.fromiter((out.vocabulary.setdefault(w, len(out.vocabulary) + 1) for w in words), np.uint64, len(words))))
        lengths = [0] * len(_PLACES)  # of the items that a mask is for, 0 those of 13 words or more
        out.kinds = list(_PLACES)
        for n in sorted({len(x) for _, x in out.items if len(x) < MIN_WORDS}):
            out.kinds += masks_of(n)
            lengths += [n] * (len(out.kinds) - len(lengths))
        for k, (places, n) in enumerate(zip(out.kinds, lengths, strict=True)):
            own = [i for i, (_, x) in enumerate(out.items) if (len(x) == n if n else len(x) >= MIN_WORDS)]
            found = [_seeds(out.items[i][1], places, k)[: 1 if n else None] for i in own]
            h = np.concatenate(found) if found else np.zeros(0, np.uint64)
            which = np.repeat(np.array(own, np.int64), [len(x) for x in found])
            at = np.concatenate([np.arange(len(x)) for x in found]) if found else np.zeros(0, np.int64)
            order = np.argsort(h, kind="stable")
            out.seeds.append((h[order], which[order], at[order]))
            bits = np.zeros(1 << 20, bool)
            bits[(h >> np.uint64(44)).astype(np.int64)] = True
            out.bits.append(bits)
        return out


def stretch(same: np.ndarray) -> tuple[int, int]:
    """Start and end of the stretch with the largest sum of 1 for a match and -2 for a substitution."""
    total = np.concatenate([[0], np.cumsum(np.where(same, 1, -2))])
    low = np.minimum.accumulate(total)
    end = int(np.argmax(total - low))
    start = int(np.argmax(total[: end + 1] == low[end]))
    return start, end


def longest(same: np.ndarray) -> tuple[int, int]:
    """Start and end of the longest stretch that begins and ends with a match and has the share of matches."""
    at = np.flatnonzero(same)
    if not len(at):
        return 0, 0
    total = np.concatenate([[0], np.cumsum(np.where(same, 1, -4))])  # IDENTITY: four matches for each substitution
    most = np.maximum.accumulate(total[at + 1][::-1])[::-1]
    last = at[np.searchsorted(-most, -total[at], "right") - 1] + 1
    k = int(np.argmax(last - at))
    return int(at[k]), int(last[k])


def stretches(same: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Starts and ends of stretches of so many words or more that have the share of matches."""
    out, todo = [], [(0, len(same))]
    while todo:
        a, b = todo.pop()
        if b - a < least:
            continue
        x, y = stretch(same[a:b])
        if y - x < least or same[a + x : a + y].mean() < IDENTITY:
            x, y = longest(same[a:b])
        if y - x >= least:
            out.append((a + x, a + y))
            todo += [(a, a + x), (a + y, b)]
    return sorted(out)


def find(index: Index, texts: list[bytes]) -> list[tuple[int, int, int, int, int, float]]:
    """(text, item, first word in the text, first word in the item, words, share of matches) of each overlap."""
    gap = 16
    words = [words_of(t) for t in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    start = np.cumsum(counts + gap) - counts - gap
    ids = np.zeros(int((counts + gap).sum()), np.uint64)  # 0: a word that no item has, and between texts
    inside = np.ones(len(ids), bool)
    for a, n in zip(start.tolist(), counts.tolist(), strict=True):
        inside[a + n : a + n + gap] = False
    ids[inside] = np.fromiter(map(index.vocabulary.get, chain.from_iterable(words), repeat(0)), np.uint64, int(counts.sum()))
    tried: set[tuple[int, int, int]] = set()
    out = []
    for k, places in enumerate(index.kinds):
        table, which, at = index.seeds[k]
        if not len(table):
            continue
        h = _seeds(ids, places, k)
        maybe = np.flatnonzero(index.bits[k][(h >> np.uint64(44)).astype(np.int64)])
        low, high = np.searchsorted(table, h[maybe], "left"), np.searchsorted(table, h[maybe], "right")
        hit = high > low
        rows = np.repeat(maybe[hit], (high - low)[hit])
        entry = np.concatenate([np.arange(a, b) for a, b in zip(low[hit], high[hit], strict=True)]) if len(rows) else np.zeros(0, np.int64)
        text = np.searchsorted(start, rows, "right") - 1
        diagonal = rows - at[entry]
        for t, i, d in dict.fromkeys(zip(text.tolist(), which[entry].tolist(), diagonal.tolist(), strict=True)):
            if (t, i, d) in tried:
                continue
            tried.add((t, i, d))
            item = index.items[i][1]
            a, b = max(d, int(start[t])), min(d + len(item), int(start[t] + counts[t]))
            same = ids[a:b] == item[a - d : b - d]
            parts = stretches(same, min(MIN_WORDS, len(item)))
            if not parts and len(same) == len(item) <= MIN_WORDS and same.mean() >= IDENTITY:
                parts = [(0, len(item))]  # the first or last word is substituted
            out += [(t, index.items[i][0], a + x - int(start[t]), a + x - d, y - x, float(same[x:y].mean())) for x, y in parts]
    return out


@tidy
def overlaps(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", block: int = BLOCK) -> DataFrame:
    """``key, item_id, first_word, item_word, n_words, identity`` of each overlap of a document and an item.

    Null texts and items count as empty, and those without words overlap with nothing. An item of fewer than 5 words must
    stand in the text as it is, since no other share of its words reaches 0.8. Repeated items
    or documents give repeated rows. Null keys and item ids are kept. Without documents or items there are no rows.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item).cast("long").alias("i"), F.col(item_text).alias("t"))
    blocks = max(1, -(-total_bytes(items, "t") // block))
    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, item_id long, first_word long, item_word long, n_words long, identity double"
    rows, out = docs.select(F.col(key).alias("key"), F.col(text).alias("t")), None
    for k in range(blocks):
        index = Index.build([tuple(r) for r in items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k).collect()])  # a block: bounded bytes
        part = rows.mapInArrow(_finder(spark.sparkContext.broadcast(index)), schema)
        out = part if out is None else out.unionByName(part)
    return out


def _finder(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, 4 << 20):
                a, b, body = utf8(part.column(1))
                found = find(shared.value, [body[i:j] for i, j in zip(a.tolist(), b.tolist(), strict=True)])
                if found:
                    t, *rest = zip(*found, strict=True)
                    types = [pa.int64()] * 4 + [pa.float64()]
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(t, pa.int64()))] + [pa.array(c, x) for c, x in zip(rest, types, strict=True)], names=["key", "item_id", "first_word", "item_word", "n_words", "identity"])

    return run


@tidy
def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``key, item_ids, n_overlaps, item_id, n_words, identity``: one row per document that overlaps with an item, with the longest overlap."""
    found = stash(overlaps(docs, benchmark, key, text, **options), "overlaps")
    best = F.max(F.struct("n_words", "identity", (-F.col("item_id")).alias("i"))).alias("b")
    rows = found.groupBy("key").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.count("*").alias("n_overlaps"), best)
    return rows.select(F.col("key").alias(key), "item_ids", "n_overlaps", (-F.col("b.i")).alias("item_id"), F.col("b.n_words").alias("n_words"), F.col("b.identity").alias("identity"))
