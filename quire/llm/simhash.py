"""SimHash near-duplicates, found by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits, and each is decoded with the perfect binary Golay
code of length 23: every 23-bit word is within 3 bits of exactly one codeword. The keys of a segment are the codewords of
the segment itself and of the segment with any one of its bits flipped, 5 on average. Two segments that differ in at most
2 bits share a key, since the word halfway between them decodes to one codeword from both sides.

Four differing bits leave, by pigeonhole, one of two cases:

* a segment without errors, and another with at most 2. Key: that segment as it is, and a codeword of the other; or
* errors in all three: one segment with at most 2 errors, two with exactly 1. Key: a codeword of the first, and an
  error-free half of each of the others.

That makes about 90 keys of 33 bits a fingerprint. Fingerprints that share a key are compared; no pair is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stash, tidy, utf8
from .components import components

#: Widths of the segments, and the start of each from the lowest bit.
WIDTHS, STARTS = (22, 21, 21), (0, 22, 43)
#: Generator polynomial of the Golay code: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
RADIUS = 4


# ------------------------------------------------------------------ fingerprints


def shingle_hashes(words: list[bytes], k: int) -> np.ndarray:
    """XXH64 (seed 42) of the k-word shingles, repeats included; of fewer words the whole sequence is the only one."""
    from xxhash import xxh64_intdigest

    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < k:
        return np.array([xxh64_intdigest(b" ".join(words), 42)], np.uint64)
    text = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    first, last = np.concatenate([[0], ends[: len(words) - k]]).tolist(), (ends[k - 1 :] - 1).tolist()
    return np.fromiter([xxh64_intdigest(text[a:b], 42) for a, b in zip(first, last, strict=True)], np.uint64, len(first))


def fingerprint_of(h: np.ndarray) -> int:
    """Bit b is 1 if it is set in over half of the hashes; without hashes all bits are 0."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 65536):
        bits = np.unpackbits(h[at : at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprint(words: list[bytes], k: int) -> int:
    """The fingerprint of the k-word shingles, repeats included."""
    return fingerprint_of(shingle_hashes(words, k))


def _fingerprints(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                a, b, body = utf8(part.column(1))
                out = np.fromiter((fingerprint(body[i:j].lower().split(), k) for i, j in zip(a.tolist(), b.tolist(), strict=True)), np.uint64, len(a))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(out.view(np.int64), pa.int64())], names=["key", "th", "fp"])

    return run


# ------------------------------------------------------------------ keys


@lru_cache(1)
def golay() -> np.ndarray:
    """For each 23-bit word the index (0 to 4095) of the codeword within 3 bits."""
    code = np.zeros(4096, np.uint32)
    for i in range(4096):
        word = 0
        for b in range(12):
            if i >> b & 1:
                word ^= GENERATOR << b
        code[i] = word
    out = np.zeros(1 << 23, np.uint16)
    one = np.uint32(1) << np.arange(23, dtype=np.uint32)
    errors = [np.uint32(0)]
    for a in range(23):
        errors.append(one[a])
        for b in range(a):
            errors.append(one[a] | one[b])
            errors += [one[a] | one[b] | one[c] for c in range(b)]
    index = np.arange(4096, dtype=np.uint16)
    for e in errors:
        out[code ^ e] = index
    return out


def _near(segment: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys of each segment: (row, codeword), without repeats."""
    flips = np.concatenate([[0], 1 << np.arange(width)]).astype(np.uint32)
    found = np.sort(golay()[segment[:, None].astype(np.uint32) ^ flips], axis=1)
    fresh = np.ones(found.shape, bool)
    fresh[:, 1:] = found[:, 1:] != found[:, :-1]
    rows, at = np.nonzero(fresh)
    return rows, found[rows, at].astype(np.uint64)


def keys_of(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every key of each fingerprint: bits 0 to 11 a codeword, then 21 or 22 exact bits, then the kind."""
    fp = fp.view(np.uint64)
    seg = [(fp >> np.uint64(s)) & np.uint64((1 << w) - 1) for s, w in zip(STARTS, WIDTHS, strict=True)]
    near = [_near(x, w) for x, w in zip(seg, WIDTHS, strict=True)]
    rows, keys, kind = [], [], 0
    for i in range(3):  # the segment with a codeword
        r, code = near[i]
        others = [j for j in range(3) if j != i]
        exact = [seg[j] for j in others]
        b, c = others
        halves = [[(seg[j] & np.uint64(0x3FF)), seg[j] >> np.uint64(10)] for j in (b, c)]
        exact += [(x << np.uint64(12)) | y for x in halves[0] for y in halves[1]]
        for x in exact:
            rows.append(r)
            keys.append(np.uint64(kind << 40) | (x[r] << np.uint64(12)) | code)
            kind += 1
    return np.concatenate(rows), np.concatenate(keys).view(np.int64)


def _emit_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 10_000):
            fp = batch.column(0).slice(at, 10_000).to_numpy()
            rows, keys = keys_of(np.ascontiguousarray(fp))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fp[rows])], names=["k", "fp"])


# ------------------------------------------------------------------ links


def forest(fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what links of up to ``radius`` bits connect among distinct fingerprints: at most one link for
    each. Breadth first: each fingerprint takes all those in reach that are still free, so a dense group goes in a few
    steps, and no list of all its pairs is ever made."""
    free, a, b, queue = fp.view(np.uint64), [], [], []
    while len(free) or queue:
        if not queue:
            queue.append(free[0])
            free = free[1:]
        x = queue.pop()
        if not len(free):
            break
        hit = np.bitwise_count(free ^ x) <= radius
        if hit.any():
            new = free[hit]
            free = free[~hit]
            a.append(np.full(len(new), x, np.uint64))
            b.append(new)
            queue.extend(new)
    if not a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)


def _links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows arrive sorted by key; a group may go over the end of a batch."""
        left = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        for batch in chain_end(batches):
            if batch is None:
                k, fp, whole = *left, True
            else:
                k, fp, whole = np.concatenate([left[0], batch.column(0).to_numpy()]), np.concatenate([left[1], batch.column(1).to_numpy()]), False
            if not len(k):
                continue
            stop = len(k) if whole else int(np.searchsorted(k, k[-1]))
            left = (k[stop:], fp[stop:])
            k, fp = k[:stop], fp[:stop]
            if not len(k):
                continue
            starts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            sizes = np.diff(np.append(starts, len(k)))
            two = starts[sizes == 2]
            x, y = fp[two].view(np.uint64), fp[two + 1].view(np.uint64)
            good = np.bitwise_count(x ^ y) <= radius
            us, vs = [x[good].view(np.int64)], [y[good].view(np.int64)]
            for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
                u, v = forest(fp[s : s + n], radius)
                us.append(u)
                vs.append(v)
            u, v = np.concatenate(us), np.concatenate(vs)
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v))], names=["u", "v"])

    return run


def chain_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 4) -> DataFrame:
    """``key, th, fp`` of each row: th is xxhash64(text), fp the fingerprint as a signed number. A-Z are lower-cased; words are what ``[\\x20\\x09-\\x0D]`` separates."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("th"))
    return rows.mapInArrow(_fingerprints(k), "key long, th long, fp long")


@tidy
def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 4, radius: int = RADIUS) -> DataFrame:
    """``key, th, fp, component_id, kept`` of each row: the component is the smallest key that can be reached over links of up
    to ``radius`` bits (at most 4); the row with that key is kept, of several the one with the smallest th (xxhash64(text)).

    Null text counts as empty; rows without words have fingerprint zero and are linked like any other. Null keys are never
    the smallest, unless a component has no other. Repeated rows give repeated rows. An empty table gives no rows. Equal
    fingerprints are one vertex, with sums made before the shuffle, so thousands of copies cost no more than one.
    """
    if not 0 <= radius <= RADIUS:
        raise ValueError("radius must be 0 to 4")
    rows = stash(fingerprints(docs, key, text, k), "simhash")
    distinct = stash(rows.groupBy("fp").agg(F.min(F.struct(F.col("key").isNull().alias("z"), "key", "th")).alias("least")), "simhash-distinct")
    keys = distinct.select("fp").mapInArrow(_emit_keys, "k long, fp long").repartition("k").sortWithinPartitions("k", "fp")
    links = keys.mapInArrow(_links(radius), "u long, v long").distinct()
    roots = stash(components(links, "simhash-components").withColumnRenamed("v", "fp"), "simhash-roots")
    members = stash(roots.join(distinct, "fp"), "simhash-members")
    least = stash(members.groupBy("root").agg(F.min("least").alias("low")), "simhash-least")
    found = members.join(least, "root").select("fp", "low")
    classes = stash(distinct.join(found, "fp", "left").select("fp", F.coalesce("low", "least").alias("c")), "simhash-classes")
    kept = F.col("key").eqNullSafe(F.col("c.key")) & F.col("th").eqNullSafe(F.col("c.th"))
    return rows.join(classes, "fp").select("key", "th", "fp", F.col("c.key").alias("component_id"), kept.alias("kept"))
