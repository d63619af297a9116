"""Exact substring dedup: every byte that a 400-byte string covers which also starts anywhere else.

The suffixes that are sorted are sampled, in step with the text: each 400-byte window has an anchor, the 32-byte string
in it with the smallest hash, and equal windows have the same anchor at the same place. The windows that share an anchor
in a text make one stretch, of 400 to 768 bytes. So:

1. Stretches are counted by the hash of their anchor; those whose anchor is nowhere else are done. This leaves the
   repeated part of the corpus, as a few numbers a stretch.
2. Stretches that are equal as a whole are repeated as a whole.
3. The rest are compared by their suffixes, from the anchor on. Each task sorts its suffixes into runs, front-codes them
   (length of the prefix shared with the one before, then the rest), and the runs are exchanged by the anchor's hash. A
   loser tree merges them: it keeps for every suffix the length of the prefix it shares with the last winner, and never
   compares known prefixes again. The merged order gives the shared prefix of neighbours. A window that reaches o bytes
   to the left of its anchor is repeated if another one stands in the same run of neighbours that share 400 - o bytes,
   and has the same hash of the o bytes to the left.

Only rows that may hold repeats are shuffled with their texts, to fetch stretches and to cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import key_bitmap, may_hold, slices, stash, tidy, utf8

#: Bytes of the strings, and of the anchors in them.
LENGTH, ANCHOR = 400, 32
#: Bytes of suffixes that a task sorts at once.
RUN_BYTES = 32 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(1)
def _values() -> np.ndarray:
    return np.random.default_rng(400).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[:1] = 1
    return np.multiply.accumulate(out)


def stretches(body: bytes, starts: np.ndarray, ends: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Of all texts in body: (text, first window, windows, place of the anchor in the first window, anchor's hash, hash of the stretch)."""
    none = tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64), np.zeros(0, np.uint64))
    n = len(body)
    if n < length or not (ends - starts >= length).any():
        return none
    value = _values()[np.frombuffer(body, np.uint8)]
    power, inverse = _powers(_BASE, n + 1), _powers(_INVERSE, n + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value * power[:n], dtype=np.uint64)])

    def hashed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return _mix((total[b] - total[a]) * inverse[a])

    at = np.arange(n - anchor + 1)
    grams = _mix((total[anchor:] - total[: n - anchor + 1]) * inverse[: n - anchor + 1])
    w = length - anchor + 1
    m = len(grams)
    padded = np.full(-(-m // w) * w, np.uint64(2**64 - 1))
    padded[:m] = (grams & ~np.uint64(2**32 - 1)) | at.astype(np.uint64)
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(behind[: m - w + 1], ahead[w - 1 : m])
    place = (least & np.uint64(2**32 - 1)).astype(np.int64)  # of the anchor of each window
    inside = np.zeros(len(place) + 1, np.int32)
    ok = ends - starts >= length
    np.add.at(inside, starts[ok], 1)
    np.add.at(inside, np.minimum(ends[ok] - length + 1, len(place)), -1)
    window = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    p = place[window]
    fresh = np.concatenate([[True], (p[1:] != p[:-1]) | (window[1:] != window[:-1] + 1)])
    first = np.flatnonzero(fresh)
    s, count, p = window[first], np.diff(np.append(first, len(window))), p[first]
    text = np.searchsorted(starts, s, "right") - 1
    whole = hashed(s, s + count - 1 + length) ^ _mix((p - s).astype(np.uint64) * np.uint64(1024) + count.astype(np.uint64))
    return text, s - starts[text], count, p - s, grams[p], whole


def _scan(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2, 2 << 20):
                a, b, body = utf8(part.column(2))
                text, s, n, off, ah, ch = stretches(body, a, b, length)
                rows = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(rows), part.column(1).take(rows), pa.array(s.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(off.astype(np.int32)), pa.array(ah.view(np.int64)), pa.array(ch.view(np.int64))],
                    names=["key", "th", "s", "n", "off", "ah", "ch"],
                )

    return run


# ------------------------------------------------------------------ runs of suffixes


def shared(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which the first ``known`` bytes need no look."""
    n = min(len(a), len(b))
    while known + 32 <= n and a[known : known + 32] == b[known : known + 32]:
        known += 32
    while known < n and a[known] == b[known]:
        known += 1
    return known


def front_code(sorted_: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Of each suffix: the length it shares with the one before, its whole length; and what it doesn't share."""
    lcp, rest, last = np.zeros(len(sorted_), np.int32), [], b""
    for i, x in enumerate(sorted_):
        lcp[i] = shared(last, x, 0)
        rest.append(x[lcp[i] :])
        last = x
    return lcp, np.fromiter(map(len, sorted_), np.int32, len(sorted_)), b"".join(rest)


class Run:
    """Decodes a front-coded run, one suffix at a time."""

    def __init__(self, number: int, lcp: np.ndarray, size: np.ndarray, rest: bytes):
        self.number, self.lcp, self.size, self.rest = number, lcp.tolist(), size.tolist(), rest
        self.i, self.at, self.now = -1, 0, b""
        self.known = 0  # what it shares with the last winner

    def step(self) -> bool:
        self.i += 1
        if self.i >= len(self.lcp):
            return False
        self.known = self.lcp[self.i]
        n = self.size[self.i] - self.known
        self.now = self.now[: self.known] + self.rest[self.at : self.at + n]
        self.at += n
        return True


def merge(runs: list[Run]) -> Iterator[tuple[int, int, int]]:
    """(run, place in the run, length shared with the one before) of all suffixes in order, by a loser tree."""
    k = 1
    while k < len(runs):
        k *= 2
    players: list[Run | None] = [r if r.step() else None for r in runs] + [None] * (k - len(runs))

    def play(a: Run | None, b: Run | None) -> tuple[Run | None, Run | None]:
        """Winner and loser. The one that shares more with the last winner is smaller; only equals are compared, and
        only beyond what both share with it. The loser then knows what it shares with the winner."""
        if a is None or b is None:
            return (a, b) if b is None else (b, a)
        if a.known != b.known:
            return (a, b) if a.known > b.known else (b, a)
        n = shared(a.now, b.now, a.known)
        if a.now[n : n + 1] <= b.now[n : n + 1]:
            b.known = n
            return a, b
        a.known = n
        return b, a

    losers: list[Run | None] = [None] * k

    def first(node: int) -> Run | None:
        if node >= k:
            return players[node - k]
        winner, losers[node] = play(first(2 * node), first(2 * node + 1))
        return winner

    leaf = {id(r): i for i, r in enumerate(players) if r is not None}
    for r in players:
        if r is not None:
            r.known = 0
    winner = first(1)
    while winner is not None:
        yield winner.number, winner.i, winner.known
        node = (leaf[id(winner)] + k) // 2
        up: Run | None = winner if winner.step() else None
        while node:
            up, losers[node] = play(up, losers[node])
            node //= 2
        winner = up


def _runs(parts: int, length: int):
    """Rows (key, th, text, wanted stretches) to front-coded runs, a row for each part of the exchange."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list] = {}
        held = 0
        for batch in batches:
            a, b, body = utf8(batch.column(2))
            for i, (key, th, wanted) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                for x in wanted:
                    lo = int(a[i]) + x["s"]
                    mid, hi = lo + x["off"], min(lo + x["n"] - 1 + length, int(b[i]))
                    kept.setdefault(x["ah"] % parts, []).append((body[mid : min(hi, mid + length)], body[lo:mid][::-1], (key or 0, key is None, th, x["s"], x["n"], x["off"], x["copies"])))
                    held += hi - lo
                if held > RUN_BYTES:
                    yield from _coded(kept)
                    kept, held = {}, 0
        yield from _coded(kept)

    return run


def _coded(kept: dict[int, list]) -> Iterator[pa.RecordBatch]:
    for p, rows in kept.items():
        rows.sort(key=lambda r: r[0])
        lcp, size, rest = front_code([r[0] for r in rows])
        meta = np.array([r[2] for r in rows], np.int64)
        left = b"".join(r[1] for r in rows)
        yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64())] + [pa.array([x], pa.binary()) for x in (lcp.tobytes(), size.tobytes(), rest, left, meta.tobytes())], names=["p", "lcp", "size", "rest", "lft", "meta"])


def repeated(lcp: np.ndarray, left: list[bytes], meta: np.ndarray, length: int = LENGTH) -> list[tuple[int, int, int]]:
    """(row, first byte, byte after the last) of the repeated runs of windows in suffixes that are in order."""
    m = len(lcp)
    n, off = meta[:, 4], meta[:, 5]
    widest = int(off.max()) + 1
    block = np.zeros((m, max(widest - 1, 1)), np.uint8)
    for i, x in enumerate(left):
        block[i, : len(x)] = np.frombuffer(x, np.uint8)
    value, h = _values(), np.zeros(m, np.uint64)
    hit = np.zeros((m, widest), bool)
    for o in range(widest):
        if o:
            h = h * np.uint64(_BASE) + value[block[:, o - 1]]
        rows = np.flatnonzero((off >= o) & (o > off - n))
        if len(rows) < 2:
            continue
        group = np.cumsum(lcp < length - o)[rows].astype(np.uint64)
        code = _mix(_mix(h[rows]) + group * np.uint64(0xD6E8FEB86659FD93))
        order = np.argsort(code)
        same = code[order][1:] == code[order][:-1]
        hit[rows[order[1:][same]], o] = True
        hit[rows[order[:-1][same]], o] = True
    out = []
    for i in np.flatnonzero(hit.any(axis=1) & (meta[:, 6] == 1)).tolist():
        s = np.sort(meta[i, 3] + off[i] - np.flatnonzero(hit[i]))
        cut = np.flatnonzero(np.diff(s) > length)
        for a, b in zip(s[np.append(0, cut + 1)].tolist(), s[np.append(cut, len(s) - 1)].tolist(), strict=True):
            out.append((i, a, b + length))
    return out


def _merge_parts(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows arrive sorted by part."""
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and row[0] != held[0][0]:
                    yield from _merged(held, length)
                    held = []
                held.append(row)
        if held:
            yield from _merged(held, length)

    return run


def _merged(rows: list[tuple], length: int) -> Iterator[pa.RecordBatch]:
    runs, metas, lefts = [], [], []
    for i, (_, lcp, size, rest, left, meta) in enumerate(rows):
        runs.append(Run(i, np.frombuffer(lcp, np.int32), np.frombuffer(size, np.int32), rest))
        metas.append(np.frombuffer(meta, np.int64).reshape(-1, 7))
        ends = np.cumsum(metas[-1][:, 5])
        lefts.append([left[a:b] for a, b in zip((ends - metas[-1][:, 5]).tolist(), ends.tolist(), strict=True)])
    order = list(merge(runs))
    lcp = np.array([x[2] for x in order])
    meta = np.array([metas[r][i] for r, i, _ in order])
    found = repeated(lcp, [lefts[r][i] for r, i, _ in order], meta, length)
    if found:
        at, a, b = (np.array(x) for x in zip(*found, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(meta[at, 0], pa.int64(), mask=meta[at, 1] == 1), pa.array(meta[at, 2]), pa.array(a), pa.array(b)], names=["key", "th", "a", "b"])


# ------------------------------------------------------------------ the operator


@tidy
def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``key, th, a, b``: spans of bytes, together covering each byte of a string of ``length`` bytes that starts more than once.

    Spans may overlap. th is xxhash64(text). Matches never cross documents. Null and short texts have none.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.xxhash64(text), F.lit(0)).alias("th"), F.col(text).alias("t"))
    found = stash(rows.mapInArrow(_scan(length), "key long, th long, s int, n int, off int, ah long, ch long"), "stretches")
    several = stash(found.groupBy("ah").count().where("count > 1").select("ah"), "anchors")
    found = stash(found.where(may_hold(key_bitmap(several, "ah"), "ah")).join(several, "ah", "left_semi"), "repeated-anchors")
    firsts = [F.first(c).alias(c) for c in ("key", "th", "s", "n", "off")]
    classes = stash(found.groupBy("ah", "ch").agg(F.count("*").alias("copies"), *firsts), "classes")
    copied = stash(classes.where("copies > 1").select("ah", "ch"), "copied")
    whole = found.where(may_hold(key_bitmap(copied, "ah", "ch"), "ah", "ch")).join(copied, ["ah", "ch"], "left_semi").select("key", "th", F.col("s").cast("long").alias("a"), (F.col("s") + F.col("n") - 1 + length).cast("long").alias("b"))
    open_ = stash(classes.groupBy("ah").agg(F.count("*").alias("c"), F.min("copies").alias("m")).where("c > 1 and m = 1").select("ah"), "open-anchors")
    wanted = classes.join(open_, "ah").select("key", "th", F.struct("s", "n", "off", "ah", "copies").alias("x"))
    wanted = stash(wanted.groupBy("key", "th").agg(F.collect_list("x").alias("wanted")), "wanted")  # of one text
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    here = rows.where(may_hold(key_bitmap(wanted, "key", "th"), "key", "th")).alias("r").join(wanted.alias("w"), F.col("r.key").eqNullSafe(F.col("w.key")) & (F.col("r.th") == F.col("w.th")))
    runs = here.select("r.key", "r.th", "t", "wanted").mapInArrow(_runs(parts, length), "p long, lcp binary, size binary, rest binary, lft binary, meta binary")
    partial = runs.repartition("p").sortWithinPartitions("p").mapInArrow(_merge_parts(length), "key long, th long, a long, b long")
    return stash(whole.unionByName(partial).distinct(), "repeats")


@tidy
def suffix_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``key, text, removed``: each row with its whole text and the maximal spans of bytes to remove, in order.

    Null texts count as empty and have no spans. Equal rows count as different places, so all their strings go.
    """
    spans = stash(repeats(docs, key, text, length).groupBy("key", "th").agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("removed")), "spans")  # of one text
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.xxhash64(text), F.lit(0)).alias("th"), F.col(text).alias("text"))
    maybe = may_hold(key_bitmap(spans, "key", "th"), "key", "th")
    met = rows.where(maybe).alias("r").join(spans.alias("s"), F.col("r.key").eqNullSafe(F.col("s.key")) & (F.col("r.th") == F.col("s.th")), "left")
    return met.select("r.key", "text", "removed").unionByName(rows.where(~maybe).select("key", "text", F.lit(None).cast(spans.schema["removed"].dataType).alias("removed")))


def union(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal spans of sorted ones."""
    out: list[tuple[int, int]] = []
    for x in spans or ():
        if out and x["a"] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], x["b"]))
        else:
            out.append((x["a"], x["b"]))
    return out


def digest(found: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of what suffix_dedup returns."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, body = utf8(batch.column(1))
            rows = []
            for i, j, spans in zip(a.tolist(), b.tolist(), batch.column(2).to_pylist(), strict=True):
                cuts, sha, at, gone = union(spans), hashlib.sha256(), i, 0
                for x, y in cuts:
                    sha.update(body[at : i + x])
                    at, gone = i + y, gone + y - x
                sha.update(body[at:j])
                rows.append((j - i, gone, len(cuts), sha.hexdigest()))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0)] + [pa.array(list(c), t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.string()], strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return found.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
