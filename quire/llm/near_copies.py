"""Near copies by five-word shingles: SimHash first, bands of minima where SimHash can't reach, exact verification.

Texts with a similarity (Jaccard, of their sets of shingles) of 0.8 differ in about 10 of 64 SimHash bits, more than
Golay-code keys can bridge. So links come from two sources: SimHash fingerprints within 4 bits, and buckets of texts
that share a band of 5 minima of the same hashes, of 16 bands (a pair at 0.8 shares one with a probability of 0.998).
In a bucket texts are compared by sketches of 256 bytes, breadth first, in three orders, as many links as texts at most in each. A link counts
if the sets of 32-bit shingle hashes agree to 0.8 exactly. Very large buckets are dealt to blocks, whose heads are then compared with each other.
That settles most; then all pairs of a bucket that are alike by their sketches and not connected yet are tested exactly,
those of different blocks too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import key_bitmap, may_hold, slices, stash, tidy, utf8
from .components import components
from .simhash import RADIUS, _emit_keys, _links, chain_end, fingerprint_of, shingle_hashes

#: Words of a shingle, and the similarity (as a fraction) from which texts are near copies.
WORDS, LEAST = 5, (4, 5)
BANDS, DEPTH, SKETCH = 16, 5, 256
#: What a sketch must show at least for a link to be verified: below LEAST, since sketches are inexact.
HINT = 0.72
#: Orders in which the texts of a bucket of over two are compared: in each a text is tested with the first that it is like,
#: and may fail there though another in the bucket would do.
TURNS = 3
#: Texts of a bucket that are compared by one task.
BLOCK = 2048


def minima(shingles: np.ndarray) -> np.ndarray:
    """One key for each band, of distinct shingle hashes."""
    factors = np.random.default_rng(5).integers(0, 2**63, BANDS * DEPTH, np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.full(len(factors), 2**64 - 1, np.uint64)
    for at in range(0, len(shingles), 4096):
        np.minimum(least, (shingles[at : at + 4096, None] * factors).min(axis=0), out=least)
    key = np.arange(BANDS, dtype=np.uint64)
    for column in least.reshape(BANDS, DEPTH).T:
        key = (key ^ column) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(31)
    return key


def sketch(shingles: np.ndarray) -> bytes:
    """A byte for each of 256 bins of the distinct shingle hashes: 0 of an empty one, else a digest of its smallest hash."""
    least = np.full(SKETCH, 2**64 - 1, np.uint64)
    bins = (shingles % np.uint64(SKETCH)).astype(np.int64)
    np.minimum.at(least, bins, shingles >> np.uint64(8))
    out = np.zeros(SKETCH, np.uint8)
    out[bins] = 1 + least[bins] % np.uint64(255)
    return out.tobytes()


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 1):
            a, b, body = utf8(part.column(1))
            fps, bands, sketches = [], [], []
            for i, j in zip(a.tolist(), b.tolist(), strict=True):
                h = shingle_hashes(body[i:j].lower().split(), WORDS)
                fps.append(fingerprint_of(h))
                h = np.unique(h)
                bands.append(minima(h).view(np.int64).tolist() if len(h) else None)
                sketches.append(sketch(h) if len(h) else None)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(np.array(fps, np.uint64).view(np.int64), pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.binary())], names=["key", "th", "fp", "bands", "sketch"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 1):
            a, b, body = utf8(part.column(1))
            found = [np.unique(shingle_hashes(body[i:j].lower().split(), WORDS).astype(np.uint32)).tobytes() for i, j in zip(a.tolist(), b.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.binary())], names=["th", "shingles"])


def forest(th: np.ndarray, sketches: np.ndarray) -> tuple[list[int], list[tuple[int, int]]]:
    """Heads, and links that connect all the others with them: each text takes those like it that are still free."""
    free, heads, links, queue = np.arange(len(th)), [], [], []
    while len(free) or queue:
        if not queue:
            queue.append(int(free[0]))
            heads.append(queue[0])
            free = free[1:]
        x = queue.pop()
        if not len(free):
            break
        other = sketches[free]
        same = ((other == sketches[x]) & (other != 0)).sum(axis=1)
        hit = same >= HINT * np.maximum(((other | sketches[x]) != 0).sum(axis=1), 1)
        new = free[hit].tolist()
        free = free[~hit]
        links += [(int(th[x]), int(th[y])) for y in new if th[x] != th[y]]
        queue += new
    return heads, links


def forests(th: np.ndarray, sketches: np.ndarray) -> tuple[list[int], list[tuple[int, int]]]:
    """Heads and links of the forests in all orders, the given one first."""
    heads, links = set(), set()
    for turn in range(TURNS if len(th) > 2 else 1):
        at = np.random.default_rng(turn).permutation(len(th)) if turn else np.arange(len(th))
        some, more = forest(th[at], sketches[at])
        heads.update(at[some].tolist())
        links.update((min(x), max(x)) for x in more)
    return sorted(heads), sorted(links)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (k, deal, many, th, sketch), sorted by the first two, to links (u, v), and to the heads of dealt buckets (k, u, sketch)."""
    held: list[pa.RecordBatch] = []
    for batch in chain_end(batches):
        held += [batch] if batch is not None else []
        if not held or (batch is not None and sum(b.num_rows for b in held) < 20_000):
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        if not len(rows):
            continue
        k, deal, many, th = (rows.column(c).to_numpy() for c in range(4))
        _, _, body = utf8(rows.column(4))
        sketches = np.frombuffer(body, np.uint8).reshape(-1, SKETCH)
        starts = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (deal[1:] != deal[:-1])])).tolist() + [len(k)]
        stop = len(starts) - 1 if batch is None else len(starts) - 2
        us, vs, hk, hu, hs = [], [], [], [], []
        for a, b in zip(starts[:stop], starts[1 : stop + 1], strict=True):
            heads, links = forests(th[a:b], sketches[a:b]) if b - a > 1 else ([0], [])
            us += [x for x, _ in links]
            vs += [y for _, y in links]
            if many[a]:
                hk += [int(k[a])] * len(heads)
                hu += [int(th[a + x]) for x in heads]
                hs += [sketches[a + x].tobytes() for x in heads]
        yield pa.RecordBatch.from_arrays([pa.array([None] * len(us) + hk, pa.int64()), pa.array(us + hu, pa.int64()), pa.array(vs + [None] * len(hu), pa.int64()), pa.array([None] * len(us) + hs, pa.binary())], names=["k", "u", "v", "sketch"])
        held = [] if batch is None else rows.slice(starts[stop]).to_batches()


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (k, deal), of batches sorted by these first two columns."""
    held: list[pa.RecordBatch] = []
    for batch in chain_end(batches):
        held += [batch] if batch is not None else []
        if not held or (batch is not None and sum(b.num_rows for b in held) < 20_000 and sum(b.nbytes for b in held) < 16 << 20):
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        if not len(rows):
            continue
        k, deal = (rows.column(c).to_numpy() for c in range(2))
        starts = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (deal[1:] != deal[:-1])])).tolist() + [len(k)]
        stop = len(starts) - 1 if batch is None else len(starts) - 2
        for a, b in zip(starts[:stop], starts[1 : stop + 1], strict=True):
            yield rows.slice(a, b - a)
        held = [] if batch is None else rows.slice(starts[stop]).to_batches()


def by_root(root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of texts, those of one root together and the most frequent root last; and where in it the texts of other roots begin after each."""
    _, which, n = np.unique(root, return_inverse=True, return_counts=True)
    order = np.lexsort((which, n[which]))
    ends = np.flatnonzero(np.diff(which[order], append=-1)) + 1
    return order, ends[np.searchsorted(ends, np.arange(len(root)), "right")]


def unsettled(root: np.ndarray, sketches: np.ndarray) -> np.ndarray:
    """Whether each text is like one of another root by its sketch."""
    order, after = by_root(root)
    s, out = sketches[order], np.zeros(len(root), bool)
    for i, a in enumerate(after.tolist()):
        if a == len(root):
            break
        same = ((s[a:] == s[i]) & (s[a:] != 0)).sum(axis=1)
        hit = same >= HINT * np.maximum(((s[a:] | s[i]) != 0).sum(axis=1), 1)
        if hit.any():
            out[order[i]] = True
            out[order[a:][hit]] = True
    return out


def _unsettled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (k, deal, th, root, sketch), sorted by the first two, to those that are unsettled, without the sketch."""
    for rows in _groups(batches):
        if len(rows) > 1:
            mine = unsettled(rows.column(3).to_numpy(), np.frombuffer(utf8(rows.column(4))[2], np.uint8).reshape(-1, SKETCH))
            if mine.any():
                yield from rows.select([0, 1, 2, 3]).filter(pa.array(mine)).to_batches()


def settle(root: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links between roots, by an exact test of all pairs of sets whose roots aren't connected yet."""
    order, after = by_root(root)
    sizes = np.array([len(sets[i]) for i in order], np.int64)
    starts = np.cumsum(sizes) - sizes
    words, ids = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
    ids, mark = ids.astype(np.int32), np.zeros(len(words), np.uint8)
    first, label, links = root[order], root[order].copy(), []
    for i, a in enumerate(after.tolist()):
        if a == len(root):
            break
        n = sizes[a:]
        fit = (label[a:] != label[i]) & (LEAST[1] * np.minimum(n, sizes[i]) >= LEAST[0] * np.maximum(n, sizes[i]))
        if not fit.any():
            continue
        own = ids[starts[i] : starts[i] + sizes[i]]
        mark[own] = 1
        both = np.add.reduceat(mark[ids[starts[a] :]], starts[a:] - starts[a], dtype=np.int64)
        mark[own] = 0
        for j in (a + np.flatnonzero(fit & (LEAST[1] * both >= LEAST[0] * (n + sizes[i] - both)))).tolist():
            if label[j] != label[i]:
                links.append((int(first[i]), int(first[j])))
                label[label == label[j]] = label[i]
    return links


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (k, deal, root, shingles), sorted by the first two, to links (u, v) of roots."""
    for rows in _groups(batches):
        if len(rows) > 1:
            a, b, body = utf8(rows.column(3))
            links = settle(rows.column(2).to_numpy(), [np.frombuffer(body[i:j], np.uint32) for i, j in zip(a.tolist(), b.tolist(), strict=True)])
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links, strict=True)], names=["u", "v"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            one, two = (np.frombuffer(s.as_py(), np.uint32) for s in (x, y))
            both = len(np.intersect1d(one, two, assume_unique=True))
            keep.append(both > 0 and LEAST[1] * both >= LEAST[0] * (len(one) + len(two) - both))
        yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))


@tidy
def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, th, component_id, kept`` of each row: texts with a five-word similarity of 0.8 or more are linked, the component
    is the smallest key that links reach; the row with that key is kept, of several the one with the smallest th
    (xxhash64(text)).

    A-Z are lower-cased; words are what white space separates; of fewer than five words the whole sequence is the shingle.
    Texts without words (null and empty ones) are linked with equal texts only. Null keys are never the smallest, unless a
    component has no other. Rows that are equal in key and text count as one text. An empty table gives no rows.
    """
    texts = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("th"))
    rows = stash(texts.mapInArrow(_scan, "key long, th long, fp long, bands array<long>, sketch binary"), "near")
    distinct = stash(rows.where("sketch is not null").dropDuplicates(["th"]).select("th", "fp", "bands", "sketch"), "near-distinct")

    # fingerprints within 4 bits
    prints = stash(distinct.groupBy("fp").agg(F.min("th").alias("low")), "near-prints")
    links = prints.select("fp").mapInArrow(_emit_keys, "k long, fp long").repartition("k").sortWithinPartitions("k", "fp").mapInArrow(_links(RADIUS), "u long, v long").distinct()
    one, two = prints.withColumnsRenamed({"fp": "u", "low": "x"}), prints.withColumnsRenamed({"fp": "v", "low": "y"})
    by_print = links.join(one, "u").join(two, "v").select(F.col("x").alias("u"), F.col("y").alias("v"))
    by_print = by_print.unionByName(distinct.join(prints, "fp").select(F.col("th").alias("u"), F.col("low").alias("v")))

    # buckets of bands
    banded = distinct.select("th", "sketch", F.explode("bands").alias("k"))
    sizes = stash(banded.groupBy("k").count().where("count > 1"), "near-buckets")
    maybe = banded.where(may_hold(key_bitmap(sizes, "k"), "k"))
    dealt = maybe.join(sizes, "k").select("k", F.pmod(F.xxhash64("th", "k"), F.ceil(F.col("count") / BLOCK)).cast("int").alias("deal"), (F.col("count") > BLOCK).alias("many"), "th", "sketch")
    own = F.xxhash64("th", "k")  # an order of its own in each bucket: who fails a test in one may pass in another
    shape, order = "k long, u long, v long, sketch binary", ["k", "deal"]
    first = stash(dealt.repartition(*order).sortWithinPartitions(*order, own).mapInArrow(_compare, shape), "near-links")
    heads = first.where("v is null").select("k", F.lit(0).alias("deal"), F.lit(False).alias("many"), F.col("u").alias("th"), "sketch")
    second = heads.repartition("k").sortWithinPartitions("k", own).mapInArrow(_compare, shape)

    pairs = first.where("v is not null").select("u", "v").unionByName(second.select("u", "v")).unionByName(by_print).where("u != v")
    pairs = stash(pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "near-pairs")
    ends = stash(pairs.select(F.col("u").alias("th")).unionByName(pairs.select(F.col("v").alias("th"))).distinct(), "near-ends")
    met = texts.where(may_hold(key_bitmap(ends, "th"), "th")).select("th", "text").mapInArrow(_sets, "th long, shingles binary")
    sets = stash(met.join(ends, "th", "left_semi").dropDuplicates(["th"]), "near-sets")
    one, two = sets.withColumnsRenamed({"th": "u", "shingles": "x"}), sets.withColumnsRenamed({"th": "v", "shingles": "y"})
    links = pairs.join(one, "u").join(two, "v").select("u", "v", "x", "y").mapInArrow(_verify, "u long, v long")

    roots = stash(components(links, "near-components").withColumnRenamed("v", "th"), "near-roots")
    lows = stash(rows.groupBy("th").agg(F.min(F.struct(F.col("key").isNull().alias("z"), "key", "th")).alias("low")), "near-lows")

    # pairs of a bucket that aren't connected yet, since the texts were tested with others only: pairs of blocks, if it has several
    banded = stash(dealt.join(roots, "th", "left").select("k", "th", F.coalesce("root", "th").alias("root"), "sketch"), "near-banded")
    mixed = stash(banded.groupBy("k").agg(F.count("*").alias("n"), F.min("root").alias("a"), F.max("root").alias("b")).where("a != b").select("k", F.ceil(F.col("n") / max(1, BLOCK // 2)).cast("int").alias("blocks")), "near-mixed")
    own, many = F.pmod(F.xxhash64("th", "k"), F.col("blocks")).cast("int"), F.col("blocks") > 1
    partners = F.when(many, F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: x != F.col("own"))).otherwise(F.array(F.lit(0)))
    met = banded.join(mixed, "k").withColumn("own", own).withColumn("with", F.explode(partners))
    met = met.select("k", (F.least("own", "with").cast("long") * F.col("blocks") + F.greatest("own", "with")).alias("deal"), "th", "root", "sketch")
    left = stash(met.repartition(*order).sortWithinPartitions(*order).mapInArrow(_unsettled, "k long, deal long, th long, root long"), "near-unsettled")
    ends = stash(left.select("th").distinct(), "near-left")
    met = texts.where(may_hold(key_bitmap(ends, "th"), "th")).select("th", "text").mapInArrow(_sets, "th long, shingles binary")
    sets = stash(met.join(ends, "th", "left_semi").dropDuplicates(["th"]), "near-left-sets")
    tested = left.join(sets, "th").select("k", "deal", "root", "shingles").repartition(*order).sortWithinPartitions(*order)
    more = components(tested.mapInArrow(_settle, "u long, v long"), "near-components").select(F.col("v").alias("root"), F.col("root").alias("higher"))

    members = lows.join(roots, "th", "left").select("th", "low", F.coalesce("root", "th").alias("root"))
    members = stash(members.join(stash(more, "near-higher"), "root", "left").select("th", "low", F.coalesce("higher", "root").alias("root")), "near-members")
    least = stash(members.groupBy("root").agg(F.min("low").alias("c")), "near-least")
    classes = stash(members.join(least, "root").select("th", "c"), "near-classes")
    kept = F.col("key").eqNullSafe(F.col("c.key")) & (F.col("th") == F.col("c.th"))
    return rows.select("key", "th").join(classes, "th").select("key", "th", F.col("c.key").alias("component_id"), kept.alias("kept"))
