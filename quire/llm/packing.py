"""Best-fit packing of documents into sequences, under conflicts.

A bin never holds two documents of one source, nor two of one cluster of duplicates. Bins are kept in the order of what
they have left; each carries a bitmap of its sources and one of its clusters. A document goes, longest first, to the
tightest bin that it fits: the search starts at the first bin with enough left and goes on to its successors until a bin
has neither its source nor its cluster. Without one, a new bin is opened.

Packing is local to groups of about the same number of documents, dealt by a hash of the document, so that no key
decides where rows go and the work grows with the input. Bitmaps are integers of as many bits as the group has sources,
and clusters with more than one document.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stash, tidy

#: Bytes of text in a sequence.
CAPACITY = 8192
#: Documents that are packed together, on average.
GROUP = 2048


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int) -> list[int]:
    """The bin of each document, in the order given; sizes are 0 to capacity. None as source or cluster conflicts with nothing."""
    bit = {s: 1 << i for i, s in enumerate(dict.fromkeys(s for s in sources if s is not None))} | {None: 0}
    several = [c for c, n in Counter(c for c in clusters if c is not None).items() if n > 1]
    cluster_bit = {c: 1 << i for i, c in enumerate(several)}
    open_: list[tuple[int, int]] = []  # (left, bin), ascending
    source_map: list[int] = []
    cluster_map: list[int] = []
    out = []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        s, c = bit[source], cluster_bit.get(cluster, 0)
        for i in range(bisect_left(open_, (size, -1)), len(open_)):
            k = open_[i][1]
            if not (source_map[k] & s or cluster_map[k] & c):
                left = open_.pop(i)[0] - size
                break
        else:
            k, left = len(source_map), capacity - size
            source_map.append(0)
            cluster_map.append(0)
        source_map[k] |= s
        cluster_map[k] |= c
        insort(open_, (left, k))
        out.append(k)
    return out


def _pack(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        group = table.column("grp")[0].as_py()
        row, size = table.column("row").to_numpy(), table.column("size").to_numpy()
        tail = size % capacity
        tail[(tail == 0) & (size > 0)] = capacity
        order = np.lexsort((row, -tail))
        sources, clusters = table.column("source").to_pylist(), table.column("cluster").to_pylist()
        bins = best_fit(tail[order].tolist(), [sources[i] for i in order], [clusters[i] for i in order], capacity)
        whole = (size - tail) // capacity  # full sequences of a document's own, before its tail
        rows, piece, start, length, bin_ = [], [], [], [], []
        used, next_bin, place = Counter(), max(bins, default=-1) + 1, []
        for i, b in zip(order.tolist(), bins, strict=True):
            for p in range(int(whole[i])):
                rows.append(i), piece.append(p), start.append(p * capacity), length.append(capacity), bin_.append(next_bin), place.append(0)
                next_bin += 1
            rows.append(i), piece.append(int(whole[i])), start.append(int(whole[i]) * capacity), length.append(int(tail[i])), bin_.append(b), place.append(used[b])
            used[b] += int(tail[i])
        at = pa.array(rows, pa.int64())
        return pa.table({
            "key": table.column("key").take(at), "piece": pa.array(piece, pa.int64()), "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
            "bin_id": pa.array((np.int64(group) << 32) + np.array(bin_, np.int64)), "place": pa.array(place, pa.int64()),
        })

    return run


@tidy
def pack(docs: DataFrame, size: Column, source: Column, cluster: Column, key: str = "doc_id", capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``key, piece, start, length, bin_id, place``: each document's pieces, where each starts in the document, and where it lies in its bin.

    A document longer than the capacity fills sequences of its own, and its last piece is packed like any other. Null or
    negative sizes count as 0; those documents still get a place. Null sources and clusters conflict with nothing.
    Repeated rows are packed one by one, and the result depends on the rows alone, not on files or tasks. An empty table gives no rows. Other columns are not read.
    """
    kind = docs.schema[key].dataType
    rows = docs.select(F.col(key).alias("key"), F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).cast("long").alias("size"), source.cast("string").alias("source"), cluster.cast("string").alias("cluster"))
    # equal rows are counted before they are dealt, and numbered, so that groups don't depend on files or tasks and none is hot
    rows = stash(rows.groupBy("key", "size", "source", "cluster").agg(F.count("*").alias("n")), "packing-rows")
    groups = max(1, -(-(rows.agg(F.sum("n")).head()[0] or 0) // group))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).withColumn("row", F.xxhash64("key", "size", "source", "cluster", "copy"))
    rows = rows.select("key", "size", "source", "cluster", "row", F.pmod(F.xxhash64("row", F.lit(group)), F.lit(groups)).alias("grp"))
    return rows.groupBy("grp").applyInArrow(_pack(capacity), f"key {kind.simpleString()}, piece long, start long, length long, bin_id long, place long")


def cluster_of(text: Column) -> Column:
    """A cluster of duplicates: texts that are equal without case, punctuation and white space. Texts that have nothing
    else, null ones too, are in no cluster, so they share bins."""
    bare = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", "")
    return F.when(bare != "", F.sha2(bare, 256))
