"""URL filters: a blocked Bloom filter of the listed canonical URLs, then an exact hash join of what passes.

A listed URL is a host and the start of a path. A page may fall under a listed URL by each of the ends of its host and
each of the starts of its path, in the few shapes (labels of the host, characters of the path) that the list has. The
hash of each such candidate sets all 8 bits in one 512-bit block of the filter if it is listed, so one cache line settles
it. Only candidates that pass are joined with the list, by host and path, which removes false positives.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stash, tidy

#: Bits a listed URL, and most blocks of 512 bits of a filter (64 MB): longer lists let more through to the exact join.
BITS_PER_URL, MOST_BLOCKS = 16, 1 << 20
#: The list is broadcast in the exact join if its text is at most so many bytes; else both sides are shuffled.
BROADCAST_BYTES = 8 << 20
_BITS = 8


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: then up to ``?``, ``#`` or the end. Both empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def _spread(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Block, words and masks (8 each) of 64-bit hashes."""
    h = h.view(np.uint64)
    block = (h >> np.uint64(32)) % np.uint64(blocks)
    step = (h * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    spot = (h[:, None] + step[:, None] * np.arange(1, _BITS + 1, dtype=np.uint64)) >> np.uint64(55)
    return block.astype(np.int64), (spot >> np.uint64(6)).astype(np.int64), np.uint64(1) << (spot & np.uint64(63))


class BlockedBloom:
    def __init__(self, blocks: int, words: np.ndarray | None = None):
        self.blocks = blocks
        self.words = np.zeros((blocks, 8), np.uint64) if words is None else words

    @classmethod
    def build(cls, hashes: DataFrame, n: int) -> BlockedBloom:
        """Of a DataFrame of one bigint column. Tasks make filters of the same size, which are merged word by word."""
        blocks = int(min(MOST_BLOCKS, max(1, -(-n * BITS_PER_URL // 512))))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            mine = cls(blocks)
            for batch in batches:
                mine.add(batch.column(0).to_numpy())
            flat = mine.words.reshape(-1).view(np.int64)
            at = np.flatnonzero(flat)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at])], names=["word", "bits"])

        found = hashes.mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()  # at most the filter
        out = cls(blocks)
        out.words.reshape(-1)[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
        return out

    def add(self, h: np.ndarray) -> None:
        block, word, mask = _spread(np.ascontiguousarray(h), self.blocks)
        np.bitwise_or.at(self.words, (block[:, None], word), mask)

    def has(self, h: np.ndarray) -> np.ndarray:
        block, word, mask = _spread(np.ascontiguousarray(h), self.blocks)
        return (self.words[block[:, None], word] & mask == mask).all(axis=1)


#: Stands for the path in the hash of a host alone.
_HOST = "\0"


def _hash(host: str, path: str) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(f"{host}\0{path}".encode(), 42)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h = np.fromiter((_hash(a, b) for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])


@tidy
def judge(pages: DataFrame, listed: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """``key, host, path, rule, verdict`` of each row of pages.

    ``listed`` has ``host, path, verdict``. A listed URL fits its host and all subdomains, if the page's path starts with
    its path; of those that fit the longest (host and path together) decides, then the one with the longer host, then
    block before allow; ``rule`` is its host and path. Pages that none fits get ``default``. Null urls have an empty host
    and path; so have those without ``://``. Listed rows with a null, or repeated ones, count once or not at all.
    An empty list, or an empty table, is fine. Repeated pages give repeated rows.
    """
    spark = pages.sparkSession
    listed = listed.select("host", "path", "verdict").dropna().groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    listed = stash(listed.select("host", "path", "verdict"), "url-list")
    n, size = listed.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("host") + F.octet_length("path") + 8), F.lit(0))).head()
    # for each number of labels the lengths of the paths that are listed with it: labels of a host times characters of a path, at most
    shapes = listed.groupBy(F.size(F.split("host", r"\.")).alias("k")).agg(F.array_sort(F.collect_set(F.length("path"))).alias("m")).orderBy("k").collect()
    hosts_too = listed.select("host", "path").unionByName(listed.select("host", F.lit(_HOST).alias("path")).distinct())
    bloom = spark.sparkContext.broadcast(BlockedBloom.build(hosts_too.mapInArrow(_hashes, "h long"), 2 * n))  # 64 MB at most

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, hosts, paths = [], [], []
            for i, (host, path) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                labels = host.split(".")
                ends = [(".".join(labels[len(labels) - k :]), m) for k, m in shapes if k <= len(labels)]
                known = bloom.value.has(np.fromiter((_hash(x, _HOST) for x, _ in ends), np.uint64, len(ends))) if ends else ()
                for (x, lengths), listed_host in zip(ends, known, strict=True):
                    for m in lengths[: bisect_right(lengths, len(path))] if listed_host else ():
                        at.append(i)
                        hosts.append(x)
                        paths.append(path[:m])
            hit = bloom.value.has(np.fromiter(map(_hash, hosts, paths), np.uint64, len(at))) if at else np.zeros(0, bool)
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for j in np.flatnonzero(hit).tolist():
                found[at[j]].append({"host": hosts[j], "path": paths[j]})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.struct([("host", pa.string()), ("path", pa.string())])))], names=["key", "host", "path", "found"])

    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"))
    rows = rows.mapInArrow(candidates, f"key {pages.schema[key].dataType.simpleString()}, host string, path string, found array<struct<host:string,path:string>>")
    rows = stash(rows.withColumn("row", F.monotonically_increasing_id()), "url-rows")
    list_side = listed.select(F.col("host").alias("l_host"), F.col("path").alias("l_path"), F.col("verdict").alias("l_verdict"))
    if size <= BROADCAST_BYTES:
        list_side = F.broadcast(list_side)
    hits = rows.select("row", F.explode("found").alias("f")).select("row", F.col("f.host").alias("l_host"), F.col("f.path").alias("l_path")).join(list_side, ["l_host", "l_path"])
    longest = F.max(F.struct((F.length("l_host") + F.length("l_path")).alias("n"), F.length("l_host").alias("h"), F.col("l_verdict").alias("v"), F.concat("l_host", "l_path").alias("rule")))
    best = stash(hits.groupBy("row").agg(longest.alias("b")).select("row", F.col("b.v").alias("v"), F.col("b.rule").alias("rule")), "url-hits")
    return rows.join(best, "row", "left").select(F.col("key").alias(key), "host", "path", "rule", F.coalesce("v", F.lit(default)).alias("verdict"))
