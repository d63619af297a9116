"""Packages as rows: an entry each, from zip files."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from ..functions import batches

ENTRIES = "ord int, name string, method int, content binary, error string"
#: What an entry counts for beside its content.
ROW_BYTES = 200


def read_archives(spark: SparkSession, path: str, glob: str = "*.epub") -> DataFrame:
    """``book_id, ord, name, method, content, error`` of every entry, in the order of the archive; book_id is the path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return unpack(files.selectExpr("path as book_id", "content"))


def unpack(files: DataFrame) -> DataFrame:
    """The entries of ``files(book_id, content)``. An archive that can't be read gives one row with the error; so does an entry. Null content is an archive that isn't there."""

    def rows(book, content: bytes | None) -> Iterator[tuple]:
        if content is None:
            yield book, -1, None, None, None, "missing"
            return
        try:
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                for i, entry in enumerate(archive.infolist()):
                    try:
                        yield book, i, entry.orig_filename, entry.compress_type, archive.read(entry), None
                    except Exception as e:  # a damaged entry may fail in many ways
                        yield book, i, entry.orig_filename, entry.compress_type, None, f"corrupt: {e}"
        except Exception as e:
            yield book, -1, None, None, None, f"corrupt: {e}"

    def run(found: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["book_id"] + [c.split()[0] for c in ENTRIES.split(", ")]
        frame = lambda lot: pd.DataFrame(lot, columns=names).astype({"ord": "Int32", "method": "Int32"})
        for batch in found:
            lot, held = [], 0  # entries of one archive or of several: LOT_BYTES and the last one at most
            for book, content in zip(batch["book_id"], batch["content"], strict=True):  # one archive at a time in memory
                for row in rows(book, content):
                    lot.append(row)
                    held += ROW_BYTES + len(row[4] or b"")
                    if held >= batches.LOT_BYTES:
                        yield frame(lot)
                        lot, held = [], 0
            if lot:
                yield frame(lot)

    batches.bound_batches(files.sparkSession)
    return files.select("book_id", "content").mapInPandas(run, f"book_id {files.schema['book_id'].dataType.simpleString()}, {ENTRIES}")
