"""Bounds of what a Python worker holds at once, whatever the size of a task."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import SparkSession

#: Bytes of an Arrow batch that goes to a Python worker: rows alone, 10,000 of them, don't bound it when they are long.
BATCH_BYTES = "4m"
#: Bytes of the rows that are worked on, and handed back, together.
LOT_BYTES = 1 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches by bytes, unless it has a bound of its own; a single longer row still passes whole."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, BATCH_BYTES)


def lots(sizes: Iterable[int], most: int = LOT_BYTES) -> Iterator[tuple[int, int]]:
    """(first, after the last) of runs of rows of ``most`` bytes at most together; a single longer row is a run of its own."""
    start, held, i = 0, 0, -1
    for i, n in enumerate(sizes):
        if i > start and held + n > most:
            yield start, i
            start, held = i, 0
        held += n
    if i >= start:
        yield start, i + 1
