"""Where the tables of a job are written: a folder with one table a name."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from ..functions.batches import bound_batches


@lru_cache(1)
def _local_dir() -> str:
    return "file://" + tempfile.mkdtemp(prefix="quire-")


def job_id(prefix: str) -> str:
    """A name of its own for each job: what is safe of the prefix, the time, and eight random digits."""
    import re
    from datetime import UTC, datetime

    return f"{re.sub('[^A-Za-z0-9_-]+', '-', prefix).strip('-') or 'job'}-{datetime.now(UTC):%Y%m%dT%H%M%SZ}-{uuid.uuid4().hex[:8]}"


class Workspace:
    """Writes tables and reads them again, which cuts the lineage, so that lost executors cost no more than a table.

    The folder must be one that driver and executors share; without one a folder of its own under ``spark.checkpoint.dir``
    is taken, and in local mode, where that may be unset, a temporary one.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, name: str = "job"):
        self.spark = spark
        bound_batches(spark)
        if folder is None:
            shared = spark.conf.get("spark.checkpoint.dir", None)
            master = spark.sparkContext.master
            if not shared and (not master.startswith("local") or master.startswith("local-cluster")):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            folder = f"{(shared or _local_dir()).rstrip('/')}/{job_id(name)}"
        self.folder = folder

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def table(self, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def close(self) -> None:
        """Deletes all tables."""
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
