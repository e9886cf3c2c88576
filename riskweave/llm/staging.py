"""Tables written between the passes of an operator, in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from riskweave.session import shared_dir

#: Rows of 64-bit keys up to which a key table may be broadcast; its size is counted first.
BROADCAST_ROWS = 1 << 20


class Staged:
    """Writes tables to a folder of its own and deletes those that nobody needs any more.

    A table survives lost executors, cuts the lineage, and later passes read
    only the columns they use.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.folder = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self._paths: dict[str, int] = {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self._paths[name] = self._paths.get(name, 0) + 1
        path = f"{self.folder}/{name}-{self._paths[name]}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Deletes what was last written under ``name``."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}-{self._paths[name]}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
