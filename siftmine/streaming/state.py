"""Small state of ``foreachBatch`` jobs as tables in the shared folder.

A batch reads what the batch before it wrote and writes only under its own
number, so a batch that is run again after a failure overwrites its own output
and sees the same input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class VersionedTable:
    """A small table that every batch replaces; the last two versions are kept."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema

    def _slot(self, batch_id: int) -> str:
        return f"{self.path}/slot={batch_id % 2}"

    def before(self, batch_id: int) -> DataFrame:
        """The table as the previous batch left it."""
        if batch_id == 0:
            return self.spark.createDataFrame([], self.schema)
        return self.of(batch_id - 1)

    def of(self, batch_id: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self._slot(batch_id))

    def write(self, batch_id: int, df: DataFrame) -> DataFrame:
        df.coalesce(1).write.mode("overwrite").parquet(self._slot(batch_id))
        return self.of(batch_id)
