"""Intermediate tables in the shared folder, with an owner that removes them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagelode.session import scratch_path


class Scratch:
    """Tables of one job. A dropped table is deleted; nothing may read it later."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = scratch_path(spark, name)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back, so that its lineage ends in files."""
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)
