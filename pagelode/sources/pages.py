"""Page tables and configuration lists as sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.functions import settings
from pagelode.schema import PAGES


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def stream_pages(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """New files of a page folder as a stream, a bounded number per batch."""
    return (
        spark.readStream.schema(PAGES)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def list_rows(df: DataFrame, setting: str, item: str) -> DataFrame:
    """One row per item of a ``;`` list column."""
    return df.select(F.explode(settings.list_items(F.col(setting))).alias(item))
