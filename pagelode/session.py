"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "pagelode", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators are tested under.

    On a cluster the launcher sets master, memory and the number of shuffle
    partitions; only what affects results or plan shape is fixed here.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    Only a local master may fall back to a temporary folder of this machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="pagelode-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused path under the shared folder."""
    return f"{scratch_root(spark)}/pagelode/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage for good: a lost executor re-reads files instead of
    re-running the upstream plan.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def working(spark: SparkSession, name: str) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A function like ``materialize`` whose tables are removed at the end of the block.

    For work that is complete by then: nothing that leaves the block may read them.
    """
    from pagelode.sources import files

    root = scratch_path(spark, name)

    def keep(df: DataFrame, table: str) -> DataFrame:
        df.write.parquet(f"{root}/{table}")
        return spark.read.schema(df.schema).parquet(f"{root}/{table}")

    try:
        yield keep
    finally:
        files.remove(spark, root)
