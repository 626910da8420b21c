"""Replay of the re-crawl gate over a log of arrivals.

An arrival is accepted if the URL was never accepted, or if its last accept is
at least the time to live ago; an accept restarts the clock. The rule is
greedy along each URL's timeline, so a look at the previous row is not enough.

Every arrival points to the first one of its URL that is at least the time to
live later. The accepts are the chain of pointers from the first arrival on.
Pointers are doubled: after round k the first 2^k accepts are known, and the
pointers lead 2^k accepts ahead. Every round joins on (URL, time), which is
unique on one side, so a hot URL is many keys and its skew is split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagelode.session import scratch_path
from pagelode.sources import files


def _keep(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def next_due(log: DataFrame, ttl: int, path: str) -> DataFrame:
    """(key, time, to): each arrival and the first of its key at least ``ttl`` later, if any.

    Arrivals and the times they ask for are cut into ranges of (key, time),
    which split a hot key, and answered within their range by a running minimum
    from the end. A time that no arrival of its range follows takes the first
    one of the key in a later range: as many rows as there are ranges.
    """
    parts = int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    none = F.lit(None).cast("bigint")
    points = log.select("key", F.col("time").alias("at"), none.alias("time")).union(
        log.select("key", (F.col("time") + ttl).alias("at"), "time")
    )
    placed = points.repartitionByRange(parts, "key", "at").withColumn("part", F.spark_partition_id())
    placed = _keep(placed, f"{path}/points")

    arrived = F.when(F.col("time").isNull(), F.col("at"))
    from_end = Window.partitionBy("part", "key").orderBy(F.col("at").desc(), F.col("time").asc_nulls_first())
    here = placed.withColumn("to", F.min(arrived).over(from_end.rowsBetween(Window.unboundedPreceding, 0)))
    asked = here.where("time is not null").drop("at")

    split = placed.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high")
    heads = (
        placed.join(split.select("key"), "key", "left_semi")
        .groupBy("key", "part")
        .agg(F.min(arrived).alias("head"))
    )
    later = Window.partitionBy("key").orderBy(F.col("part").desc())
    heads = heads.withColumn("later", F.min("head").over(later.rowsBetween(Window.unboundedPreceding, -1)))
    return (
        asked.join(heads.select("key", "part", "later"), ["key", "part"], "left")
        .select("key", "time", F.coalesce("to", "later").alias("to"))
        .where("to is not null")
    )


def recrawl_throttle(arrivals: DataFrame, ttl: int, last: DataFrame | None = None) -> DataFrame:
    """Accepted (url, time) rows; ``time`` and ``ttl`` are whole microseconds.

    Arrivals of one URL at the same microsecond are one arrival. An arrival
    without a time is none; all arrivals without a URL are those of one URL.
    ``last`` holds accepts from before, (url, time) with one row per URL.
    """
    # Rows of equal structs join even where their field is null.
    log = arrivals.select(F.struct("url").alias("key"), F.col("time").cast("bigint").alias("time"))
    log = log.where("time is not null").distinct()
    if last is not None:
        before = last.select(F.struct("url").alias("key"), F.col("time").alias("last"))
        log = log.join(before, "key", "left").where(
            F.col("last").isNull() | (F.col("time") - F.col("last") >= ttl)
        )
        log = log.select("key", "time")
    if ttl <= 0:
        return log.select("key.url", "time")

    spark = arrivals.sparkSession
    path = scratch_path(spark, "throttle")
    log = _keep(log, f"{path}/log")
    pointers = _keep(next_due(log, ttl, path), f"{path}/pointers")
    first = log.groupBy("key").agg(F.min("time").alias("time"))
    # Arrivals nothing points to are no accepts.
    met = first.union(pointers.select("key", F.col("to").alias("time"))).distinct()
    pointers = _keep(pointers.join(met, ["key", "time"], "left_semi"), f"{path}/pointers-0")
    schema = first.schema
    new = _keep(first, f"{path}/accepts/round=0")
    files.remove(spark, f"{path}/points")
    files.remove(spark, f"{path}/pointers")
    step = 0
    while not new.isEmpty():
        accepted = spark.read.schema(schema).parquet(f"{path}/accepts")
        ahead = accepted.join(pointers, ["key", "time"]).select("key", F.col("to").alias("time"))
        step += 1
        new = _keep(ahead, f"{path}/accepts/round={step}")
        then = pointers.select("key", F.col("time").alias("to"), F.col("to").alias("then"))
        doubled = pointers.join(then, ["key", "to"]).select("key", "time", F.col("then").alias("to"))
        pointers = _keep(doubled, f"{path}/pointers-{step}")
        files.remove(spark, f"{path}/pointers-{step - 1}")
    files.remove(spark, f"{path}/pointers-{step}")
    files.remove(spark, f"{path}/log")
    return spark.read.schema(schema).parquet(f"{path}/accepts").select("key.url", "time")
