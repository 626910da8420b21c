"""The re-crawl gate over a stream of arrivals.

``stream_gate`` keeps the last accepts in a bucketed table: each micro-batch is
one replay in the JVM, a hot URL is split, and expired accepts are forgotten.
``recrawl_gate`` keeps them in Spark's state store, for streams of small batches:
it takes a URL's arrivals of a batch as one group and forgets nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pagelode.operators.throttle import recrawl_throttle
from pagelode.session import working
from pagelode.sources.segments import SegmentStore, Snapshot, Table


def accepted_times(times: np.ndarray, ttl: int, last: int | None) -> list[int]:
    """Greedy accepts of sorted times, jumping from accept to accept."""
    kept: list[int] = []
    at = 0 if last is None else int(np.searchsorted(times, last + ttl))
    while at < len(times):
        kept.append(int(times[at]))
        at = int(np.searchsorted(times, kept[-1] + max(ttl, 1)))
    return kept


def recrawl_gate(arrivals: DataFrame, ttl: int) -> DataFrame:
    """Accepted (url, time) rows of a stream; times and ttl in microseconds.

    The state is the last accept per URL. A batch's arrivals are taken in time
    order; one older than the last accept is within the time to live and is
    dropped. All arrivals of a URL in a batch are one group, so bound the batch.
    """

    def gate(
        key: tuple[Any, ...], frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        times = np.unique(np.concatenate([f["time"].to_numpy() for f in frames]))
        last = state.get[0] if state.exists else None
        kept = accepted_times(times, ttl, last)
        if kept:
            state.update((kept[-1],))
            yield pd.DataFrame({"url": key[0], "time": kept})

    kind = arrivals.schema["url"].dataType.simpleString()
    return (
        arrivals.select("url", F.col("time").cast("bigint").alias("time"))
        .groupBy("url")
        .applyInPandasWithState(
            gate,
            f"url {kind}, time BIGINT",
            "last BIGINT",
            "append",
            GroupStateTimeout.NoTimeout,
        )
    )


# The gate over stored accepts

GATE = {
    "accepted": Table("url STRING, time BIGINT", ("url", "time"), "url"),
    "last": Table("url STRING, time BIGINT", ("url",), "url", "last"),
}


def gate_store(spark: SparkSession, path: str, buckets: int = 64) -> SegmentStore:
    return SegmentStore(spark, path, GATE, buckets)


def accept_batch(
    store: SegmentStore, arrivals: DataFrame, batch_id: int, ttl: int, lateness: int | None = None
) -> Snapshot:
    """Take a batch of arrivals (url, time) through the gate and store what is accepted.

    Accepts and the last accept per URL are committed together, so a batch that
    is repeated after a failure is taken once. Only the buckets of the batch's
    URLs are read. With ``lateness``, in microseconds, an arrival that is older
    than the newest one of earlier batches by more than that is late and dropped;
    in return, accepts that can block nothing any more are forgotten when
    segments are merged. Arrivals without a URL or a time are none.
    """
    base = store.snapshot()
    if base.last_batch is not None and batch_id <= base.last_batch:
        return base
    newest = max(base.facts("newest"), default=None)
    with working(store.spark, "gate") as keep:
        log = arrivals.select("url", F.col("time").cast("bigint").alias("time")).where("url is not null")
        log = log.where("time is not null").distinct()
        if lateness is not None and newest is not None:
            log = log.where(F.col("time") >= newest - lateness)
        log = keep(log, "log")
        accepted = recrawl_throttle(log, ttl, base.at("last", log, "url"))
        seen = log.agg(F.max("time")).first()[0]
        last = accepted.groupBy("url").agg(F.max("time").alias("time"))
        facts = {} if seen is None else {"newest": max(seen, seen if newest is None else newest)}
        return store.commit(base, {"accepted": accepted, "last": last}, batch_id, facts)


def merge_gate(store: SegmentStore, ttl: int, lateness: int | None = None, everything: bool = False) -> Snapshot:
    """Merge the segments that are due, or all, and forget accepts that have expired."""
    base = store.snapshot()
    taken = base.segments if everything else store.due(base)
    horizon = None if lateness is None else max(base.facts("newest"), default=0) - lateness

    def blocking(part: Snapshot, oldest: bool) -> DataFrame:
        last = part.rows("last")
        return last if horizon is None else last.where(F.col("time") + ttl > horizon)

    merged = store.merge(base, taken, {"last": blocking}, {"newest": max})
    store.vacuum()
    return merged


def stream_gate(
    arrivals: DataFrame,
    store: SegmentStore,
    checkpoint: str,
    ttl: int,
    lateness: int | None = None,
    available_now: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Take a stream of arrivals through the gate, micro-batch by micro-batch."""

    def run(batch: DataFrame, batch_id: int) -> None:
        accept_batch(store, batch, batch_id, ttl, lateness)
        merge_gate(store, ttl, lateness)

    writer = arrivals.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()
