"""Continuous indexing: every micro-batch runs the batch code."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from pagelode.plans import live
from pagelode.plans.build import index_batch
from pagelode.sources.segments import SegmentStore
from pagelode.sources.store import IndexStore


def stream_index(
    pages: DataFrame,
    store_path: str,
    checkpoint: str,
    clock: Callable[[int], Column | datetime],
    ttl_seconds: int = 0,
    mode: str = "keep_first",
    available_now: bool = True,
    interval: str = "10 minutes",
) -> StreamingQuery:
    """Index a page stream. ``clock`` gives the index time of a batch id, the
    same one on every run of that batch, so a repeated batch writes the same."""

    def run(batch: DataFrame, batch_id: int) -> None:
        store = IndexStore(batch.sparkSession, store_path)
        index_batch(store, batch, batch_id, clock(batch_id), ttl_seconds, mode)

    writer = pages.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def stream_live_index(
    pages: DataFrame,
    store: SegmentStore,
    checkpoint: str,
    clock: Callable[[int], Column | datetime],
    ttl_seconds: int = 0,
    available_now: bool = True,
    interval: str = "10 minutes",
) -> StreamingQuery:
    """Extend a live index by a page stream: every micro-batch can be searched once committed.

    A micro-batch that is repeated after a failure is committed once. Segments
    are merged between batches as they become due.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        live.index_pages(store, batch, batch_id, clock(batch_id), ttl_seconds)
        live.merge_segments(store)

    writer = pages.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()
