"""The seen-URL filter: of the URLs that arrive, those that never did before.

``new_url_stream`` keeps what it has seen in Spark's stream state. ``take_urls``
and ``stream_new_urls`` keep it in segments: per segment a blocked Bloom filter
tells most new URLs apart at some ten bits a URL, and only those it cannot
tell are looked up, in the buckets that can hold them.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pagelode.session import working
from pagelode.sources.segments import SegmentStore, Snapshot, Table


def new_url_stream(
    targets: DataFrame, within: str | None = None, time: str = "found_at"
) -> DataFrame:
    """The first row of every ``url``.

    Without ``within`` every URL of the run stays in the state, so give the
    query a state store that spills to disk. With it (such as "30 days") a URL
    is forgotten that long after it was first found, and may pass again.
    """
    if within is None:
        return targets.dropDuplicates(["url"])
    return targets.withWatermark(time, within).dropDuplicatesWithinWatermark(["url"])


# The filter over stored URLs

SEEN = {
    "seen": Table("url STRING, batch_id BIGINT", ("url",), "url"),
    "filter": Table("block BIGINT, bits BINARY", ("block",), "block"),
}
# A block is one bitmap of Spark's bitmap functions; so many URLs fill it to about a third.
BLOCK_BITS = 32_768
URLS_PER_BLOCK = 3_276
HASHES = 4


def seen_store(spark: SparkSession, path: str, buckets: int = 64) -> SegmentStore:
    return SegmentStore(spark, path, SEEN, buckets)


def _block(url: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), url), blocks)


def _places(url: Column) -> list[Column]:
    """The bits of a URL in its block, taken from one hash."""
    told = F.xxhash64(F.lit("bit"), url)
    return [F.pmod(F.shiftrightunsigned(told, 16 * i), F.lit(BLOCK_BITS)) for i in range(HASHES)]


def url_filter(urls: DataFrame, blocks: int) -> DataFrame:
    """(block, bits) of distinct URLs."""
    placed = urls.select(
        _block(F.col("url"), F.lit(blocks)).alias("block"), F.explode(F.array(*_places(F.col("url")))).alias("place")
    )
    return placed.groupBy("block").agg(F.bitmap_construct_agg("place").alias("bits"))


def _has(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(place, F.lit(8)).cast("int")) == 1


def perhaps_seen(base: Snapshot, urls: DataFrame) -> DataFrame:
    """The distinct URLs that the filters of some segment hold: all seen ones, and few others."""
    held = [s for s in base.segments if s.rows.get("filter")]
    if not held:
        return urls.select("url").limit(0)
    asked = urls.select(
        "url",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(s.number).alias("segment"), _block(F.col("url"), F.lit(s.facts["blocks"])).alias("block"))
                    for s in held
                ]
            )
        ).alias("at"),
    ).select("url", "at.segment", "at.block")
    found = asked.join(base.scan("filter").drop("bucket"), ["segment", "block"])
    inside = reduce(Column.__and__, [_has(F.col("bits"), place) for place in _places(F.col("url"))])
    return found.where(inside).select("url").distinct()


def take_urls(store: SegmentStore, urls: DataFrame, batch_id: int) -> Snapshot:
    """Store the URLs of a batch that no batch before had, under its ``batch_id``.

    They are the rows of ``seen`` with that id. A batch that was committed
    before changes nothing. A null URL is none.
    """
    base = store.snapshot()
    if base.last_batch is not None and batch_id <= base.last_batch:
        return base
    with working(store.spark, "seen") as keep:
        arrived = keep(urls.select("url").where("url is not null").distinct(), "arrived")
        doubtful = keep(perhaps_seen(base, arrived), "doubtful")
        known = base.at("seen", doubtful, "url").select("url").join(doubtful, "url", "left_semi")
        new = keep(arrived.join(known, "url", "left_anti"), "new")
        blocks = math.ceil(new.count() / URLS_PER_BLOCK)
        added = {"seen": new.withColumn("batch_id", F.lit(batch_id).cast("bigint"))}
        if blocks:
            added["filter"] = url_filter(new, blocks)
        return store.commit(base, added, batch_id, {"blocks": blocks} if blocks else {})


def merge_seen(store: SegmentStore, everything: bool = False) -> Snapshot:
    """Merge the segments that are due, or all, under one filter."""
    base = store.snapshot()
    taken = base.segments if everything else store.due(base)
    blocks = math.ceil(sum(s.rows.get("seen", 0) for s in taken) / URLS_PER_BLOCK)
    own = {"filter": lambda part, _: url_filter(part.rows("seen"), max(1, blocks))}
    merged = store.merge(base, taken, own, {"blocks": lambda _: max(1, blocks)})
    store.vacuum()
    return merged


def stream_new_urls(
    targets: DataFrame, store: SegmentStore, checkpoint: str, available_now: bool = True, interval: str = "1 minute"
) -> StreamingQuery:
    """Take a stream of URLs, micro-batch by micro-batch."""

    def run(batch: DataFrame, batch_id: int) -> None:
        take_urls(store, batch, batch_id)
        merge_seen(store)

    writer = targets.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()
