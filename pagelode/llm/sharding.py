"""Shards of equal size by a consistent-hash ring with bounded loads.

Every shard owns virtual nodes, points on a ring of hash values; a key belongs
to the first point clockwise of its hash. A shard takes no more rows than its
capacity: rows that find it full continue clockwise to the next point whose
shard has room. Capacities add up to the number of rows and differ by one at
most, so the counts of the shards do too.

The rows between two points form an arc. What the walk does to an arc depends
only on how many rows each arc holds, so the walk is planned on those counts:
one number per virtual node comes to the driver, however large the table is.
Rows get their place by their rank within their arc, which is counted in cells:
an arc is cut by hash, so that ranking it takes as many tasks as it has rows for.
Repeated rows are counted, ranked once and spread again. All else is DataFrame
operations.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LAW = "rows"
OVERHEAD = 16
# Rows that are ranked in one cell, about.
_CELL = 20_000


@dataclass(frozen=True)
class Ring:
    shards: int = 40
    virtual_nodes: int = 64

    @property
    def arcs(self) -> int:
        return self.shards * self.virtual_nodes


@dataclass(frozen=True)
class Span:
    """Rows ``low`` to ``high`` (exclusive) of an arc go to ``shard`` from ``slot`` on."""

    arc: int
    low: int
    high: int
    shard: int
    slot: int


def _points(df: DataFrame, ring: Ring) -> list[tuple[int, int]]:
    """(point, shard) of every virtual node, ascending."""
    nodes = df.sparkSession.range(ring.arcs).select(
        (F.col("id") / ring.virtual_nodes).cast("int").alias("shard"),
        F.xxhash64(F.lit("ring"), F.col("id")).alias("point"),
    )
    return sorted((r.point, r.shard) for r in nodes.collect())


def with_arc(rows: DataFrame, points: list[int]) -> DataFrame:
    """Adds ``arc``, the index of the first point at or after ``hashed``; after the last comes the first.

    The ring is cut into equal sectors; a broadcast table, as long as the ring
    has sectors, tells the points before each and those within it.
    """
    within: dict[int, list[int]] = {}
    for p in points:
        within.setdefault(p >> 52, []).append(p)
    table, before = [], 0
    for sector in range(-2048, 2048):
        inside = within.get(sector, [])
        table.append((sector, before, inside))
        before += len(inside)
    sectors = rows.sparkSession.createDataFrame(table, "sector BIGINT, before INT, inside ARRAY<BIGINT>")
    found = rows.withColumn("sector", F.shiftright("hashed", 52)).join(F.broadcast(sectors), "sector")
    passed = F.size(F.filter("inside", lambda p: p < F.col("hashed")))
    arc = F.pmod(F.col("before") + passed, F.lit(len(points)))
    return found.withColumn("arc", arc).drop("sector", "before", "inside")


def plan_spans(counts: list[int], owners: list[int], shards: int) -> list[Span]:
    """Where the rows of each arc go, walking clockwise in turns.

    In turn h the rows of every arc that have no place yet ask the h-th point
    after their own; arcs ask in order, and a shard takes rows while it has
    room. Slots of a shard are given in the order in which it takes rows.
    """
    total = sum(counts)
    capacity = [total // shards + (s < total % shards) for s in range(shards)]
    room = list(capacity)
    placed = [0] * len(counts)
    waiting = [a for a, n in enumerate(counts) if n]
    spans = []
    turn = 0
    while waiting:
        still = []
        for arc in waiting:
            shard = owners[(arc + turn) % len(owners)]
            taken = min(room[shard], counts[arc] - placed[arc])
            if taken:
                slot = capacity[shard] - room[shard]
                spans.append(Span(arc, placed[arc], placed[arc] + taken, shard, slot))
                placed[arc] += taken
                room[shard] -= taken
            if placed[arc] < counts[arc]:
                still.append(arc)
        waiting = still
        turn += 1
    return spans


def assign_shards(
    documents: DataFrame, ring: Ring = Ring(), *, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row.

    ``size`` is the UTF-8 bytes of the text plus 16; a null text counts as none
    and has the CRC-32 of the empty string. The law is ``rows``: counts of the
    shards differ by one at most; ``slot`` counts from 0 in each shard without
    gaps; ``grown_shard`` is null. A row's key is its doc_id and text, so that an
    id or null id on many rows spreads over the ring. Repeated rows are placed
    one by one, side by side in their arc. Only doc_id and text are read; an
    empty table gives an empty result.
    """
    spark = documents.sparkSession
    body = F.coalesce(documents[text], F.lit(""))
    rows = (
        documents.select(
            documents[doc_id].alias("doc_id"),
            (F.octet_length(body) + F.lit(OVERHEAD)).cast("bigint").alias("size"),
            F.crc32(body).alias("text_crc32"),
        )
        .groupBy("doc_id", "size", "text_crc32")
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("hashed", F.xxhash64(F.lit("key"), "doc_id", "text_crc32", "size"))
    )
    ring_points = _points(documents, ring)
    points, owners = [p for p, _ in ring_points], [s for _, s in ring_points]
    rows = with_arc(rows, points)
    told = rows.groupBy("arc").agg(F.sum("copies").alias("n"), F.count(F.lit(1)).alias("keys")).collect()
    found = dict.fromkeys(range(ring.arcs), 0) | {r["arc"]: r["n"] for r in told}
    spans = plan_spans([found[a] for a in range(ring.arcs)], owners, ring.shards)
    # At most a few spans per arc, as each but an arc's last fills a shard.
    table = spark.createDataFrame(
        [(s.arc, s.low, s.high, s.shard, s.slot) for s in spans],
        "arc INT, low BIGINT, high BIGINT, shard INT, first BIGINT",
    )
    # Sectors of the ring in the order of hashes; a cell is an arc's part of one.
    bits = (sum(r["keys"] for r in told) // _CELL).bit_length()
    rows = rows.withColumn("sector", F.shiftright("hashed", 64 - bits) if bits else F.lit(0).cast("bigint"))
    sizes = rows.groupBy("arc", "sector").agg(F.sum("copies").alias("n"))
    earlier = Window.partitionBy("arc").orderBy("sector").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("arc", "sector", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    order = Window.partitionBy("arc", "sector").orderBy("hashed", "doc_id", "text_crc32", "size")
    within = F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("copies")
    ranked = (
        rows.withColumn("within", within)
        .join(sizes, ["arc", "sector"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "arc",
            (F.col("before") + F.col("within")).alias("from"),
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)).alias("copy"),
        )
        .withColumn("at", F.col("from") + F.col("copy"))
    )
    placed = ranked.join(F.broadcast(table), "arc").where("at >= low and at < high")
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        (F.col("first") + F.col("at") - F.col("low")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
