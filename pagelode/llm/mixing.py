"""Interleaving sources to target weights, by Pfair scheduling.

A source's documents are cut into blocks. Weights are shares of a frame of
slots, so source s has w(s) blocks in every frame of F slots. Block k of a
source may not come before its release, floor(k * F / w), and must come before
its deadline, ceil((k + 1) * F / w). Taking, slot by slot, the released block
with the earliest deadline meets all of them, since the shares fill the frame;
so at any slot every source is less than one block off its share.

The schedule repeats frame by frame, so one frame is planned on the driver: its
size is a parameter. A block's slot follows from its number by arithmetic and
a look-up in that frame. When a source runs out, the others go on with their
weights in proportion: a new phase, with a frame of its own.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass
from fractions import Fraction
from heapq import heappop, heappush
from math import gcd, lcm

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

FRAME = 10_000
BLOCK = 16
# Documents of a source that are ranked in one task, about.
_CELL = 20_000


def shares(weights: dict[str, float], frame: int) -> dict[str, int]:
    """Slots of each source in a frame.

    Weights whose ratios are whole numbers of at most ``frame`` together are met
    exactly. Others are rounded to a frame by largest remainders, each source
    getting one slot at least; a frame of fewer slots than sources grows.
    """
    ratios = {s: Fraction(w).limit_denominator(1_000_000) for s, w in weights.items()}
    ratios = {s: r or Fraction(1, 1_000_000) for s, r in ratios.items()}
    scale = lcm(*(r.denominator for r in ratios.values()))
    whole = {s: int(r * scale) for s, r in ratios.items()}
    common = gcd(*whole.values())
    if sum(whole.values()) // common <= frame:
        return {s: n // common for s, n in whole.items()}
    total = sum(ratios.values())
    frame = max(frame, len(weights))
    exact = {s: r * frame / total for s, r in ratios.items()}
    given = {s: max(1, int(x)) for s, x in exact.items()}
    order = sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))
    left = frame - sum(given.values())
    while left:
        for s in order:
            step = 1 if left > 0 else -1
            if left and given[s] + step >= 1:
                given[s] += step
                left -= step
    return given


def plan_frame(given: dict[str, int]) -> list[str]:
    """The source of each slot of a frame, earliest deadline first."""
    frame = sum(given.values())
    releases = [[] for _ in range(frame)]
    for s in sorted(given):
        for k in range(given[s]):
            releases[k * frame // given[s]].append((-(-(k + 1) * frame // given[s]), s))
    ready: list[tuple[int, str]] = []
    order = []
    for slot in range(frame):
        for block in releases[slot]:
            heappush(ready, block)
        deadline, s = heappop(ready)
        assert deadline > slot, "a deadline was missed"
        order.append(s)
    return order


@dataclass(frozen=True)
class Phase:
    """Blocks of the sources that are left, from slot ``first`` on.

    ``slots`` has each source's slots of the frame ``order``, ``done`` the blocks
    it placed before, ``until`` those it has placed when the phase ends.
    """

    first: int
    order: list[str]
    slots: dict[str, list[int]]
    done: dict[str, int]
    until: dict[str, int]


def plan_phases(weights: dict[str, float], blocks: dict[str, int], frame: int = FRAME) -> list[Phase]:
    """Phases until all blocks are placed; each but the last ends when a source runs out.

    So S sources give at most S phases, each of at most max(``frame``, S) slots.
    """
    left = {s: n for s, n in blocks.items() if n}
    done = dict.fromkeys(left, 0)
    first, phases = 0, []
    while left:
        order = plan_frame(shares({s: weights[s] for s in left}, frame))
        slots = {s: [] for s in left}
        for i, s in enumerate(order):
            slots[s].append(i)
        # The slot at which each source places its last block, counted from the phase.
        last = {s: (n - 1) // len(slots[s]) * len(order) + slots[s][(n - 1) % len(slots[s])] for s, n in left.items()}
        end = min(last.values()) + 1
        until = dict(done)
        for s in left:
            whole, rest = divmod(end, len(order))
            until[s] = done[s] + whole * len(slots[s]) + bisect_left(slots[s], rest)
        phases.append(Phase(first, order, slots, done, until))
        left = {s: blocks[s] - until[s] for s in left if blocks[s] > until[s]}
        done, first = until, first + end
    return phases


def mix_sources(
    documents: DataFrame,
    weights: dict[str, float] | None = None,
    *,
    source: str = "source",
    doc_id: str = "doc_id",
    block: int = BLOCK,
    frame: int = FRAME,
    seed: int = 7,
) -> DataFrame:
    """All rows of ``documents``, their columns, and ``mix_slot`` and ``mix_place``.

    Ascending (mix_slot, mix_place) is the mixed order: a slot is one block of
    one source, a place a row in it. ``weights`` are relative target weights of
    the sources, equal ones by default; sources without a weight, or with one
    that is not above zero, get the smallest given weight. Rows without a source
    are a source of their own. Within a source the order is a seeded shuffle.
    No row is left out or repeated. Columns of those two names are
    replaced; an empty table stays empty.

    Per source, one count comes to the driver, and the plan that goes back has
    a frame per phase: for S sources at most S * max(``frame``, S) slots in all,
    of four bytes each; the sources must be few enough for that. Ranks within a
    source are taken in cells of its shuffled order, so a source with a third
    of all rows is ranked by many tasks. Rows are ordered by a hash of all their
    columns (but maps) besides the id, so that only rows that are equal in all of
    them may change places, and rows with an equal or null id share no cell.
    """
    spark = documents.sparkSession
    columns = [c for c in documents.columns if c not in ("mix_slot", "mix_place")]
    # Columns under names of their own, and apart, so that those a query does not read are pruned.
    held = {f"_{i}": c for i, c in enumerate(columns)}
    hashable = [documents[c] for c in columns if "map<" not in documents.schema[c].dataType.simpleString()]
    key = F.coalesce(F.concat(F.lit("s"), documents[source].cast("string")), F.lit(""))
    rows = documents.select(
        *(documents[c].alias(n) for n, c in held.items()),
        key.alias("_source"),
        documents[doc_id].alias("_id"),
        F.xxhash64(F.lit(seed), documents[doc_id], *hashable).alias("_hash"),
        F.xxhash64(*hashable).alias("_whole"),
    )
    back = [F.col(n).alias(c) for n, c in held.items()]
    counts = {r["_source"]: r["count"] for r in rows.groupBy("_source").count().collect()}
    if not counts:
        return rows.select(*back, F.lit(0).cast("bigint").alias("mix_slot"), F.lit(0).alias("mix_place"))
    given = {f"s{s}": w for s, w in (weights or {}).items() if w > 0}
    least = min(given.values(), default=1.0)
    phases = plan_phases(
        {s: given.get(s, least) for s in counts}, {s: -(-n // block) for s, n in counts.items()}, frame
    )

    # Rank within the source: rows of earlier cells, and the rank in the cell.
    cells = 1 + max(counts.values()) // _CELL
    rows = rows.withColumn("_cell", F.pmod(F.shiftrightunsigned("_hash", 11), F.lit(cells)).cast("int"))
    sizes = rows.groupBy("_source", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(
        Window.partitionBy("_source").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    )
    sizes = sizes.select("_source", "_cell", F.coalesce(before, F.lit(0)).alias("_before"))
    in_cell = Window.partitionBy("_source", "_cell").orderBy("_hash", "_id", "_whole")
    ranked = (
        rows.withColumn("_at", F.row_number().over(in_cell) - 1)
        .join(sizes, ["_source", "_cell"])
        .withColumn("_rank", F.col("_before") + F.col("_at"))
        .withColumn("_block", F.floor(F.col("_rank") / block))
    )

    # One row per phase and source: a few numbers and the source's slots of a frame.
    plan = []
    for phase in phases:
        for s, high in phase.until.items():
            if high > phase.done.get(s, 0) and s in phase.slots:
                plan.append((s, phase.done[s], high, phase.first, len(phase.order), phase.slots[s]))
    table = spark.createDataFrame(
        plan, "_source STRING, _low BIGINT, _high BIGINT, _first BIGINT, _frame BIGINT, _slots ARRAY<INT>"
    )
    placed = ranked.join(F.broadcast(table), "_source").where("_block >= _low and _block < _high")
    number = F.col("_block") - F.col("_low")
    slot = F.col("_first") + F.floor(number / F.size("_slots")) * F.col("_frame") + F.get(
        "_slots", F.pmod(number, F.size("_slots")).cast("int")
    )
    return placed.select(
        *back,
        slot.cast("bigint").alias("mix_slot"),
        F.pmod("_rank", F.lit(block)).cast("int").alias("mix_place"),
    )
