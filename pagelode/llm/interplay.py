"""Audit of how filters interact, over every order of applying them.

Each document fails some of the filters: a mask of bits. Masks are counted per
part, so what follows works on cells, at most one per part and mask, whatever
the number of documents. A recursive query walks the orders: from the empty
prefix on, every level extends each prefix by each letter not yet in it, carries
the bits applied so far, joins the cells of the part and emits the counts of
that step. A step depends on its prefix alone, so a full order reads its steps
off its prefixes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagelode.llm.scratch import Scratch
from pagelode.operators.extract import settled

_GAP = r"[ \t-\r]+"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Parts of one recursive query: Spark bounds the rows of a recursion.
_PARTS = 1_000


@dataclass(frozen=True)
class Filter:
    """One letter, and the condition under which a text fails, on the text and its words."""

    letter: str
    fails: Callable[[Column, Column], Column]


FILTERS = (
    Filter("A", lambda text, words: F.size(words) < 200),
    Filter("B", lambda text, words: 100 * F.size(F.array_distinct(words)) < 50 * F.size(words)),
    Filter(
        "C",
        lambda text, words: 100 * (F.length(text) - F.length(F.translate(text, _CAPITALS, "")))
        > 3 * F.length(text),
    ),
    Filter("D", lambda text, words: text.rlike("[#$%&*|]")),
)
COPIES = "E"


def text_failures(
    documents: DataFrame,
    filters: Sequence[Filter] = FILTERS,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    part: str = "lang",
) -> DataFrame:
    """doc_id, part, digest of the text and ``bits``, one per filter it fails, of every row.

    Bit i belongs to the i-th filter. A null text is an empty one, a null part
    the empty string. Words are maximal runs of characters other than the space
    and 0x09 to 0x0D. No shuffle, no Python.
    """
    rows = documents.select(
        documents[doc_id].cast("bigint").alias("doc_id"),
        F.coalesce(documents[part].cast("string"), F.lit("")).alias("part"),
        F.coalesce(documents[text], F.lit("")).alias("text"),
    )
    listed = settled(rows.withColumn("words", F.filter(F.split("text", _GAP, -1), lambda w: w != "")))
    bits = F.lit(0)
    for at, one in enumerate(filters):
        bits = bits + F.when(one.fails(F.col("text"), F.col("words")), F.lit(1 << at)).otherwise(F.lit(0))
    return listed.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), bits.alias("bits"))


def _marks(labels: DataFrame) -> DataFrame:
    """(doc_id, good, toxic) once per labelled document; repeated labels count as any of them."""

    def any_one(column: str) -> Column:
        return F.max(F.when(F.col(column) == 1, 1).otherwise(0))

    return (
        labels.where("doc_id is not null")
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(any_one("quality").alias("good"), any_one("toxic").alias("toxic"))
    )


def mask_cells(judged: DataFrame, labels: DataFrame, copy_bit: int) -> DataFrame:
    """(part, bits, n, good, toxic): the documents of every mask, copies marked.

    A document whose text another one with a smaller doc_id holds, in whatever
    part, gets ``copy_bit``. Copies are counted on the map side per text before
    they meet, so a text on a third of all rows is a few rows there. Rows that
    repeat a doc_id are none of each other's copies; a row without an id has no
    label, is no copy and makes none.
    """
    unmarked = [F.lit(0).alias("good"), F.lit(0).alias("toxic")]
    known = judged.where("doc_id is not null").join(_marks(labels), "doc_id", "left")
    totals = [F.sum(c).alias(c) for c in ("n", "good", "toxic")]
    # Rows of one document and text, then those of one text and part: all of
    # them, and those of the smallest id among them.
    each = known.groupBy("doc_id", "part", "digest", "bits").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )
    texts = each.groupBy("digest", "part", "bits").agg(
        F.min(F.struct("doc_id", "n", "good", "toxic")).alias("first"), *totals
    )
    # One row per part that holds the text.
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    placed = texts.withColumn("original", F.col("first.doc_id") == least)
    split = placed.select(
        "part",
        F.inline(
            F.array(
                F.struct(
                    "bits",
                    *[
                        F.when(F.col("original"), F.col(f"first.{c}")).otherwise(F.lit(0)).alias(c)
                        for c in ("n", "good", "toxic")
                    ],
                ),
                F.struct(
                    (F.col("bits") + F.lit(copy_bit)).alias("bits"),
                    *[
                        (F.col(c) - F.when(F.col("original"), F.col(f"first.{c}")).otherwise(F.lit(0))).alias(c)
                        for c in ("n", "good", "toxic")
                    ],
                ),
            )
        ),
    )
    nameless = judged.where("doc_id is null").select("part", "bits", F.lit(1).alias("n"), *unmarked)
    return split.where("n > 0").union(nameless).groupBy("part", "bits").agg(*totals)


def _walk(cells: DataFrame, letters: str) -> DataFrame:
    """Every prefix of every order with the counts of its last step, per part.

    ``cells`` holds one row per part: (part, cells), with the counts per mask.
    """

    def total(field: str, condition: str) -> str:
        return f"aggregate(c.cells, 0L, (s, x) -> s + if({condition}, x.{field}, 0L))"

    listed = ", ".join(f"named_struct('letter', '{c}', 'bit', {1 << i})" for i, c in enumerate(letters))
    now = "(x.bits & w.applied) = 0 and (x.bits & l.bit) <> 0"
    return cells.sparkSession.sql(
        f"""
        with recursive walk(part, prefix, applied, step, filter, kept, removed, redundant,
            unique_fails, good_lost, toxic_lost) as (
          select part, '', 0, 0, '', 0L, 0L, 0L, 0L, 0L, 0L from {{cells}}
          union all
          select w.part, concat(w.prefix, l.letter), w.applied | l.bit, w.step + 1, l.letter,
            {total('n', '(x.bits & (w.applied | l.bit)) = 0')},
            {total('n', now)},
            {total('n', '(x.bits & w.applied) <> 0 and (x.bits & l.bit) <> 0')},
            {total('n', 'x.bits = l.bit')},
            {total('good', now)},
            {total('toxic', now)}
          from walk w join {{cells}} c on c.part = w.part
          lateral view explode(filter(array({listed}), x -> (w.applied & x.bit) = 0)) e as l
          where w.step < {len(letters)})
        select * from walk where step > 0""",
        cells=cells,
    )


def audit_orders(cells: DataFrame, letters: str, scratch: Scratch) -> DataFrame:
    """Per part, order of ``letters`` and step: the filter and its counts in that place.

    ``cells`` is (part, bits, n, good, toxic). ``kept`` are the documents left
    after the step, ``removed`` those it takes, ``redundant`` those that fail
    its filter but went before, ``unique_fails`` those that fail no other one,
    ``good_lost`` and ``toxic_lost`` the removed ones with that label, and
    ``shapley`` what the filter removes, summed over all orders. Every order of
    every part has its rows, with zeros; without cells the result is empty.
    """
    told = F.struct("bits", "n", "good", "toxic")
    wide = scratch.keep(cells.groupBy("part").agg(F.array_sort(F.collect_list(told)).alias("cells")), "cells")
    blocks = 1 + wide.count() // _PARTS
    walk = None
    for block in range(blocks):
        some = _walk(wide.where(F.pmod(F.xxhash64("part"), F.lit(blocks)) == block), letters)
        walk = some if walk is None else walk.union(some)
    walk = scratch.keep(walk, "walk")
    steps = walk.where(f"step = {len(letters)}").select(
        "part",
        F.col("prefix").alias("filter_order"),
        F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("at"),
    )
    steps = steps.withColumn("prefix", F.expr("left(filter_order, at)"))
    every = steps.join(walk, ["part", "prefix"])
    shapley = F.sum("removed").over(Window.partitionBy("part", "filter"))
    counts = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
    return every.select("part", "filter_order", "step", "filter", *counts, shapley.alias("shapley"))


def audit_filters(
    documents: DataFrame,
    labels: DataFrame,
    filters: Sequence[Filter] = FILTERS,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    part: str = "lang",
    scratch: Scratch | None = None,
) -> DataFrame:
    """``audit_orders`` of the text filters and, as last letter, of exact copies.

    Only doc_id, text and part are read of ``documents``, whatever other columns
    are called, and doc_id, quality and toxic of ``labels``. Repeated rows are
    counted each; labels of documents that are not there count nothing. An empty
    table gives an empty result.
    """
    scratch = scratch or Scratch(documents.sparkSession, "interplay")
    judged = scratch.keep(text_failures(documents, filters, doc_id=doc_id, text=text, part=part), "judged")
    letters = "".join(f.letter for f in filters) + COPIES
    cells = scratch.keep(mask_cells(judged, labels, 1 << len(filters)), "masks")
    found = audit_orders(cells, letters, scratch)
    scratch.drop("judged", "masks", "cells")
    return found
