"""Near-duplicate vectors by sign hashing in several tables.

The signs of a vector's products with a table's random hyperplanes are its code
there. Vectors of one label that share a code in some table meet in a bucket.
What travels once per table is an id and a sketch, the first 128 signs: pairs
whose sketches differ in more places than a pair at the threshold ever does, but
for a chance below one in a million, go no further, nor does a pair that the
sketches show to have met in an earlier table. Only the vectors that are left in
a bucket are fetched, and compared by cosine, in double precision. The number of
hyperplanes grows with the largest label, so that chance meetings stay few, and
the number of tables with it, so that a pair at the threshold is missed with a
chance below one in a million.

Equal vectors of a label become one node with a count. A bucket with many nodes
is cut into blocks and compared block by block, in tasks of bounded size; what
leaves a task are the number of links and one edge per node, never the pairs. A
pair that meets in several tables counts in the first of them.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelode.llm.components import components
from pagelode.llm.passing import passed
from pagelode.llm.scratch import Scratch

BLOCK = 512
SKETCH = 128
_MISSED = 1e-6
_CROWD = 512
_ROWS = 50_000


def table_sizes(rows: int, threshold: float) -> tuple[int, int]:
    """(hyperplanes per table, tables) for a label of so many rows."""
    bits = min(30, max(4, math.ceil(math.log2(max(rows, 1) / _CROWD))))
    same = 1 - math.acos(threshold) / math.pi
    return bits, max(1, math.ceil(math.log(_MISSED) / math.log1p(-(same**bits))))


@cache
def sketch_limit(threshold: float) -> int:
    """The most places in which the sketches of a pair at the threshold differ."""
    p = math.acos(threshold) / math.pi
    tail, limit = 1.0, -1
    while tail > _MISSED and limit < SKETCH:
        limit += 1
        tail -= math.comb(SKETCH, limit) * p**limit * (1 - p) ** (SKETCH - limit)
    return limit


@cache
def _planes(size: int, count: int) -> np.ndarray:
    return np.random.default_rng([11, size]).standard_normal((size, count))


def unit_vectors(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision, of rows that are not zero."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _by_length(column: pa.Array):
    """(places, unit vectors) of each length among the lists of a column."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        at = np.nonzero(sizes == size)[0]
        values = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(float)
        yield at, unit_vectors(values.reshape(len(at), size))


def _coded(groups: DataFrame, bits: int, tables: int) -> DataFrame:
    """Adds the sketch as two integers, ``s0`` and ``s1``, and ``codes``, one code per table."""
    count = max(bits * tables, SKETCH)

    def run(batches):
        for batch in batches:
            codes = np.zeros((batch.num_rows, tables), np.int32)
            sketch = np.zeros((batch.num_rows, 2), np.int64)
            for at, unit in _by_length(batch.column("embedding")):
                signs = unit @ _planes(unit.shape[1], count) > 0
                sketch[at] = np.packbits(signs[:, :SKETCH], axis=1, bitorder="little").view("<i8")
                told = signs[:, : bits * tables].reshape(len(at), tables, bits)
                codes[at] = (told << np.arange(bits)).sum(axis=2)
            ends = pa.array(np.arange(batch.num_rows + 1) * tables, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    *(pa.array(np.ascontiguousarray(s)) for s in sketch.T),
                    pa.ListArray.from_arrays(ends, pa.array(codes.ravel())),
                ],
                names=[*batch.schema.names, "s0", "s1", "codes"],
            )

    return groups.mapInArrow(run, passed(groups.schema, "s0 BIGINT, s1 BIGINT, codes ARRAY<INT>"))


def _cells(batches):
    """One table per cell of rows that come sorted by cell."""
    held, held_key = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in ("bucket", "low", "high")])
        starts = [0, *(np.nonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0))[0] + 1).tolist(), batch.num_rows]
        for start, end in zip(starts, starts[1:], strict=False):
            piece, key = batch.slice(start, end - start), keys[:, start].tolist()
            if key == held_key:
                held.append(piece)
                continue
            if held:
                yield pa.Table.from_batches(held)
            held, held_key = [piece], key
    if held:
        yield pa.Table.from_batches(held)


def _numbers(cell: pa.Table, column: str) -> np.ndarray:
    return cell.column(column).to_numpy()


def _across(pairs: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Of a matrix of pairs, those of different nodes, and of different blocks if there are two."""
    if side.min() != side.max():
        return pairs & (side[:, None] != side[None, :])
    np.fill_diagonal(pairs, False)
    return pairs


def _sketch_pairs(cell: pa.Table, bits: int, limit: int) -> np.ndarray:
    """Which nodes of a cell are to be compared with another one there."""
    s0, s1 = (_numbers(cell, c).view("u8") for c in ("s0", "s1"))
    apart = np.bitwise_count(s0[:, None] ^ s0[None, :]) + np.bitwise_count(s1[:, None] ^ s1[None, :])
    a, b = np.nonzero(_across(apart <= limit, _numbers(cell, "side")))
    x0, x1 = s0[a] ^ s0[b], s1[a] ^ s1[b]
    fresh = np.ones(len(a), bool)
    for t in range(min(cell.column("table")[0].as_py(), SKETCH // bits)):
        mask = ((1 << bits) - 1) << (t * bits)
        m0, m1 = np.uint64(mask & (2**64 - 1)), np.uint64(mask >> 64)
        fresh &= ((x0 & m0) | (x1 & m1)) != 0
    return np.unique(a[fresh])


def _candidates(cells: DataFrame, bits: int, threshold: float) -> DataFrame:
    """The rows of each cell that its sketches leave to be compared."""
    limit = sketch_limit(threshold)
    columns = ["bucket", "low", "high", "table", "side", "key"]
    schema = "bucket BIGINT, low INT, high INT, table INT, side INT, key BIGINT"

    def run(batches):
        held, rows = [], 0
        for cell in _cells(batches):
            if cell.num_rows < 2:
                continue
            at = _sketch_pairs(cell, bits, limit)
            if len(at):
                held.append(cell.select(columns).take(pa.array(at)))
                rows += len(at)
            if rows >= _ROWS:
                yield from pa.concat_tables(held).combine_chunks().to_batches()
                held, rows = [], 0
        if held:
            yield from pa.concat_tables(held).combine_chunks().to_batches()

    return cells.mapInArrow(run, schema)


def _block_links(cell: pa.Table, threshold: float):
    """(nodes, links, roots) of every node of one cell that has a link in it."""
    nodes, copies = _numbers(cell, "node"), _numbers(cell, "copies")
    table = cell.column("table")[0].as_py()
    codes = cell.column("codes").combine_chunks().flatten().to_numpy().reshape(len(nodes), -1)
    marks = cell.column("mark").combine_chunks().dictionary_encode().indices.to_numpy()
    near = np.zeros((len(nodes), len(nodes)), bool)
    for at, unit in _by_length(cell.column("embedding").combine_chunks()):
        near[np.ix_(at, at)] = unit @ unit.T >= threshold
    near &= marks[:, None] == marks[None, :]
    near = _across(near, _numbers(cell, "side"))
    a, b = np.nonzero(near)
    if not len(a):
        return None
    met_before = np.zeros(len(a), bool)
    for t in range(table):
        met_before |= codes[a, t] == codes[b, t]
    links = np.bincount(a[~met_before], weights=copies[b[~met_before]], minlength=len(nodes)).astype(np.int64)
    # The smallest place that is reachable within the cell.
    root = np.arange(len(nodes))
    while True:
        least = root.copy()
        np.minimum.at(least, a, root[b])
        least = least[least]
        if (least == root).all():
            break
        root = least
    some = near.any(axis=1)
    return nodes[some], links[some], nodes[root[some]]


def _cell_links(cells: DataFrame, threshold: float) -> DataFrame:
    """Links within each cell, by exact cosine."""

    def batch_of(found):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], names=["a", "links", "b"]
        )

    def run(batches):
        held, rows = [], 0
        for cell in _cells(batches):
            found = _block_links(cell, threshold) if cell.num_rows > 1 else None
            if found:
                held.append(found)
                rows += len(found[0])
            if rows >= _ROWS:
                yield batch_of(held)
                held, rows = [], 0
        if held:
            yield batch_of(held)

    return cells.mapInArrow(run, "a BIGINT, links BIGINT, b BIGINT")


def _in_cells(rows: DataFrame) -> DataFrame:
    return rows.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")


def near_vectors(
    embeddings: DataFrame,
    threshold: float = 0.93,
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scratch: Scratch | None = None,
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row.

    Rows link when their labels are equal and not null, their vectors equally
    long and the cosine reaches ``threshold``. A vector that is null, empty,
    zero or has a null or non-finite component links with nothing, like a row
    with a null id, which is kept with a null component. Rows that repeat an id
    are one node that has the links of all of them. Only the three columns are
    read; an empty table gives an empty result. Labels are compared as strings.
    """
    spark = embeddings.sparkSession
    scratch = scratch or Scratch(spark, "vectors")
    good = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    ) & F.exists(vector, lambda x: x != 0)
    rows = embeddings.select(
        embeddings[vec_id].cast("bigint").alias("vec_id"),
        embeddings[vector].alias("embedding"),
        embeddings[label].cast("string").alias("mark"),
        F.xxhash64(vector).alias("h1"),
        F.xxhash64(F.lit("again"), F.col(vector)).alias("h2"),
        (F.col(label).isNotNull() & F.col(vec_id).isNotNull() & F.coalesce(good, F.lit(False))).alias("valid"),
    )
    largest = embeddings.where(F.col(label).isNotNull()).groupBy(F.col(label)).count().agg(F.max("count")).first()[0]
    bits, tables = table_sizes(largest or 0, threshold)
    same = ["mark", "h1", "h2"]
    groups = (
        rows.where("valid")
        .groupBy(same)
        .agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("embedding").alias("embedding"))
        # Of use once written: several nodes may have the same smallest id.
        .withColumn("key", F.monotonically_increasing_id())
    )
    nodes = scratch.keep(_coded(groups, bits, tables), "nodes")

    # A bucket is a label, a length, a table and the code there.
    in_table = nodes.select(
        "key", "s0", "s1", "mark", F.size("embedding").alias("size"), F.posexplode("codes").alias("table", "code")
    ).select("key", "s0", "s1", "table", F.xxhash64("mark", "size", "table", "code").alias("bucket"))
    large = in_table.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
    # Written, so that its size is known when the join is planned.
    large = scratch.keep(large.select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "large")
    blocks = F.coalesce("blocks", F.lit(1))
    placed = in_table.join(large, "bucket", "left").select(
        "bucket", "key", "s0", "s1", "table", blocks.alias("blocks"), F.pmod(F.xxhash64("key"), blocks).cast("int").alias("side")
    )
    cells = placed.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "bucket",
        F.least("side", "other").alias("low"),
        F.greatest("side", "other").alias("high"),
        "table",
        "side",
        "key",
        "s0",
        "s1",
    )
    told = scratch.keep(_candidates(_in_cells(cells), bits, threshold), "candidates")
    fetched = told.join(nodes.select("key", "node", "copies", "mark", "embedding", "codes"), "key")
    found = scratch.keep(_cell_links(_in_cells(fetched.drop("key")), threshold), "links")

    counts = found.groupBy("a").agg(F.sum("links").alias("others"))
    member = (
        rows.where("valid")
        .select("vec_id", *same)
        .join(nodes.select(*same, "node", "copies"), same)
        .select("vec_id", "node", "copies")
    )
    copies = member.where("vec_id <> node").select(F.col("node").alias("a"), F.col("vec_id").alias("b"))
    edges = found.where("a <> b").select("a", "b").union(copies)
    joined = scratch.keep(components(edges, "a", "b", scratch, "stars"), "joined")
    scratch.drop("large", "candidates")
    linked = (
        member.join(counts, member.node == counts.a, "left")
        .groupBy("vec_id")
        .agg(F.sum(F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    return (
        embeddings.select(embeddings[vec_id].cast("bigint").alias("vec_id"))
        .join(linked, "vec_id", "left")
        .join(joined.select(F.col("node").alias("vec_id"), "component"), "vec_id", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)))
    )
