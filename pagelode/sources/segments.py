"""Tables kept as segments, which one manifest commits together.

A commit writes one segment: for each table the rows it adds, partitioned by the
hash of a column into a fixed number of buckets. Nothing stored is changed. The
segment counts from the moment a manifest that names it is complete, so a
reader sees all tables before a commit or all after it, and a commit that
failed is not seen. A manifest names every live segment with its row counts.

Reading merges: the segments of a table are united and, by the kind of the
table, summed, reduced to the last row of a key, or rid of deleted keys. A
change looks up stored keys in the buckets of its own keys only.

Segments are merged like the digits of a binary number: as soon as the newest
ones hold as many rows as the one before them, they become one. So a row is
rewritten a number of times that is logarithmic in the number of commits, and
as few segments are live.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pagelode.operators import maintain as ma
from pagelode.operators.search import bucket_of
from pagelode.sources import files

_MANIFEST = "segment INT, folder STRING, batch_id BIGINT, buckets INT, rows MAP<STRING, BIGINT>, facts MAP<STRING, BIGINT>"


@dataclass(frozen=True)
class Table:
    """``kind`` tells how segments add up: ``rows`` (all; keys are unique as they are
    only added when not stored, and may be deleted), ``last`` (the newest row of
    a key), ``sum`` (the other columns per key) or ``set`` (distinct keys)."""

    columns: str
    key: tuple[str, ...]
    placed_by: str
    kind: str = "rows"

    @property
    def names(self) -> list[str]:
        return StructType.fromDDL(self.columns).names

    @property
    def rest(self) -> list[str]:
        return [c for c in self.names if c not in self.key]


@dataclass(frozen=True)
class Segment:
    number: int
    folder: str
    batch_id: int | None
    rows: dict[str, int]
    facts: dict[str, int]

    @property
    def size(self) -> int:
        return sum(self.rows.values())


def _gone(name: str) -> str:
    """The table of deleted keys of a table."""
    return f"{name}_gone"


@dataclass(frozen=True)
class Snapshot:
    """The tables as of one manifest; later commits do not change it."""

    store: SegmentStore
    version: int
    segments: tuple[Segment, ...]

    def scan(self, name: str, buckets: Iterable[int] | None = None) -> DataFrame:
        """All stored rows with ``bucket`` and ``segment``, of some buckets only if given."""
        table, spark = self.store.tables[name], self.store.spark
        columns = f"{table.columns}, bucket INT"
        parts = [
            spark.read.schema(columns)
            .parquet(f"{self.store.path}/data/{s.folder}/{name}")
            .withColumn("segment", F.lit(s.number))
            for s in self.segments
            if s.rows.get(name)
        ]
        if not parts:
            return spark.createDataFrame([], f"{columns}, segment INT")
        found = reduce(DataFrame.union, parts)
        return found if buckets is None else found.where(F.col("bucket").isin(sorted(buckets)))

    def rows(self, name: str, buckets: Iterable[int] | None = None) -> DataFrame:
        """The table as its segments add up, with ``bucket``."""
        table = self.store.tables[name]
        found = self.scan(name, buckets)
        if table.kind == "last":
            found = (
                found.groupBy(*table.key, "bucket")
                .agg(F.max_by(F.struct(*table.rest), "segment").alias("_last"))
                .select(*table.key, "bucket", *[F.col(f"_last.{c}").alias(c) for c in table.rest])
            )
        elif table.kind == "sum":
            found = found.groupBy(*table.key, "bucket").agg(*[F.sum(c).alias(c) for c in table.rest])
        elif table.kind == "set":
            found = found.select(*table.names, "bucket").distinct()
        elif self.count(_gone(name)):
            gone = self.scan(_gone(name), buckets).groupBy(*table.key).agg(F.max("segment").alias("_gone"))
            gone = gone.select(*[F.col(c).alias(f"_{c}") for c in table.key], "_gone")
            same = [F.col(c) == F.col(f"_{c}") for c in table.key]
            found = found.join(gone, [*same, F.col("segment") < F.col("_gone")], "left_anti")
        return found.select(*table.names, "bucket")

    def at(self, name: str, keys: DataFrame, column: str) -> DataFrame:
        """``rows`` of the buckets that can hold the values of ``column`` in ``keys``."""
        return self.rows(name, self.store.buckets_of(keys, column))

    def count(self, name: str) -> int:
        """Stored rows of a table, deleted or superseded ones included."""
        return sum(s.rows.get(name, 0) for s in self.segments)

    def facts(self, name: str) -> list[int]:
        return [s.facts[name] for s in self.segments if name in s.facts]

    @property
    def last_batch(self) -> int | None:
        return max((s.batch_id for s in self.segments if s.batch_id is not None), default=None)


class SegmentStore:
    """Tables under ``path``, a folder all executors share, for one writer at a time.

    ``buckets`` counts for a new store; an old one keeps its own.
    """

    def __init__(self, spark: SparkSession, path: str, tables: dict[str, Table], buckets: int = 64):
        self.spark = spark
        self.path = path.rstrip("/")
        self.tables = dict(tables)
        for name, table in tables.items():
            if table.kind == "rows":
                fields = [f for f in StructType.fromDDL(table.columns).fields if f.name in table.key]
                ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
                self.tables[_gone(name)] = Table(ddl, table.key, table.placed_by, "set")
        self.buckets = buckets
        version = self._newest()
        if version:
            self.buckets = self._manifest(version)[0].buckets

    # Versions

    def _newest(self) -> int:
        found = [int(n[1:]) for n in files.children(self.spark, f"{self.path}/manifest")]
        whole = (v for v in sorted(found, reverse=True) if files.exists(self.spark, f"{self.path}/manifest/v{v}/_SUCCESS"))
        return next(whole, 0)

    def _manifest(self, version: int) -> list:
        return self.spark.read.schema(_MANIFEST).json(f"{self.path}/manifest/v{version}").collect()

    def snapshot(self) -> Snapshot:
        """The newest complete version; an empty one before the first commit."""
        version = self._newest()
        rows = self._manifest(version) if version else []
        segments = [Segment(r.segment, r.folder, r.batch_id, r.rows or {}, r.facts or {}) for r in rows]
        return Snapshot(self, version, tuple(sorted(segments, key=lambda s: s.number)))

    # Changes

    def buckets_of(self, keys: DataFrame, column: str) -> set[int]:
        """The buckets of a column's values: as many as there are buckets at most."""
        placed = keys.where(F.col(column).isNotNull()).select(bucket_of(F.col(column), self.buckets).alias("b"))
        return {r.b for r in placed.distinct().collect()}

    def commit(
        self,
        base: Snapshot,
        rows: dict[str, DataFrame],
        batch_id: int | None = None,
        facts: dict[str, int] | None = None,
        replaces: Iterable[Segment] = (),
    ) -> Snapshot:
        """Add one segment to ``base``, in place of those it replaces.

        The rows are written first and the manifest last. If another writer has
        committed since ``base`` was read, this raises and changes nothing.
        """
        replaces = tuple(replaces)
        version = base.version + 1
        if self._newest() != base.version:
            raise RuntimeError(f"version {version} is there already: the store has another writer")
        folder = f"v{version}"
        files.remove(self.spark, f"{self.path}/data/{folder}")
        # Tables do not depend on each other, so their jobs may share the cluster.
        with ThreadPoolExecutor(4) as pool:
            list(pool.map(lambda name: self._write(name, rows[name], folder), rows))
        counts = self._counts(rows, folder)
        number = replaces[-1].number if replaces else 1 + max((s.number for s in base.segments), default=0)
        if replaces:
            batch_id = max((s.batch_id for s in replaces if s.batch_id is not None), default=None)
        new = Segment(number, folder, batch_id, {n: c for n, c in counts.items() if c}, facts or {})
        live = [*[s for s in base.segments if s not in replaces], new]
        told = [(s.number, s.folder, s.batch_id, self.buckets, s.rows, s.facts) for s in live]
        listed = self.spark.createDataFrame(told, _MANIFEST).coalesce(1)
        listed.write.mode("overwrite").json(f"{self.path}/manifest/v{version}")
        return Snapshot(self, version, tuple(sorted(live, key=lambda s: s.number)))

    def _counts(self, names: Iterable[str], folder: str) -> dict[str, int]:
        """Rows of each table of a segment, from the files' footers."""
        told = [
            self.spark.read.schema(f"{self.tables[n].columns}, bucket INT")
            .parquet(f"{self.path}/data/{folder}/{n}")
            .agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n"))
            for n in names
        ]
        return {r.name: r.n for r in reduce(DataFrame.union, told).collect()} if told else {}

    def _write(self, name: str, rows: DataFrame, folder: str) -> None:
        table = self.tables[name]
        target = f"{self.path}/data/{folder}/{name}"
        order = ["bucket", table.placed_by, *[c for c in table.key if c != table.placed_by]]
        placed = rows.select(*table.names).withColumn("bucket", bucket_of(F.col(table.placed_by), self.buckets))
        # Rebalancing splits a bucket that holds a hot key and joins small ones.
        (
            placed.hint("rebalance", "bucket")
            .sortWithinPartitions(*order)
            .write.mode("overwrite")
            .partitionBy("bucket")
            .parquet(target)
        )

    def insert_ignore(
        self,
        base: Snapshot,
        name: str,
        rows: DataFrame,
        order: str,
        parents: Iterable[tuple[str, str, str]] = (),
    ) -> DataFrame:
        """The rows an insert adds: first of each key by ``order``, not stored, parents there.

        ``parents`` lists (parent table, its column, column of ``rows``). Stored
        keys and parents are read in the buckets of the rows' own, a parent table
        placed by another column as a whole, but one column of it.
        """
        table = self.tables[name]
        stored = base.at(name, rows, table.placed_by).select(*table.key)
        found = []
        for parent, column, child in parents:
            near = self.tables[parent].placed_by == column
            whole = base.at(parent, rows.select(F.col(child).alias(column)), column) if near else base.rows(parent)
            found.append((whole.select(column), column, child))
        return ma.insert_ignore(stored, rows, list(table.key), order, found).select(*table.names)

    def deletions(
        self, base: Snapshot, name: str, keys: DataFrame, references: Iterable[tuple[str, str]] = ()
    ) -> dict[str, DataFrame]:
        """What a commit adds to delete stored keys; one that is still referenced stays.

        ``references`` lists (referencing table, its column) for a one-column key.
        """
        table = self.tables[name]
        doomed = keys.select(*table.key).distinct()
        for child, column in references:
            near = self.tables[child].placed_by == column
            renamed = doomed.select(F.col(table.key[0]).alias(column))
            whole = base.at(child, renamed, column) if near else base.rows(child)
            used = whole.select(F.col(column).alias(table.key[0])).distinct()
            doomed = doomed.join(used, table.key[0], "left_anti")
        stored = base.at(name, doomed, table.placed_by).select(*table.key)
        return {_gone(name): doomed.join(stored, list(table.key), "left_semi")}

    # Merging

    def due(self, base: Snapshot) -> tuple[Segment, ...]:
        """The newest segments, as far back as each holds no more rows than those after it."""
        taken = list(base.segments[-1:])
        for segment in reversed(base.segments[:-1]):
            if segment.size > sum(s.size for s in taken):
                break
            taken.insert(0, segment)
        return tuple(taken) if len(taken) > 1 else ()

    def merge(
        self,
        base: Snapshot,
        taken: Iterable[Segment],
        own: dict[str, Callable[[Snapshot, bool], DataFrame]] | None = None,
        facts: dict[str, Callable[[list[int]], int]] | None = None,
    ) -> Snapshot:
        """Write neighbouring segments as one, with the number of the last.

        ``own`` gives the merged rows of tables that need more than their kind; a
        function gets the snapshot of the segments taken and whether they are
        the oldest ones. ``facts`` tells how the facts of several segments add up.
        """
        taken = tuple(taken)
        if not taken:
            return base
        at = base.segments.index(taken[0]) if taken[0] in base.segments else 0
        if base.segments[at : at + len(taken)] != taken:
            raise ValueError("the segments are no neighbours in this snapshot")
        part = replace(base, segments=taken)
        oldest = taken[0] == base.segments[0]
        rows = {}
        for name in self.tables:
            if own and name in own:
                rows[name] = own[name](part, oldest)
            elif not (part.count(name) == 0 or (oldest and name.endswith("_gone"))):
                rows[name] = part.rows(name)
        told = {n: how(part.facts(n)) for n, how in (facts or {}).items() if part.facts(n)}
        return self.commit(base, rows, facts=told, replaces=taken)

    def vacuum(self, keep: int = 2) -> None:
        """Remove what none of the ``keep`` newest manifests names; their readers go on."""
        newest = self._newest()
        versions = [int(n[1:]) for n in files.children(self.spark, f"{self.path}/manifest")]
        kept = [v for v in versions if newest - keep < v <= newest]
        named = {r.folder for v in kept for r in self._manifest(v)}
        for folder in files.children(self.spark, f"{self.path}/data"):
            if folder not in named:
                files.remove(self.spark, f"{self.path}/data/{folder}")
        for v in versions:
            if v not in kept:
                files.remove(self.spark, f"{self.path}/manifest/v{v}")

