"""Set-based upkeep of the base tables.

Every function returns rows; the caller appends or writes them. Key sets are
joined, so the size of a change is not bounded by the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelode.functions import urls


def first_by_key(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """One row per key, the first by ``order``; combined on the map side."""
    rest = [c for c in rows.columns if c not in key]
    return (
        rows.groupBy(*key)
        .agg(F.min_by(F.struct(*rest), F.col(order)).alias("_first"))
        .select(*key, *[F.col(f"_first.{c}").alias(c) for c in rest])
        .select(*rows.columns)
    )


def insert_ignore(
    table: DataFrame,
    rows: DataFrame,
    key: list[str],
    order: str,
    parents: list[tuple[DataFrame, str, str]] = (),
    max_len: int | None = None,
) -> DataFrame:
    """The rows an insert adds: first of each key, key not stored, parent there.

    ``order`` is the column with the input position. ``parents`` lists
    (parent table, parent column, column of ``rows``). ``max_len`` cuts text
    keys to a number of characters, as a column of limited width does; by
    default keys are kept whole.
    """
    if max_len is not None:
        texts = [c for c, kind in rows.dtypes if c in key and kind == "string"]
        rows = rows.withColumns({c: F.left(c, F.lit(max_len)) for c in texts})
    fresh = first_by_key(rows, key, order).join(table.select(*key), key, "left_anti")
    for parent, parent_column, column in parents:
        ids = parent.select(F.col(parent_column).alias(column)).distinct()
        fresh = fresh.join(ids, column, "left_semi")
    return fresh.select(*rows.columns)


def upsert_keep_first(table: DataFrame, rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """The table after an upsert under which a stored key keeps its old row."""
    added = insert_ignore(table, rows, key, order)
    return table.unionByName(added.select(*table.columns))


def upsert_replace(table: DataFrame, rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """The table after an upsert under which the last input row of a key wins."""
    rest = [c for c in rows.columns if c not in key]
    last = (
        rows.groupBy(*key)
        .agg(F.max_by(F.struct(*rest), F.col(order)).alias("_last"))
        .select(*key, *[F.col(f"_last.{c}").alias(c) for c in rest])
    )
    kept = table.join(last.select(*key), key, "left_anti")
    return kept.unionByName(last.select(*table.columns))


def resolve_ids(rows: DataFrame, table: DataFrame, key: list[str], ids: list[str]) -> DataFrame:
    """Stored ids of input rows: (pos, key, ids), to be ordered by ``pos``.

    The whole natural key is joined, so neither repeats nor equal halves of a
    composite key shift or widen the result.
    """
    stored = table.select(*key, *[c for c in ids if c not in key])
    return rows.select("pos", *key).join(stored, key)


def touch_indexed(link: DataFrame, touched: DataFrame, now: Column) -> DataFrame:
    """``link`` with the index time of the touched ids moved to ``now``."""
    marks = touched.select("link_id").distinct().withColumn("_touched", F.lit(True))
    return (
        link.join(marks, "link_id", "left")
        .withColumn("indexed_at", F.when(F.col("_touched"), now).otherwise(F.col("indexed_at")))
        .select(*link.columns)
    )


def delete_by_key(
    table: DataFrame,
    doomed: DataFrame,
    key: list[str],
    references: list[tuple[DataFrame, str]] = (),
) -> DataFrame:
    """``table`` without the given keys; a key still referenced stays.

    ``references`` lists (referencing table, its column) for a one-column key.
    """
    keys = doomed.select(*key).distinct()
    for child, column in references:
        used = child.select(F.col(column).alias(key[0])).distinct()
        keys = keys.join(used, key[0], "left_anti")
    return table.join(keys, key, "left_anti").select(*table.columns)


def seed_if_empty(table: DataFrame, defaults: DataFrame) -> DataFrame:
    """``table``, or the default rows when it has none."""
    return table.unionByName(defaults.where(~table.limit(1).exists()))


def valid_start_urls(entered: DataFrame) -> DataFrame:
    """Entered URLs that may be stored as a start URL."""
    return entered.where(urls.valid_url(F.col("url")))
