"""Columns that an operator hands through, and the ones it adds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


def passed(kept: StructType, added: str) -> StructType:
    """The schema of kept columns, whatever their names, followed by ``added`` in DDL."""
    return StructType([*kept.fields, *StructType.fromDDL(added).fields])


def read_once(documents: DataFrame, keep: tuple[str, ...], text: str) -> tuple[DataFrame, int, int]:
    """The kept columns with the text among or behind them, its place, and how many are kept.

    A text that is kept anyway is not sent a second time.
    """
    if text in keep:
        return documents.select(*keep), keep.index(text), len(keep)
    return documents.select(*keep, documents[text].alias("_text")), len(keep), len(keep)
