"""Setting strings as columns: durations and ``;`` lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds per unit letter; any other letter counts as zero.
UNIT_SECONDS = {
    "s": 1,
    "m": 60,
    "h": 3600,
    "d": 86400,
    "w": 604800,
    "M": 2592000,
    "y": 31536000,
}


def duration_seconds(text: Column) -> Column:
    """``7d`` -> 604800. The last character is the unit, the rest a whole number."""
    unit = F.right(text, F.lit(1))
    factor = F.lit(0)
    for letter, seconds in UNIT_SECONDS.items():
        factor = F.when(unit == letter, F.lit(seconds)).otherwise(factor)
    amount = F.left(text, F.length(text) - 1).cast("bigint")
    return amount * factor.cast("bigint")


def list_items(text: Column) -> Column:
    """``a;b;;c`` -> [a, b, c]; blank items go, the others keep their spaces."""
    return F.filter(F.split(text, ";"), lambda item: F.trim(item) != "")
