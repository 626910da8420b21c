"""Word suggestions for the terms of queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagelode.operators import match

# Fixed value: suggestions per term.
PER_TERM = 6


def suggest(
    queries: DataFrame,
    grams: DataFrame,
    per_term: int = PER_TERM,
    counts: DataFrame | None = None,
) -> DataFrame:
    """(query_id, term_pos, term, pos, word): shortest matching words per term.

    A query is split at every single space; an empty term matches nothing, and
    a repeated term repeats its words. Each term is matched on its own.
    """
    terms = queries.select(
        "query_id", F.posexplode(F.split("query", " ")).alias("term_pos", "term")
    )
    asked = terms.select(F.col("term").alias("_asked")).distinct()
    matched = match.match_queries(asked, grams, ["_asked"], "_asked", counts)
    # Ranked per distinct term; the map tasks cut to ``per_term`` rows each.
    first = Window.partitionBy("_asked").orderBy(F.length("word"), "word")
    top = (
        matched.withColumn("pos", F.row_number().over(first))
        .where(F.col("pos") <= per_term)
        .withColumnRenamed("_asked", "term")
    )
    return terms.join(top, "term").select("query_id", "term_pos", "term", "pos", "word")
