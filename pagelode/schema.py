"""Schemas as DDL: the page input, the base tables, the search tables.

Natural keys replace generated ids where one exists: a word is its own key,
and a link keeps the id its source gives it. Counts are BIGINT.
"""

from __future__ import annotations

PAGES = "page_id BIGINT, url STRING, html STRING, content_type STRING, fetched_at TIMESTAMP"

# Base tables; every batch appends its rows.
BASE = {
    "link": "link_id BIGINT, url STRING, language STRING, title STRING, batch_id BIGINT",
    "wordrelation": "word STRING, link_id BIGINT, weight BIGINT, batch_id BIGINT",
    "backlinks": "link_id_from BIGINT, url_to STRING, batch_id BIGINT",
    "touched": "link_id BIGINT, indexed_at TIMESTAMP, batch_id BIGINT",
}

# Search tables, built from the base tables.
SEARCH = {
    "links": (
        "link_id BIGINT, url STRING, language STRING, title STRING, page_length BIGINT, "
        "inlinks BIGINT, bucket INT"
    ),
    "postings": (
        "word STRING, link_id BIGINT, weight BIGINT, language STRING, page_length BIGINT, "
        "inlinks BIGINT, url STRING, bucket INT"
    ),
    "words": "word STRING",
    "grams": "gram STRING, word STRING, bucket INT",
    "gram_counts": "gram STRING, words BIGINT",
    "stats": "pairs BIGINT, max_inlinks BIGINT, buckets INT",
}
