"""Pagelode: page indexing and ranked search as Spark DataFrame operators."""
