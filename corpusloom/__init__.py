"""Corpus operators on PySpark: cleaning, filtering, deduplication, mixing, retrieval and scoring."""
