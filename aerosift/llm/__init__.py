"""Training-data operators: dedup, scoring, packing, tokenising, PII, search.

Nothing else in the library imports this subpackage. Each module holds one
operator; ``queries`` registers a thin query per operator over the driver's
tables, and the repository's ``corpus_pipeline.py`` chains five of them.
"""
