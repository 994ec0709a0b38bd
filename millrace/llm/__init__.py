"""Operators that a training-data pipeline needs, and their queries.

Nothing outside this folder imports it but ``__spark_entry__`` and ``corpus_pipeline``, which do
without it when it is missing.
"""
