"""Operators for training-data pipelines (``llm``).

Each module holds one operator with its general interface and the thin
``opN_*`` query that applies it to its whole table; :mod:`aurum.llm.catalog`
lists the queries and their SQL.  Nothing outside this folder (and
``corpus_pipeline.py``) imports it, except the guard in ``__spark_entry__``.
"""
