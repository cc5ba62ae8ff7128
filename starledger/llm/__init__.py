"""Operators of a training-data pipeline, each a Spark job of its own.

``queries()`` and ``oracle_sql()`` in :mod:`starledger.llm.queries`
register one thin query per operator; nothing outside this subpackage
imports it except ``__spark_entry__.py`` (guarded) and
``corpus_pipeline.py``.
"""
