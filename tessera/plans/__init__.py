"""Registered queries over the test tables, each with its DuckDB oracle text.

A plan module binds library operators to concrete tables; ``registry``
gathers them for ``__spark_entry__``.
"""
