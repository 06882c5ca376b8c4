"""Scans and sinks: parquet test tables, JSON events, generated rows, text
corpora, frequency dictionaries, metadata tables, table writers."""
