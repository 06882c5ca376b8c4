"""DataFrame operators: joins, relational, keywords, completion, statistics,
keys, catalog, statement set. Each takes and returns DataFrames."""
