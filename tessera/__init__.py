"""tessera: metadata-declared tables, streams, statistics and keyword
completion, expressed as Spark DataFrame / SQL jobs."""

__all__ = ["session"]
