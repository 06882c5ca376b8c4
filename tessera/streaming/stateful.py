"""Operators with state of their own, by ``transformWithStateInPandas``.

* ``late_rows_stream`` (D4): Spark's watermark is one value per query and moves
  between micro-batches; the declared-table engine's moves with every row of a
  key. This operator keeps, per key, the latest event time seen so far and flags
  each arriving row that is at or behind ``latest - delay``. A micro-batch's rows
  of a key come as an iterator of frames and are never joined into one: what is
  kept of them is the order of their arrivals, two numbers a row.
* ``retractions`` (D7): keeps one row of sums per key, and emits a changed row as
  its old value with sign -1 and its new value with sign +1.

State lives in the RocksDB store, which these operators need (``with_state_store``
sets it for the session while a query starts). A key's state is dropped after
``idle`` without rows, by the store's time to live.
"""

from __future__ import annotations

import contextlib
import datetime as dt
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_NEVER = np.iinfo(np.int64).min


@contextlib.contextmanager
def with_state_store(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside keep their state in RocksDB."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


LATE_SCHEMA = ("key long, event_id long, arrival long, ts_us long, watermark_us long, late boolean")


class _Lateness(StatefulProcessor):
    def __init__(self, delay_us: int, idle_ms: int | None):
        self.delay_us, self.idle_ms = delay_us, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", "us bigint", self.idle_ms)

    def handleInputRows(self, key, rows, timer_values):
        seen = self.latest.get()[0] if self.latest.exists() else _NEVER
        frames = [(f["event_id"].to_numpy(np.int64), f["arrival"].to_numpy(np.int64), f["ts_us"].to_numpy(np.int64))
                  for f in rows]
        # Running maximum in order of arrival: one pass over the two numbers of each row.
        ids, arrival, ts = (np.concatenate(c) for c in zip(*frames, strict=True))
        order = np.argsort(arrival, kind="stable")
        prior = np.maximum(np.append(_NEVER, np.maximum.accumulate(ts[order])[:-1]), seen)
        self.latest.update((int(max(seen, ts.max())),))
        known = prior != _NEVER
        watermark = np.where(known, prior, self.delay_us) - self.delay_us  # no wrap-around where unknown
        shown = pd.array(watermark, dtype="Int64")
        shown[~known] = pd.NA
        yield pd.DataFrame({"key": np.full(len(order), key[0], np.int64), "event_id": ids[order],
                            "arrival": arrival[order], "ts_us": ts[order], "watermark_us": shown,
                            "late": known & (ts[order] <= watermark)})

    def close(self) -> None:
        pass


def late_rows_stream(df: DataFrame, key: str, event_id: str, arrival: str, ts: str,
                     delay_seconds: int, idle: dt.timedelta | None = None) -> DataFrame:
    """Streaming rows (key, event_id, arrival, ts_us, watermark_us, late); ``ts`` is a
    timestamp column, ``arrival`` the order rows come in. A key without rows for
    ``idle`` (processing time) is forgotten; such a query runs until it is stopped, since
    state may always expire."""
    src = df.select(F.col(key).cast("long").alias("key"), F.col(event_id).cast("long").alias("event_id"),
                    F.col(arrival).cast("long").alias("arrival"),
                    F.unix_micros(F.col(ts).cast("timestamp")).alias("ts_us"))
    idle_ms = None if idle is None else int(idle.total_seconds() * 1000)
    return src.groupBy("key").transformWithStateInPandas(
        _Lateness(delay_seconds * 1_000_000, idle_ms), LATE_SCHEMA, "append",
        "none" if idle_ms is None else "processingTime")


class _Retractions(StatefulProcessor):
    """State: the key's group and sums; input frames have columns g, c and d."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.row = handle.getValueState("row", "g string, c bigint, d bigint")

    def handleInputRows(self, key, rows, timer_values):
        old = self.row.get() if self.row.exists() else None
        g, c, d = old if old is not None else (None, 0, 0)
        for frame in rows:
            c += int(frame["c"].sum())
            d += int(frame["d"].sum())
            own = frame["g"].dropna()
            if len(own):
                g = own.max() if g is None else max(g, own.max())
        new = (g, c, d)
        if old is not None and tuple(old) == new:
            return
        self.row.update(new)
        signed = ([(-1, *old)] if old is not None else []) + [(1, *new)]
        yield pd.DataFrame({"sign": [s for s, *_ in signed], "g": [r[1] for r in signed],
                            "c": [s * r for s, _, r, _ in signed], "d": [s * r for s, _, _, r in signed]})

    def close(self) -> None:
        pass


def retractions(df: DataFrame, keys: list[str]) -> DataFrame:
    """Per key of ``df`` (keys, g string, c bigint, d bigint) the running sums of c and d
    and the greatest g, as changes (sign, g, c, d): a changed row is taken back (sign
    -1, its values negated) and given anew (sign +1). Sums over the changes are the
    aggregate of the current rows, also when a key's g changes."""
    return df.groupBy(*keys).transformWithStateInPandas(
        _Retractions(), "sign bigint, g string, c bigint, d bigint", "append", "none")
