"""Freshness of keys as keyed state: when each was first and last seen, how often, and when it went stale.

A key is fresh from its first sighting until its window has passed without another; a sighting after that begins anew.
episodes() gives these stretches of a table by session windows, which combine in each task before the shuffle.
stream_episodes() gives the same rows of a stream: state holds a key's open stretches, an event-time timer ends each once
the watermark passes its end, and nothing else is rewritten.

Defined results: rows without a time are left out; a null key is a key; a sighting exactly at the end goes on with its stretch;
a stream leaves out rows older than its watermark, and its stretches come when the watermark has passed them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tidewell.operators.quality import stale_days

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY = 86_400_000_000  # microseconds


def window_days(source_type: Column) -> Column:
    """Days that a key of a source type stays fresh."""
    return stale_days(source_type).cast("int")


def episodes(rows: DataFrame, keys: Sequence[str], at: str, days: Column) -> DataFrame:
    """(keys, first_seen, last_seen, n, stale_at) of every stretch in a table of sightings."""
    sighted = rows.where(F.col(at).isNotNull()).select(*keys, F.col(at).alias("_at"), days.alias("_days"))
    window = F.session_window("_at", F.concat(F.col("_days").cast("string"), F.lit(" days")))
    per = sighted.groupBy(*keys, window.alias("_w")).agg(F.min("_at").alias("first_seen"), F.max("_at").alias("last_seen"), F.count("*").alias("n"))
    return per.select(*keys, "first_seen", "last_seen", "n", F.col("_w.end").alias("stale_at"))


def joined(stretches: np.ndarray) -> np.ndarray:
    """Rows (first, last, n, end) in any order, as disjoint stretches: one that begins by another's end goes on with it."""
    out: list[list[int]] = []
    for first, last, n, end in stretches[np.lexsort((stretches[:, 1], stretches[:, 0]))].tolist():
        if out and first <= out[-1][3]:
            out[-1] = [out[-1][0], max(out[-1][1], last), out[-1][2] + n, max(out[-1][3], end)]
        else:
            out.append([first, last, n, end])
    return np.array(out, np.int64).reshape(-1, 4)


class _Freshness(StatefulProcessor):
    """State of a key: its open stretches. They come together from any order of rows, so a key's rows need no sort."""

    def init(self, handle):
        self.handle = handle
        self.open = handle.getListState("open", "first long, last long, n long, end long")

    def _stretches(self) -> np.ndarray:
        return np.array([tuple(r) for r in self.open.get()] if self.open.exists() else [], np.int64).reshape(-1, 4)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: ARG002, N803
        own = self._stretches()
        for chunk in rows:
            if chunk.empty:  # has no columns
                continue
            at = chunk["us"].to_numpy(np.int64)
            seen = np.stack([at, at, np.ones(len(at), np.int64), at + chunk["days"].to_numpy(np.int64) * DAY], 1)
            own = joined(np.concatenate([own, seen]))
        self.open.put([tuple(r) for r in own.tolist()])
        for end in own[:, 3].tolist():
            self.handle.registerTimer(end // 1000 + 1)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: ARG002, N803
        own = self._stretches()
        over = own[:, 3] < timerValues.getCurrentWatermarkInMs() * 1000
        if over.all():
            self.open.clear()
        else:
            self.open.put([tuple(r) for r in own[~over].tolist()])
        out = {"key": pd.Series([key[0]] * int(over.sum()), dtype=object)}
        yield pd.DataFrame(out | dict(zip(("first", "last", "n", "end"), own[over].T, strict=True)))

    def close(self):
        return


def stream_episodes(rows: DataFrame, keys: Sequence[str], at: str, days: Column, late: str = "1 hour") -> DataFrame:
    """episodes() of a stream, each once its end is passed. The session keeps streaming state in RocksDB from now on."""
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    # one key without nulls, which the state's workers don't tell apart; no name begins with an underscore, as rows lose these
    sighted = rows.where(F.col(at).isNotNull()).select(F.to_json(F.struct(*keys)).alias("key"), F.col(at).alias("at"), F.unix_micros(F.col(at).cast("timestamp")).alias("us"), days.cast("long").alias("days")).withWatermark("at", late)
    out = sighted.groupBy("key").transformWithStateInPandas(_Freshness(), "key string, first long, last long, n long, end long", "append", "eventtime")
    own = F.from_json("key", rows.select(*keys).schema).alias("k")
    times = {"first_seen": F.timestamp_micros("first"), "last_seen": F.timestamp_micros("last"), "n": F.col("n"), "stale_at": F.timestamp_micros("end")}
    return out.select(own, "*").select(*(F.col(f"k.{k}").alias(k) for k in keys), *(v.alias(n) for n, v in times.items()))
