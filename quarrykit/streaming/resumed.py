"""Hourly uptime as a stream that takes over from a batch table: state of a device with timers, expiry, and an initial state.

The batch table tells hours up to its high-water mark; the stream begins two hours before it, since events may be late by that, with the state that each device had there, and tells all hours from then on. So a stream that is
started anew, after the batch table was changed, gives the rows that the batch query gives. Needs the RocksDB state store (`with_state_store`)."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.events import seeded
from .uptime import HOUR, OUT, _told

PLACE, EVENT, INITIAL = "since bigint, status string, heard bigint", "us bigint, event_id bigint, status string", "device_id string, since bigint, status string"


def with_state_store(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class Uptime(StatefulProcessor):
    """since: the hour from which is still to be told; status there; when the device was last heard of; and events of hours still open. A timer at each hour's end tells it once the watermark has passed.

    A device that hasn't been heard of for `idle` hours (0: never) is told up to then and forgotten."""

    def __init__(self, idle: int = 0) -> None:
        self.idle = idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.place = handle.getValueState("place", PLACE)
        self.events = handle.getListState("events", EVENT)

    def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: Any) -> None:  # noqa: N802,N803  names of the interface
        first = initialState.iloc[0]
        since = int(first["since"])
        self.place.update((since, first["status"], since))
        self.handle.registerTimer((since + HOUR) // 1000)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802,N803
        new = [e for frame in rows for e in zip(frame["us"].tolist(), frame["event_id"].tolist(), frame["status"].tolist(), strict=True)]
        since, status, heard = self.place.get() or (min(new)[0] // HOUR * HOUR, None, 0)
        new = [e for e in new if e[0] >= since]  # what is told stays told
        if new:
            self.events.appendList(new)
            heard = max(heard, *(e[0] for e in new))
        self.place.update((since, status, heard))
        self.handle.registerTimer((since + HOUR) // 1000)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802,N803
        place = self.place.get()
        if place is None:
            return
        since, status, heard = place
        until = max(timerValues.getCurrentWatermarkInMs() * 1000 // HOUR * HOUR, since)
        end = (heard // HOUR + 1 + self.idle) * HOUR
        over = bool(self.idle) and until >= end
        until = min(until, end) if self.idle else until
        held = sorted(self.events.get())
        if until > since:
            told, status = _told(since, status, [e for e in held if e[0] < until], until)
            yield pd.DataFrame({"device_id": key[0], "hour": pd.to_datetime([h for h, *_ in told], unit="us"), "uptime_percentage": [p for _, p, _ in told], "count_state": [n for *_, n in told]})
        left = [e for e in held if e[0] >= until]
        if over and not left:
            self.place.clear()
            self.events.clear()
            return
        self.events.clear()
        if left:
            self.events.put(left)
        self.place.update((until, status, heard))
        self.handle.registerTimer((until + HOUR) // 1000)

    def close(self) -> None:
        pass


def initial_state(events: DataFrame, start: Column) -> DataFrame:
    """device_id, since, status: what a batch table of events says of each device at the hour from which the stream tells."""
    start = start.cast("timestamp")
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return seeded(rows, start).where((F.col("event_id") == -1) & (F.col("ts") == start)).select(F.col("device_id").cast("string"), F.unix_micros("ts").alias("since"), "status")


def resumed_uptime(events: DataFrame, initial: DataFrame | None = None, late: str = "2 hours", idle: int = 0) -> DataFrame:
    """device_id, hour, uptime_percentage, count_state as hourly_uptime has them: of devices of the initial state from its hour on, of others from their first hour on, once no event of that hour is waited for."""
    rows = events.select(F.col("device_id").cast("string").alias("device_id"), F.col("ts").cast("timestamp").alias("ts"), "status", F.col("event_id").cast("bigint").alias("event_id"))
    rows = rows.withColumn("us", F.unix_micros("ts")).withWatermark("ts", late)
    seeds = None if initial is None else initial.select("device_id", "since", "status").groupBy("device_id")
    return rows.groupBy("device_id").transformWithStateInPandas(statefulProcessor=Uptime(idle), outputStructType=OUT, outputMode="append", timeMode="eventTime", initialState=seeds)
