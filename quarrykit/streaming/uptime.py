"""Hourly uptime as a stream: state per device, hours emitted when the watermark has passed them."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

HOUR = 3_600_000_000
OUT = "device_id string, hour timestamp, uptime_percentage double, count_state bigint"
#: From where the device's hours are to be told; status there; events after it, not yet told.
STATE = "since bigint, status string, times array<bigint>, states array<string>, ties array<bigint>"


def _told(since: int, status: str | None, events: list[tuple[int, int, str]], until: int) -> tuple[list[tuple[int, float, int]], str | None]:
    """(hour, percent, changes) of each hour of [since, until), and the status at the end. Percents as operators.events.percent_of_hour has them."""
    online, changes = {h: 0 for h in range(since, until, HOUR)}, {h: 0 for h in range(since, until, HOUR)}

    def credit(a: int, b: int) -> None:
        while a < b:
            hour = a - a % HOUR
            end = min(b, hour + HOUR)
            online[hour] += end - a
            a = end

    at = since
    for time, _, state in events:
        if status is not None and status != "offline":
            credit(at, time)
        at, status = time, state
        changes[time - time % HOUR] += 1
    if status is not None and status != "offline":
        credit(at, until)
    return [(h, (online[h] + 18_000) // 36_000 / 1000, changes[h]) for h in online], status


def _advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    since, status, times, states, ties = state.get if state.exists else (None, None, [], [], [])
    held = list(zip(times, ties, states, strict=True))
    for frame in frames:
        held += zip(frame["us"].tolist(), frame["event_id"].tolist(), frame["status"].tolist(), strict=True)
    held.sort()
    mark = state.getCurrentWatermarkMs() * 1000
    if since is None and held:
        since = held[0][0] - held[0][0] % HOUR
    until = max(since or 0, mark - mark % HOUR)
    if since is not None and until > since:
        told, status = _told(since, status, [e for e in held if since <= e[0] < until], until)
        held = [e for e in held if e[0] >= until]
        since = until
        yield pd.DataFrame({"device_id": key[0], "hour": pd.to_datetime([h for h, *_ in told], unit="us"), "uptime_percentage": [p for _, p, _ in told], "count_state": [n for *_, n in told]})
    if since is not None:
        state.update((since, status, [t for t, *_ in held], [s for *_, s in held], [k for _, k, _ in held]))
        state.setTimeoutTimestamp(max(since // 1000 + 3_600_000, state.getCurrentWatermarkMs() + 1))


def stream_uptime(events: DataFrame, late: str = "2 hours") -> DataFrame:
    """device_id, hour, uptime_percentage, count_state of each device from its first hour on, once no event of that hour is waited for any more.

    events: a stream of device_id, ts (timestamp), status, event_id. State is one device's events of the hours still open."""
    rows = events.select("device_id", "ts", "status", F.col("event_id").cast("bigint").alias("event_id"), F.unix_micros(F.col("ts")).alias("us")).withWatermark("ts", late)
    return rows.groupBy("device_id").applyInPandasWithState(_advance, OUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)
