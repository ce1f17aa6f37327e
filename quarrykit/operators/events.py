"""Device status events: uptime by hour, downtime over a window, event tables. Batch forms; streaming.uptime has the stream's.

Times are timestamps of the session's zone (UTC)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import fan_in
from .project import bucket_label, col
from .windows import first_per_key, last_before, with_next

DOWN = "offline"


def seconds(a: Column, b: Column) -> Column:
    return F.unix_micros(b.cast("timestamp")) / F.lit(1e6) - F.unix_micros(a.cast("timestamp")) / F.lit(1e6)


def micros(a: Column, b: Column) -> Column:
    return F.unix_micros(b.cast("timestamp")) - F.unix_micros(a.cast("timestamp"))


def percent_of_hour(us: Column) -> Column:
    """Of whole microseconds, rounded half up to thousandths; exact, whatever order they were summed in."""
    return F.floor((us + 18_000) / F.lit(36_000)) / F.lit(1000.0)


def seeded(events: DataFrame, start: Column, device: str = "device_id", time: str = "ts", status: str = "status", tie: str = "event_id") -> DataFrame:
    """Events from start on, and at start the state that each device had: device, time, status, tie."""
    last = last_before(events, device, time, status, start, tie).select(device, start.alias(time), status, F.lit(-1).cast("bigint").alias(tie))
    return events.where(col(time) >= start).select(device, time, status, F.col(tie).cast("bigint").alias(tie)).unionByName(last)


def online_intervals(events: DataFrame, end: Column, device: str = "device_id", time: str = "ts", status: str = "status", tie: str = "event_id") -> DataFrame:
    """device, start, end of each stretch in which the state isn't offline; the last one runs to the end given."""
    next_ = with_next(events.where(col(time) < end), device, time, status, tie)
    return next_.where(col(status) != DOWN).select(device, col(time).alias("start"), F.coalesce(F.col(f"next_{time}"), end).alias("end")).where("start < end")


def uptime_spans(events: DataFrame, start: Column, end: Column, device: str = "device_id", time: str = "ts", status: str = "status", tie: str = "event_id") -> DataFrame:
    """device and, for each hour of [start, end) in which it has an event, and start's if it had a state there: _hour, _us (time online in it), _n (its events), _on (whether it is online
    from then on), and _first and _until (the hours that this row tells, _until exclusive). What a device's hours before its first are is told by its first row.

    No more rows than events; one shuffle and one order, by device, hour and time, serve all windows."""
    start, end, hour = start.cast("timestamp"), end.cast("timestamp"), F.expr("INTERVAL 1 HOUR")
    rows = events.withColumn(time, col(time).cast("timestamp"))
    known = rows.where((col(time) >= start) & (col(time) < end)).select(device, time, status, F.col(tie).cast("bigint").alias(tie), F.lit(1).alias("_event"))
    earlier = last_before(rows, device, time, status, start, tie).where(start < end).select(device, start.alias(time), status, F.lit(-1).cast("bigint").alias(tie), F.lit(0).alias("_event"))
    line = Window.partitionBy(device).orderBy("_hour", time, tie)
    so_far = Window.partitionBy(device, "_hour").orderBy(time, tie).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = known.unionByName(earlier).withColumns({"_hour": F.date_trunc("hour", time), "_on": F.coalesce(col(status) != DOWN, F.lit(False))})
    seen = seen.withColumns({"_next": F.lead(time).over(line), "_before": F.lag("_hour").over(line), "_was": F.lag("_on").over(line), "_start": F.lag("_event").over(line).isNull()})
    carried = F.when(F.col("_was") & (F.col("_before") < F.col("_hour")), micros(F.col("_hour"), col(time))).otherwise(F.lit(0))  # by the hour's first row
    own = F.when(F.col("_on"), micros(col(time), F.least(F.coalesce("_next", end), F.col("_hour") + hour))).otherwise(F.lit(0))
    told = seen.withColumns({"_us": F.sum(own + carried).over(so_far), "_n": F.sum("_event").over(so_far), "_start": F.max("_start").over(so_far)})
    last = told.where(F.col("_next").isNull() | (F.col("_next") >= F.col("_hour") + hour))
    return last.select(device, "_hour", "_us", "_n", "_on", F.when(F.col("_start"), start).otherwise(F.col("_hour")).alias("_first"), F.coalesce(F.date_trunc("hour", "_next"), end).alias("_until"))


def hours_of_spans(spans: DataFrame, device: str = "device_id") -> DataFrame:
    """device, hour, uptime_percentage, count_state of the hours that rows of uptime_spans tell, and further columns of theirs. Hours are made in place and aren't grouped."""
    others = [c for c in spans.columns if c not in (device, "_hour", "_us", "_n", "_on", "_first", "_until")]
    hours = spans.withColumn("hour", F.explode(F.sequence("_first", F.col("_until") - F.expr("INTERVAL 1 HOUR"), F.expr("INTERVAL 1 HOUR"))))
    own = F.col("hour") == F.col("_hour")
    us = F.when(own, F.col("_us")).when(F.col("_on") & (F.col("hour") > F.col("_hour")), F.lit(3_600_000_000)).otherwise(F.lit(0))
    return hours.select(device, "hour", percent_of_hour(us).alias("uptime_percentage"), F.when(own, F.col("_n")).otherwise(F.lit(0)).alias("count_state"), *map(col, others))


def hourly_uptime(events: DataFrame, start: Column, end: Column, device: str = "device_id", time: str = "ts", status: str = "status", tie: str = "event_id") -> DataFrame:
    """device, hour, uptime_percentage, count_state for every device and hour of [start, end), zero-filled.

    start and end are whole hours. Each device's earlier state counts from start on."""
    return hours_of_spans(uptime_spans(events, start, end, device, time, status, tie), device)


def reprocess_from(events: DataFrame, done: DataFrame, time: str = "ts", back: str = "2 hours") -> DataFrame:
    """One row: the hour to start from, which is the mark of what is done less the time for late events, or the first event."""
    mark = done.agg(F.max("hour").alias("m")).select(F.date_trunc("hour", F.col("m") - F.expr(f"INTERVAL {back}")).alias("m"))
    first = events.agg(F.min(col(time).cast("timestamp")).alias("f")).select(F.date_trunc("hour", "f").alias("f"))
    return mark.join(first, how="inner", on=F.lit(True)).select(F.coalesce("m", "f").alias("start"))


def downtime(events: DataFrame, start: Column, end: Column, down: Sequence[str] = (DOWN,), device: str = "device_id", time: str = "ts", status: str = "status", tie: str = "event_id", previous: str | None = None) -> DataFrame:
    """device, downtime_s, uptime_s over [start, end), from status changes. What came before the first change is the last earlier state, else the
    first change's previous status where that is known, else not counted."""
    start, end = start.cast("timestamp"), end.cast("timestamp")
    rows = events.withColumn(time, col(time).cast("timestamp"))
    known = seeded(rows, start, device, time, status, tie).where(col(time) < end)
    if previous:
        early = first_per_key(rows.where((col(time) >= start) & (col(time) < end)), [device], [col(time), col(tie)])
        known = known.unionByName(early.join(known.where(col(tie) == -1).select(device), device, "left_anti").where(col(previous).isNotNull()).select(device, start.alias(time), col(previous).alias(status), F.lit(-1).cast("bigint").alias(tie)))
    spans = with_next(known, device, time, status, tie)
    length = seconds(col(time), F.least(F.coalesce(F.col(f"next_{time}"), end), end))
    bad = col(status).isin(*down)
    return spans.groupBy(device).agg(F.round(F.sum(F.when(bad, length).otherwise(0.0)), 3).alias("downtime_s"), F.round(F.sum(F.when(bad, 0.0).otherwise(length)), 3).alias("uptime_s"))


def daily_events(events: DataFrame, start: Column, end: Column, minutes: int = 5, device: str = "device_id", time: str = "ts") -> DataFrame:
    """Events of [start, end) with bucket label, date and the device's count of that day."""
    rows = events.where(col(device).isNotNull() & (col(time) >= start) & (col(time) < end))
    made = rows.withColumns({"time_window": bucket_label(col(time), minutes), "date": F.to_date(col(time))})
    return made.withColumn("count", F.count(F.lit(1)).over(Window.partitionBy(device, "date")))


def combined(inventory: DataFrame, metrics: dict[str, DataFrame], device: str = "device_id") -> DataFrame:
    """Inventory with the metrics of each device; each has one row a device at most."""
    return fan_in(inventory, metrics, [device])
