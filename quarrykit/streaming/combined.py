"""Hourly rows of devices with their metrics, as a stream or as a batch.

Each metric is a left outer join on the device and on the metric's time within the row's hour. In a stream both sides have watermarks, so that a row waits for its metrics until none of that hour can come any more and is then told once,
with nulls for what is missing; state is bounded by the hours that are open."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.project import col


def with_metrics(base: DataFrame, metrics: Mapping[str, tuple[DataFrame, str]], device: str = "device_id", hour: str = "hour", late: str = "2 hours", span: str = "1 hour") -> DataFrame:
    """base (a row for each device and hour, `hour` a timestamp) with the columns of each metric but its device and time; a metric is a DataFrame and the name of its time column, and has one row
    at most for a device within the span.

    The same for tables and for streams, for which the watermarks hold: `late` is how long rows of either side are waited for."""
    out = base.withWatermark(hour, late)
    for name, (df, time) in metrics.items():
        who, when = f"_{name}_device", f"_{name}_time"
        side = df.select(col(device).alias(who), col(time).alias(when), *(col(c) for c in df.columns if c not in (device, time))).withWatermark(when, late)
        same = (col(device) == F.col(who)) & (F.col(when) >= col(hour)) & (F.col(when) < col(hour) + F.expr(f"INTERVAL {span}"))
        out = out.join(side, same, "left_outer").drop(who, when)
    return out
