"""Queries of device events."""

from pyspark.sql import functions as F

from ..operators import events as E
from ..operators import merge as M
from ..operators import report as R
from ..registry import query
from ..streaming.combined import with_metrics

#: From the second day of the table, so that earlier states count, to the end of its last hour.
A, B = "(SELECT date_trunc('day', min(ts)) + INTERVAL 1 DAY FROM fx_status)", "(SELECT date_trunc('hour', max(ts)) + INTERVAL 1 HOUR FROM fx_status)"
SEED = f"""s AS (SELECT device_id, ts, status, event_id FROM fx_status WHERE ts >= {A} AND ts < {B} UNION ALL SELECT device_id, {A}, arg_max(status, (ts, event_id)), -1 FROM fx_status WHERE ts < {A} GROUP BY 1),
n AS (SELECT *, coalesce(lead(ts) OVER (PARTITION BY device_id ORDER BY ts, event_id), {B}) AS e FROM s)"""
UPTIME = f"""{SEED}, o AS (SELECT device_id, ts, e, unnest(generate_series(date_trunc('hour', ts), date_trunc('hour', e - INTERVAL 1 MICROSECOND), INTERVAL 1 HOUR)) AS hour FROM n WHERE status <> 'offline' AND ts < e),
g AS (SELECT device_id, unnest(generate_series({A}, {B} - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hour FROM (SELECT DISTINCT device_id FROM s)),
u AS (SELECT device_id, hour, (epoch_us(least(e, hour + INTERVAL 1 HOUR)) - epoch_us(greatest(ts, hour))) / 1e6 AS s, 0 AS n FROM o UNION ALL SELECT device_id, hour, 0, 0 FROM g UNION ALL SELECT device_id, date_trunc('hour', ts), 0, 1 FROM fx_status WHERE ts >= {A} AND ts < {B})"""
HOUR = "strftime(hour, '%Y-%m-%d %H')"


def window(t):
    """start and end of the table's hours: one aggregate."""
    ts = F.col("ts").cast("timestamp")
    row = t.fx_status.agg((F.date_trunc("day", F.min(ts)) + F.expr("INTERVAL 1 DAY")).cast("string").alias("a"), (F.date_trunc("hour", F.max(ts)) + F.expr("INTERVAL 1 HOUR")).cast("string").alias("b")).first()
    return F.lit(row["a"]).cast("timestamp"), F.lit(row["b"]).cast("timestamp")


def text_hour(df):
    return df.withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH"))


@query("stm_01_hourly_uptime", f"WITH {UPTIME} SELECT device_id, {HOUR} AS hour, round(sum(s) / 36.0, 3) AS uptime_percentage, CAST(sum(n) AS BIGINT) AS count_state FROM u GROUP BY 1, 2")
def stm_01(t):
    return text_hour(E.hourly_uptime(t.fx_status, *window(t)))


@query("agg_08_online_seconds", f"WITH {UPTIME} SELECT device_id, round(sum(s) / 36.0, 3) AS percent_hours FROM (SELECT device_id, hour, sum(s) AS s FROM u GROUP BY 1, 2) GROUP BY 1")
def agg_08(t):
    start, end = window(t)
    known = E.seeded(t.fx_status.withColumn("ts", F.col("ts").cast("timestamp")), start).where(F.col("ts") < end)
    on = E.online_intervals(known, end)
    devices = known.select("device_id").distinct()
    total = on.groupBy("device_id").agg(F.sum(E.seconds(F.col("start"), F.col("end"))).alias("s"))
    return devices.join(total, "device_id", "left").select("device_id", F.round(F.coalesce("s", F.lit(0.0)) / 36.0, 3).alias("percent_hours"))


@query("agg_09_state_changes", "SELECT device_id, strftime(ts, '%Y-%m-%d %H') AS hour, count(*) AS n FROM fx_status GROUP BY 1, 2")
def agg_09(t):
    return text_hour(t.fx_status.groupBy("device_id", F.date_trunc("hour", "ts").alias("hour")).agg(F.count(F.lit(1)).alias("n")))


@query("stm_02_reprocess_from", "SELECT strftime(date_trunc('hour', max(ts) - INTERVAL 2 HOURS), '%Y-%m-%d %H') AS start FROM (SELECT date_trunc('hour', ts) AS ts FROM fx_status WHERE ts < TIMESTAMP '2024-01-20 05:30:00')")
def stm_02(t):
    done = t.fx_status.where(F.col("ts").cast("timestamp") < "2024-01-20 05:30:00").select(F.date_trunc("hour", "ts").alias("hour"))
    return E.reprocess_from(t.fx_status, done).select(F.date_format("start", "yyyy-MM-dd HH").alias("start"))


@query("stm_04_event_dedupe", "SELECT event_id FROM events")
def stm_04(t):
    from ..operators.project import event_key

    twice = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts")).union(t.events.select("event_id", F.col("ts").cast("timestamp")))
    return event_key(twice, ["event_id", "ts"], "ts").select("event_id")


@query("stm_05_downtime", f"WITH {SEED} SELECT device_id, round(sum(CASE WHEN status IN ('offline', 'alerting') THEN (epoch_us(e) - epoch_us(ts)) / 1e6 ELSE 0 END), 3) AS downtime_s, round(sum(CASE WHEN status IN ('offline', 'alerting') THEN 0 ELSE (epoch_us(e) - epoch_us(ts)) / 1e6 END), 3) AS uptime_s FROM n GROUP BY 1")
def stm_05(t):
    return E.downtime(t.fx_status, *window(t), down=("offline", "alerting"))


@query("stm_06_daily_events", f"SELECT event_id, strftime(time_bucket(INTERVAL 5 MINUTES, ts), '%H.%M') || ' - ' || strftime(time_bucket(INTERVAL 5 MINUTES, ts) + INTERVAL 5 MINUTES, '%H.%M') AS time_window, strftime(ts, '%Y-%m-%d') AS date, count(*) OVER (PARTITION BY device_id, CAST(ts AS DATE)) AS count FROM fx_status WHERE ts >= {A} AND ts < {B}")
def stm_06(t):
    rows = E.daily_events(t.fx_status.withColumn("ts", F.col("ts").cast("timestamp")), *window(t))
    return rows.select("event_id", "time_window", F.col("date").cast("string").alias("date"), "count")


@query("stm_07_combined_table", f"WITH {SEED}, d AS (SELECT device_id, round(sum(CASE WHEN status = 'offline' THEN (epoch_us(e) - epoch_us(ts)) / 1e6 ELSE 0 END), 3) AS downtime_s FROM n GROUP BY 1), v AS (SELECT CAST(user_id AS VARCHAR) AS device_id, round(avg(value), 6) AS mean_value FROM events WHERE ts >= {A} AND ts < {B} GROUP BY 1) SELECT i.device_id, d.downtime_s, v.mean_value FROM (SELECT DISTINCT device_id FROM fx_status) i LEFT JOIN d USING (device_id) LEFT JOIN v USING (device_id)")
def stm_07(t):
    ts, (start, end) = F.col("ts").cast("timestamp"), window(t)
    values = t.events.where((ts >= start) & (ts < end)).groupBy(F.col("user_id").cast("string").alias("device_id")).agg(F.round(F.avg("value"), 6).alias("mean_value"))
    return E.combined(t.fx_status.select("device_id").distinct(), {"downtime": E.downtime(t.fx_status, start, end).select("device_id", "downtime_s"), "value": values})


@query("stm_07_hourly_metrics", """WITH h AS (SELECT DISTINCT device_id, date_trunc('hour', ts) AS hour FROM fx_status), a AS (SELECT device_id, date_trunc('hour', ts) AS hour, max(event_id) AS last_alert FROM fx_status WHERE status = 'alerting' GROUP BY 1, 2),
o AS (SELECT device_id, date_trunc('hour', ts) AS hour, count(*) AS offline FROM fx_status WHERE status = 'offline' GROUP BY 1, 2)
SELECT h.device_id, strftime(h.hour, '%Y-%m-%d %H') AS hour, last_alert, offline FROM h LEFT JOIN a ON h.device_id = a.device_id AND h.hour = a.hour LEFT JOIN o ON h.device_id = o.device_id AND h.hour = o.hour""")
def stm_07_metrics(t):
    rows = t.fx_status.withColumn("ts", F.col("ts").cast("timestamp"))
    of = lambda status, value: rows.where(F.col("status") == status).groupBy("device_id", F.date_trunc("hour", "ts").alias("at")).agg(value)
    base = rows.select("device_id", F.date_trunc("hour", "ts").alias("hour")).distinct()
    return text_hour(with_metrics(base, {"alerts": (of("alerting", F.max("event_id").alias("last_alert")), "at"), "offline": (of("offline", F.count(F.lit(1)).alias("offline")), "at")}))


@query("stm_08_incremental_pull", "SELECT event_id, event_id IN (SELECT event_id FROM events WHERE ts < TIMESTAMP '2024-01-15') AS is_pushed FROM events")
def stm_08(t):
    ts = F.col("ts").cast("timestamp")
    rows = t.events.select("event_id", ts.alias("ts"))
    held = rows.where(F.col("ts") < "2024-01-15").withColumn("is_pushed", F.lit(True))
    mark = R.high_water(held, "ts")
    new = rows.join(mark, F.col("ts") > F.col("high_water") - F.expr("INTERVAL 1 HOUR")).drop("high_water").withColumn("is_pushed", F.lit(False))
    return M.insert_only(held, new, ["event_id"]).select("event_id", "is_pushed")
