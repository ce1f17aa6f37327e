"""Streams against the batch forms: uptime that takes over from a batch table, restarts, expiry."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from quarrykit.operators import events as E
from quarrykit.streaming import resumed

KIND = "device_id string, ts timestamp, status string, event_id bigint"


def at(text):
    return datetime.datetime.fromisoformat(f"2024-01-{text}")


@pytest.fixture
def rocks(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    held = spark.conf.get(name)
    resumed.with_state_store(spark)
    yield spark
    spark.conf.set(name, held)


def run(spark, folder, out, checkpoint, initial=None, idle=0):
    stream = spark.readStream.schema(KIND).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")
    q = resumed.resumed_uptime(stream, initial, idle=idle).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination(180)
    rows = [(r.device_id, r.hour, r.uptime_percentage, r.count_state) for r in spark.read.parquet(out).collect()]
    assert len({r[:2] for r in rows}) == len(rows)
    return {r[:2]: r[2:] for r in rows}


def batch_of(spark, rows, start, end):
    made = E.hourly_uptime(spark.createDataFrame(rows, KIND), F.lit(str(start)).cast("timestamp"), F.lit(str(end)).cast("timestamp"))
    return {(r.device_id, r.hour): (r.uptime_percentage, r.count_state) for r in made.collect()}


def test_a_stream_takes_over_from_a_changed_batch_table(rocks, tmp_path):
    spark, rng = rocks, random.Random(3)
    rows = [(rng.choice("abcd"), at("01 00:00") + datetime.timedelta(seconds=rng.randrange(10 * 3600)), rng.choice(["online", "offline", "alerting"]), k) for k in range(160)]
    rows += [("e", at("01 01:30"), "online", 902), ("late", at("01 05:10"), "online", 901)]
    start = at("01 06:00")  # two hours before what the batch table told last
    stored, new = [r for r in rows if r[1] < start], sorted((r for r in rows if r[1] >= start), key=lambda r: r[1])
    new += [("z", at("01 12:00"), "online", 950), ("z", at("01 12:40"), "offline", 951)]
    for turn, table in enumerate((stored, [r for r in stored if r[3] % 9] + [("f", at("01 02:00"), "alerting", 990)])):
        folder, out, mark = (str(tmp_path / f"{n}{turn}") for n in ("in", "out", "check"))
        initial = resumed.initial_state(spark.createDataFrame(table, KIND), F.lit(str(start)))
        half = len(new) // 2
        spark.createDataFrame(new[:half], KIND).coalesce(1).write.parquet(f"{folder}/0")
        run(spark, folder, out, mark, initial)
        for k, part in enumerate((new[half:-1], new[-1:])):  # a restart goes on from its checkpoint
            spark.createDataFrame(part, KIND).coalesce(1).write.parquet(f"{folder}/{k + 1}")
        told = run(spark, folder, out, mark, initial)
        end = max(h for _, h in told) + datetime.timedelta(hours=1)
        want = batch_of(spark, table + new, start, end)
        seeded = {r[0] for r in table}
        assert {k for k in told if k[0] in seeded} == {k for k in want if k[0] in seeded}
        assert all(want[k] == v for k, v in told.items()) and end == at("01 10:00")
        assert ("e", start) in told and told["e", start] == (100.0, 0)


def test_silent_devices_are_told_and_forgotten(rocks, tmp_path):
    spark = rocks
    rows = [("a", at("01 00:10"), "online", 1), ("b", at("01 00:20"), "online", 2), ("b", at("01 08:00"), "offline", 3), ("b", at("01 20:00"), "online", 4), ("a", at("01 23:00"), "online", 5), ("b", at("02 06:00"), "online", 6)]
    for k, row in enumerate(rows):
        spark.createDataFrame([row], KIND).coalesce(1).write.parquet(str(tmp_path / "in" / str(k)))
    told = run(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check"), idle=3)
    assert [h.hour for d, h in sorted(told) if d == "a" and h < at("01 12:00")] == [0, 1, 2, 3]
    assert told["a", at("01 00:00")] == (round(50 / 60 * 100, 3), 1)
    assert not any(d == "a" and at("01 04:00") <= h < at("01 23:00") for d, h in told)
    assert told["a", at("01 23:00")][1] == 1


def test_late_and_missing_metrics_give_the_batch_rows(spark, tmp_path):
    from quarrykit.streaming.combined import with_metrics

    hour = lambda h: at("01 00:00") + datetime.timedelta(hours=h)
    base = [("a", hour(h)) for h in range(14)] + [("b", hour(h)) for h in range(0, 14, 3)]
    speed = [("a", hour(h) + datetime.timedelta(minutes=7), h * 1.5) for h in range(14) if h % 4] + [("b", hour(3) + datetime.timedelta(minutes=59), 9.0), ("c", hour(2), 1.0)]
    alerts = [("a", hour(5), 2), ("b", hour(6) + datetime.timedelta(minutes=1), 1)]
    kinds = {"base": "device_id string, hour timestamp", "speed": "device_id string, at timestamp, speed double", "alerts": "device_id string, seen timestamp, alerts int"}
    rows = {"base": base, "speed": speed, "alerts": alerts}
    for name, all_rows in rows.items():
        time_of = lambda r: r[1]
        parts = [[r for r in all_rows if time_of(r) < hour(5)], [r for r in all_rows if time_of(r) >= hour(5)], [(("z", hour(30)) + (0,) * (len(all_rows[0]) - 2))], [(("z", hour(40)) + (0,) * (len(all_rows[0]) - 2))]]
        if name == "speed":  # what came at four is late by a file
            parts[1] += [r for r in parts[0] if r[1].hour == 3]
            parts[0] = [r for r in parts[0] if r[1].hour != 3]
        for k, part in enumerate(parts):
            typed = [tuple(float(v) if name == "speed" and n == 2 else v for n, v in enumerate(r)) for r in part]
            spark.createDataFrame(typed, kinds[name]).coalesce(1).write.parquet(str(tmp_path / name / str(k)))
    read = lambda reader, name: reader.schema(kinds[name]).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name / "*"))
    made = lambda reader: with_metrics(read(reader, "base"), {"speed": (read(reader, "speed"), "at"), "alerts": (read(reader, "alerts"), "seen")}, late="3 hours")
    q = made(spark.readStream).writeStream.format("memory").queryName("metrics").outputMode("append").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    q.awaitTermination(180)
    key = lambda r: (r.device_id, r.hour, r.speed, r.alerts)
    told = sorted((key(r) for r in spark.table("metrics").collect() if r.device_id != "z"), key=str)
    want = sorted((key(r) for r in made(spark.read).collect() if r.device_id != "z"), key=str)
    assert told == want and len(want) == len(base) and any(r[2] is None for r in want)


def test_summaries_of_days_merge_to_those_of_all_rows(spark):
    from quarrykit.operators import summaries

    rows = spark.range(40_000).select((F.col("id") % 3).alias("k"), F.timestamp_seconds(1704067200 + F.col("id") * 41).alias("t"), (F.col("id") % 9001).alias("who"), F.when(F.col("id") % 11 > 0, F.rand(5) * 100).alias("v"))
    days = summaries.day_summaries(rows, ["k"], "t", "who", "v")
    assert days.count() == 3 * rows.select(F.to_date("t")).distinct().count()
    for by in (["k"], []):
        for r in summaries.merged(days, by, ranks=(0.1, 0.5)).collect():
            some = rows.where(F.col("k") == r.k) if by else rows
            n, least, most, ids, count = some.agg(F.count("v"), F.min("v"), F.max("v"), F.countDistinct("who"), F.count("*")).first()
            assert (r.rows, r.n, r.least, r.most) == (count, n, least, most) and abs(r.ids - ids) <= 0.03 * ids
            below = [some.where(F.col("v") <= q).count() / n for q in r.quantiles]
            assert abs(below[0] - 0.1) < 0.02 and abs(below[1] - 0.5) < 0.02
    none = summaries.merged(summaries.day_summaries(rows.limit(0), ["k"], "t", "who"), ["k"])
    assert none.collect() == []
