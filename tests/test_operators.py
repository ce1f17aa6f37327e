"""Golden rows of checks, and properties of merges, ids, similarity and uptime."""

import datetime
import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from oracle import compare, connect
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrykit import registry
from quarrykit.functions import geo, similarity
from quarrykit.operators import checks as C
from quarrykit.operators import events as E
from quarrykit.operators import joins as J
from quarrykit.operators import merge as M
from quarrykit.operators import project as P
from quarrykit.operators import schema as S
from quarrykit.streaming.uptime import HOUR, _told, stream_uptime

FEW = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def values(df, *columns):
    return [tuple(r) for r in df.select(*(F.col(f"`{c}`") for c in columns)).collect()]


def test_checks_on_null_absent_and_bad(spark):
    df = spark.createDataFrame([("1", "abc", "12.50", "Yes"), ("1", "--", "x", "maybe"), (None, None, None, None)], "id string, school_name string, latitude string, connectivity_govt string").coalesce(1)
    assert values(C.duplicate_checks(df, ["id", "none"]).orderBy("school_name"), "dq_duplicate-id") == [(0,), (1,), (1,)]
    d = C.range_checks(df, {"latitude": (-90, 90), "absent": (0, 1)})
    assert values(d, "dq_is_invalid_range-latitude", "dq_is_invalid_range-absent") == [(0, 1), (1, 1), (1, 1)]
    assert values(C.domain_checks(df, {"connectivity_govt": ["yes", 1]}), "dq_is_invalid_domain-connectivity_govt") == [(0,), (1,), (1,)]
    f = C.format_checks(df)
    assert values(f, "dq_is_not_alphanumeric-school_name", "dq_is_not_numeric-latitude") == [(0, 0), (1, 1), (0, 0)]
    assert values(C.precision_checks(df, {"latitude": 2}), "dq_precision-latitude") == [(0,), (1,), (None,)]
    assert values(C.percent_sum_check(spark.createDataFrame([(50, 30, 20), (1, 2, None), (1, 2, 3)], "a int, b int, c int"), ["a", "b", "c"], "x"), "x") == [(0,), (0,), (1,)]
    assert values(C.critical_checks(df, ["dq_none"]), "dq_has_critical_error", "failure_reason") == [(0, "")] * 3
    nan = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "latitude double")
    assert values(C.completeness_checks(nan, []), "dq_is_null_optional-latitude") == [(1,), (0,), (1,)]


def test_a_suite_reads_its_rows_once(spark):
    """All counts of a suite read rows that were dealt out once, not the table's own few partitions again and again."""
    rows = spark.range(60).coalesce(1).selectExpr("CAST(id AS STRING) AS school_id_giga", "CAST(id % 50 AS STRING) AS school_id_govt", "'a' AS school_name", "'Primary' AS education_level", "1.5D AS latitude", "id + 0.5D AS longitude")
    made = C.suite(rows, "geolocation", 2024)
    assert made.count() == 60 and "Range" not in made._jdf.queryExecution().optimizedPlan().toString()
    assert made.where("`dq_duplicate-school_id_govt` = 1").count() == 20


def test_decimals_of_text(spark):
    df = spark.createDataFrame([("1.50",), ("7",), ("1.5E-4",), ("1.0E7",), (None,), ("-3.123",)], "x string").coalesce(1)
    assert values(df.select(P.decimals("x").alias("n")), "n") == [(2,), (0,), (5,), (0,), (None,), (3,)]


def test_similar_names(spark):
    rows = [("1", "Escola Norte", "Primary", 1.0005, 2.0005), ("2", "Escola Norto", "Primary", 1.0005, 2.0005), ("3", "Zebra", "Primary", 1.0005, 2.0005), ("4", "Escola Norte", "Primary", 5.0005, 2.0005), ("5", "Escola Norte", None, None, 2.0)]
    df = spark.createDataFrame(rows, "school_id_giga string, school_name string, education_level string, latitude double, longitude double")
    assert dict(values(C.similar_name_check(df), "school_id_giga", "dq_similar_name_level_within_110m_radius")) == {"1": 1, "2": 1, "3": 0, "4": 0, "5": None}


@given(st.text(alphabet="abcdé ", max_size=12), st.text(alphabet="abcdé ", max_size=12))
def test_indel_ratio(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    want = 1.0 if not a and not b else 2 * table[-1][-1] / (len(a) + len(b))
    assert similarity.indel_ratio(a, b) == pytest.approx(want) == similarity.indel_ratio(b, a)
    assert 0 <= want <= 1


def test_uuid3(spark):
    names = ["", "a", "escola ção", "x" * 300, "中文"]
    got = spark.createDataFrame([(n,) for n in [*names, None]], "n string").select("n", P.uuid3(F.col("n")).alias("u")).collect()
    assert {r.n: r.u for r in got} == {n: str(uuid.uuid3(uuid.NAMESPACE_DNS, n)) for n in names} | {None: None}


tables = st.dictionaries(st.integers(0, 8), st.tuples(st.one_of(st.none(), st.sampled_from("ab")), st.integers(0, 2)), max_size=7)


def frame(spark, rows):
    return spark.createDataFrame([(k, *v) for k, v in rows.items()], "id int, v string, n int")


def content(df):
    got = df.select("id", "v", "n").collect()
    assert len({r.id for r in got}) == len(got)
    return {r.id: (r.v, r.n) for r in got}


@FEW
@given(tables, tables)
def test_diff_then_apply_gives_the_new_table(spark, a, b):
    old, new = frame(spark, a), frame(spark, b)
    feed = M.snapshot_diff(old, new, ["id"])
    assert content(M.apply_feed(old, feed, ["id"], ["id", "v", "n"])) == b
    once, changed = M.signature_upsert(old, new, ["id"], ["id", "v", "n"], full=True)
    assert content(once) == b and changed == (a != b)


@FEW
@given(tables, tables)
def test_merges(spark, a, b):
    old, new = frame(spark, a), frame(spark, b)
    over = lambda k: tuple(y if y is not None else x for x, y in zip(a.get(k, (None, None)), b[k], strict=True))
    want = {k: v for k, v in a.items() if k not in b} | {k: over(k) for k in b}
    once = M.partial_merge(old, new, ["id"], ["id", "v", "n"])
    assert content(once) == want
    assert content(M.full_merge(old, new, ["id"], ["id", "v", "n"])) == {k: over(k) for k in b}
    assert content(M.upsert_all(old, new, ["id"])) == a | b
    assert content(M.insert_only(old, new, ["id"])) == b | a


def test_merge_is_idempotent(spark):
    old, new = frame(spark, {1: ("a", 0), 2: (None, 1)}), frame(spark, {2: ("b", 1), 3: (None, 2)})
    once = M.partial_merge(old, new, ["id"], ["id", "v", "n"])
    assert content(M.partial_merge(once, new, ["id"], ["id", "v", "n"])) == content(once)


def test_guarded_cast_and_registry(spark):
    df = spark.createDataFrame([("1",), ("x",)], "a string")
    with pytest.raises(ValueError, match="'a': 1"):
        S.guarded_cast(df, {"a": "int"})
    with pytest.raises(ValueError, match="varchar"):
        S.require_valid_types(spark.createDataFrame([("c", "varchar")], "name string, data_type string"))
    old = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType())])
    new = T.StructType([T.StructField("a", T.StringType(), False), T.StructField("c", T.LongType())])
    assert S.schema_changes(old, new) == {"added": ["c"], "removed": ["b"], "changed": [], "required": ["a"]}
    assert S.table_name("school", "BRA") == "school.bra" and S.table_name("school", "BRA", "silver") == "school_silver.bra"
    assert [S.snake(x) for x in ("SchoolID", "school Name", "numPc2", "A-B")] == ["school_id", "school_name", "num_pc2", "a_b"]


def test_unique_contract(spark):
    df = spark.createDataFrame([(1,), (1,)], "id int")
    with pytest.raises(ValueError, match="repeat"):
        J.fan_in(df, {"m": df}, ["id"])


def test_point_in_polygon(spark):
    ring = [(0, 0), (4, 0), (4, 4), (2, 1), (0, 4), (0, 0)]
    sides = geo.edges(spark.createDataFrame([("p", k, float(x), float(y)) for k, (x, y) in enumerate(ring)], "poly string, seq int, lon double, lat double"), "poly")
    pts = [(k, "p", y, x) for k, (x, y) in enumerate([(1.0, 0.5), (2.0, 3.0), (3.5, 2.0), (9.0, 1.0)])] + [(9, "none", 1.0, 1.0), (10, "p", None, 1.0)]
    df = spark.createDataFrame(pts, "id int, poly string, latitude double, longitude double")
    df = df.union(df.where("id < 3"))  # rows that repeat
    assert sorted(values(geo.within_own(df, sides, "poly"), "id", "within")) == sorted([(0, True), (1, False), (2, True), (3, False), (9, False), (10, None), (0, True), (1, False), (2, True)])
    assert dict(values(geo.containing(df.drop("poly"), sides, "poly"), "id", "poly")) == {0: "p", 1: None, 2: "p", 3: None, 9: "p", 10: None}
    km = dict(values(geo.boundary_km(df, sides, "poly", 60.0), "id", "boundary_km"))
    assert km[0] == pytest.approx(0.5 * 111.19, rel=0.01) and km[3] is None and km[9] is None


@pytest.mark.parametrize("grid", [0.1, 0.37, 5.0])
def test_grid_against_all_edges(spark, grid):
    """Ragged rings with holes and parts, points on the boundary's own coordinates among them, against the ray rule over all edges."""
    import math
    import random

    rng, vertices, rings = random.Random(grid), [], {}
    for p in range(4):
        for ring, (cx, cy, r) in enumerate([(p * 1.5, 0.0, 1.0), (p * 1.5, 0.0, 0.4), (p * 1.5 + 3.0, 1.0, 0.3)]):
            turns = [2 * math.pi * k / 40 for k in range(40)]
            line = [(round(cx + r * rng.uniform(0.7, 1) * math.cos(a), 2), round(cy + r * rng.uniform(0.7, 1) * math.sin(a), 2)) for a in turns]
            line.append(line[0])
            rings.setdefault(p, []).append(line)
            vertices += [(p, ring, k, x, y) for k, (x, y) in enumerate(line)]
    points = [(k, rng.randrange(4), round(rng.uniform(-1.2, 1.4), 2), round(rng.uniform(-1.2, 8.5), 2)) for k in range(700)] + [(1000 + k, p, y, x) for k, (p, _, _, x, y) in enumerate(vertices[::9])]
    sides = geo.edges(spark.createDataFrame(vertices, "poly int, ring int, seq int, lon double, lat double"), "poly", rings=["ring"])
    df = spark.createDataFrame(points, "id int, poly int, latitude double, longitude double")

    def inside(p, x, y):
        return sum(((y1 > y) != (y2 > y)) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 for line in rings[p] for (x1, y1), (x2, y2) in zip(line, line[1:], strict=False)) % 2 == 1

    assert dict(values(geo.within_own(df, sides, "poly", grid=grid), "id", "within")) == {k: inside(p, x, y) for k, p, y, x in points}
    assert dict(values(geo.containing(df.drop("poly"), sides, "poly", grid=grid), "id", "poly")) == {k: min((q for q in rings if inside(q, x, y)), default=None) for k, _, y, x in points}
    near, off = (dict(values(d, "id", c)) for d, c in ((geo.boundary_km(df, sides, "poly", 9.0, grid=grid), "boundary_km"), (geo.off_limits(df, sides, "poly", 9.0, grid=grid), "off_limits")))
    wide = dict(values(geo.boundary_km(df, sides, "poly", 5000.0, grid=5.0), "id", "boundary_km"))
    assert near == {k: d if d <= 9 else None for k, d in wide.items()}
    assert off == {k: not inside(p, x, y) and wide[k] > 9 for k, p, y, x in points}


def test_hexagons(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0001, 2.0001), (1.05, 2.0), (None, 2.0), (float("nan"), 1.0)], "latitude double, longitude double")
    cells = [r.h for r in df.select(geo.hex_cell("latitude", "longitude").alias("h")).collect()]
    assert cells[0] == cells[1] != cells[2] and cells[3:] == ["0", "0"]


def ev(text):
    return datetime.datetime.fromisoformat(text)


EVENTS = [("a", ev("2024-01-01 00:30"), "online", 1), ("a", ev("2024-01-01 02:15"), "offline", 2), ("a", ev("2024-01-01 03:00"), "alerting", 3), ("b", ev("2024-01-01 01:00"), "offline", 4), ("b", ev("2024-01-01 01:20"), "online", 5), ("c", ev("2024-01-01 04:59:59"), "online", 6)]


def events(spark, rows=EVENTS):
    return spark.createDataFrame(rows, "device_id string, ts timestamp, status string, event_id bigint")


def test_hourly_uptime(spark):
    at = lambda t: F.lit(t).cast("timestamp")
    got = {(r.device_id, r.hour.hour): (r.uptime_percentage, r.count_state) for r in E.hourly_uptime(events(spark), at("2024-01-01 01:00"), at("2024-01-01 05:00")).collect()}
    assert len(got) == 12
    assert [got["a", h] for h in (1, 2, 3, 4)] == [(100.0, 0), (25.0, 1), (100.0, 1), (100.0, 0)]
    assert [got["b", h] for h in (1, 2)] == [(66.667, 2), (100.0, 0)]
    assert got["c", 4] == (0.028, 1) and got["c", 1] == (0.0, 0)


def test_hours_are_not_grouped(spark):
    """The plan has no aggregate or shuffle over hours, of which there are far more than events: rows are shuffled once, before hours are made."""
    at = lambda t: F.lit(t).cast("timestamp")
    one = ("e", ev("2024-01-01 01:30"), None, 7), ("e", ev("2024-01-01 01:30"), "online", 8), ("f", ev("2023-12-31 01:30"), "online", 9), (None, ev("2024-01-01 02:30"), "online", 10)
    made = E.hourly_uptime(events(spark, [*EVENTS, *one]), at("2024-01-01 01:00"), at("2024-01-01 05:00"))
    got = {(r.device_id, r.hour.hour): (r.uptime_percentage, r.count_state) for r in made.collect()}
    assert [got["e", h] for h in (1, 2)] == [(50.0, 2), (100.0, 0)] and [got["f", h] for h in (1, 4)] == [(100.0, 0)] * 2
    assert [got[None, h] for h in (1, 2, 3)] == [(0.0, 0), (50.0, 1), (100.0, 0)] and len(got) == made.count() == 24
    plan = made._jdf.queryExecution().optimizedPlan().toString().split("Generate explode")
    assert len(plan) == 2 and "Aggregate" not in plan[0] and "Union" not in plan[0]


def test_uptime_is_rounded_half_up(spark, tmp_path):
    """Hours whose time online lies halfway between two thousandths of a percent, in one stretch and in three; the query against its SQL and whole numbers."""
    rows, want = [], {}
    for k in range(150):
        at, us, device = datetime.datetime(2024, 1, 2, 1) + datetime.timedelta(microseconds=7919 * k + 13), 36_000 * (211 * k + 7) + 18_000, str(k)
        pieces = [us] if k % 2 else [us // 3 + k, us // 3 - k, us - 2 * (us // 3)]
        rows.append((device, datetime.datetime(2024, 1, 1), "error"))
        for piece in pieces:
            rows += [(device, at, "view"), (device, at + datetime.timedelta(microseconds=piece), "error")]
            at += datetime.timedelta(microseconds=piece + 1001)
        want[device] = (us + 18_000) // 36_000
    rows = [(n, ts, int(device), kind) for n, (device, ts, kind) in enumerate(rows)]
    spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string").write.parquet(str(tmp_path / "events.parquet"))
    spark.read.parquet("/root/testdata/sf0.001/customer.parquet").write.parquet(str(tmp_path / "customer.parquet"))
    made = registry.queries()["pipe_12_uptime"](spark, str(tmp_path))
    assert {r.device_id: r.total for r in made.collect()} == want
    assert compare(made, connect(str(tmp_path)), registry.oracle_sql()["pipe_12_uptime"]) is None
    for us in (18_000, 54_000, 17_999, 90_000):
        assert _told(0, "online", [(us, 1, "offline")], HOUR)[0] == [(0, (us + 18_000) // 36_000 / 1000, 1)]


def test_downtime_uses_previous_status(spark):
    at = lambda t: F.lit(t).cast("timestamp")
    rows = events(spark).withColumn("was", F.lit("offline"))
    got = {r.device_id: (r.downtime_s, r.uptime_s) for r in E.downtime(rows, at("2024-01-01 01:00"), at("2024-01-01 05:00"), previous="was").collect()}
    assert got == {"a": (2700.0, 11700.0), "b": (1200.0, 13200.0), "c": (14399.0, 1.0)}


def test_stream_uptime_equals_batch(spark, tmp_path):
    src = str(tmp_path / "in")
    late = [("z", ev("2024-01-01 09:00"), "online", 90), ("z", ev("2024-01-01 09:30"), "online", 91)]
    for k, part in enumerate((EVENTS[:3], EVENTS[3:], late[:1], late[1:])):
        events(spark, part).coalesce(1).write.parquet(f"{src}/{k}")
    stream = spark.readStream.schema("device_id string, ts timestamp, status string, event_id bigint").option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
    q = stream_uptime(stream).writeStream.format("memory").queryName("uptimes").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    told = {(r.device_id, r.hour): (r.uptime_percentage, r.count_state) for r in spark.table("uptimes").collect()}
    assert {d for d, _ in told} >= {"a", "b", "c"}
    end = max(h for _, h in told) + datetime.timedelta(hours=1)
    batch = E.hourly_uptime(events(spark, EVENTS + late), F.lit("2024-01-01 00:00").cast("timestamp"), F.lit(end.isoformat(" ")).cast("timestamp"))
    want = {(r.device_id, r.hour): (r.uptime_percentage, r.count_state) for r in batch.collect()}
    assert all(want[k] == v for k, v in told.items())
    assert {h.hour for d, h in told if d == "a"} == set(range(end.hour))
