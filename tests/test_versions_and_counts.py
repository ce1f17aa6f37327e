"""Versions whose equal buckets aren't read, clustering by several keys, kept counts of duplicates, the geodesic against plain Python."""

import math
import bisect
import random
import shutil

import pytest
from pyspark.sql import functions as F

from quarrykit.functions import geo
from quarrykit.operators.counted import KeptCounts
from quarrykit.operators.merge import snapshot_diff
from quarrykit.operators.shared import new_folder
from quarrykit.sources import sinks as K
from quarrykit.sources import versions as V


def content(df):
    return sorted(map(str, df.collect()))


def test_equal_buckets_are_not_read(spark, tmp_path):
    rows = spark.range(2000).select("id", (F.col("id") % 7).alias("n"), F.create_map(F.lit("a"), F.col("id") % 3).alias("m"))
    changed = rows.where("id <> 5").withColumn("n", F.when(F.col("id") == 900, 70).otherwise(F.col("n"))).union(spark.range(3000, 3001).select("id", F.lit(1).cast("bigint"), F.create_map(F.lit("b"), F.lit(2).cast("bigint"))))
    store = V.DigestedSnapshots(spark, str(tmp_path / "t"), ["id"], buckets=50)
    assert [store.publish(rows), store.publish(changed.repartition(3)), store.publish(changed.orderBy("n"))] == [0, 1, 2]
    some = store.changed_buckets(0, 1)
    assert 1 <= len(some) <= 3 and store.changed_buckets(1, 2) == []
    want = content(snapshot_diff(rows, changed, ["id"], 1))
    for version in (0, 1):  # equal buckets are gone, and nobody misses them
        for k in range(50):
            if k not in some:
                shutil.rmtree(tmp_path / "t" / f"v={version}" / f"_bucket={k}", ignore_errors=True)
    assert content(store.diff(0, 1).select("id", "n", "m", "_change_type", "_commit_version")) == want
    assert len(want) == 4
    assert sorted(map(str, store.changes(0).columns)) == sorted(["id", "n", "m", "_change_type", "_commit_version"])
    other = V.DigestedSnapshots(spark, str(tmp_path / "u"), ["id"])
    other.publish(rows)
    assert other.buckets == 1
    other.buckets = 4
    other.publish(changed)
    assert other.changed_buckets(0, 1) is None and content(other.diff(0, 1).select("id", "n", "m", "_change_type", "_commit_version")) == want
    assert other.changes(1).count() == 0


def test_clustering_reads_fewer_files(spark, tmp_path):
    rng = random.Random(1)
    rows = spark.createDataFrame([(k, rng.randrange(1000), None if k % 50 == 0 else f"n{rng.randrange(1000):04d}") for k in range(20_000)], "id int, a int, b string").repartition(16)
    K.Snapshots(spark, str(tmp_path / "t")).publish(rows)
    K.overwrite(rows.select("id"), str(tmp_path / "other" / "v=0"))
    done = V.compact_tables(spark, [str(tmp_path / n) for n in ("t", "none", "other")], ["a", "b"], file_bytes=V.bytes_of(spark, str(tmp_path / "t")) // 16)
    assert done == {str(tmp_path / "t"): 16 if done[str(tmp_path / "t")] == 16 else 17, str(tmp_path / "none"): "no version", str(tmp_path / "other"): "none of the keys"}

    def files(version):
        f = K.Snapshots(spark, str(tmp_path / "t")).read(version).groupBy(F.input_file_name()).agg(F.min("a").alias("a0"), F.max("a").alias("a1"), F.min("b").alias("b0"), F.max("b").alias("b1"))
        return f.where("300 BETWEEN a0 AND a1 AND 'n0700' BETWEEN b0 AND b1").count()

    assert files(0) == 16 and files(1) <= 5
    assert content(K.Snapshots(spark, str(tmp_path / "t")).read(1)) == content(rows)


def test_ranks_are_found_by_halving(spark):
    """Ranks against bisect; the bounds of a key stand in the place's expression once, not once a bit."""
    bounds = [-3.0, 0.0, 0.5, 2.0, 7.0, 8.0, 100.0]
    values = [None, -4.0, -3.0, 0.2, 0.5, 1.0, 7.5, 8.0, 99.0, 100.0, 1e9]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for n in range(len(bounds) + 1):
        got = {r.v: r.r for r in df.select("v", V._rank(F.col("v"), bounds[:n], 3).alias("r")).collect()}
        assert got == {v: 0 if v is None else bisect.bisect_right(bounds[:n], v) for v in values}
    rows = spark.createDataFrame([(k % 97 + 0.25, k % 89) for k in range(500)], "a double, b int")
    assert V.curve(rows, ["a", "b"])._jc.toString().count("50.25,") == 1


def test_kept_counts_equal_counting_anew(spark, tmp_path):
    rng = random.Random(4)
    checks = {"id": ["id"], "place": ["a", "b"]}
    kept, stored = KeptCounts(spark, str(tmp_path / "counts"), checks), []
    for n in range(4):
        new = [(rng.choice([None, *range(40)]), rng.choice([None, 1, 2, 3]), rng.choice("xyz"), n * 100 + k) for k in range(30)]
        gone = rng.sample(stored, min(len(stored), 12))
        stored = [r for r in stored if r not in gone] + new
        kind = "id int, a int, b string, row int"
        upload, deleted = spark.createDataFrame(new, kind), spark.createDataFrame(gone, kind)
        for _ in range(2):  # an upload that is run again counts once
            kept.add(f"u{n}", upload, deleted=deleted)
        if n == 2:
            kept = kept.fold(str(tmp_path / "folded"))
        flags = {r.row: (r["dq_duplicate-id"], r["dq_duplicate-place"]) for r in kept.flagged(upload).collect()}
        repeats = lambda r, *at: int(all(r[k] is not None for k in at) and sum(all(s[k] == r[k] for k in at) for s in stored) > 1)
        assert flags == {r[3]: (repeats(r, 0), repeats(r, 1, 2)) for r in new}


def plain_km(y1, x1, y2, x2):
    """The inverse problem's series in plain Python; None where it doesn't settle."""
    a, f = 6378.137, 1 / 298.257223563
    b = a * (1 - f)
    u, v = (math.atan((1 - f) * math.tan(math.radians(y))) for y in (y1, y2))
    span = at = math.radians((x2 - x1 + 180) % 360 - 180)
    for _ in range(1000):
        ss = math.hypot(math.cos(v) * math.sin(at), math.cos(u) * math.sin(v) - math.sin(u) * math.cos(v) * math.cos(at))
        if ss == 0:
            return 0.0
        cs = math.sin(u) * math.sin(v) + math.cos(u) * math.cos(v) * math.cos(at)
        arc, az = math.atan2(ss, cs), math.cos(u) * math.cos(v) * math.sin(at) / ss
        sq = 1 - az * az
        m = cs - 2 * math.sin(u) * math.sin(v) / sq if sq > 1e-15 else 0.0
        c = f / 16 * sq * (4 + f * (4 - 3 * sq))
        new = span + (1 - c) * f * az * (arc + c * ss * (m + c * cs * (2 * m * m - 1)))
        if abs(new - at) < 1e-13:
            w = sq * (a * a - b * b) / (b * b)
            big, small = 1 + w / 16384 * (4096 + w * (-768 + w * (320 - 175 * w))), w / 1024 * (256 + w * (-128 + w * (74 - 47 * w)))
            return b * big * (arc - small * ss * (m + small / 4 * (cs * (2 * m * m - 1) - small / 6 * m * (4 * ss * ss - 3) * (4 * m * m - 3))))
        at = new
    return None


def test_geodesic_within_a_metre_of_plain_python(spark):
    rng = random.Random(2)
    anywhere = lambda: (rng.uniform(-90, 90), rng.uniform(-180, 180))
    rows = [(*anywhere(), *anywhere()) for _ in range(10_000)]
    rows += [(y, x, y + rng.uniform(-0.01, 0.01), x + rng.uniform(-0.01, 0.01)) for y, x in (anywhere() for _ in range(500)) if abs(y) < 89]
    rows += [(0.0, 0.0, 0.0, 1.0), (5.0, 5.0, 5.0, 5.0), (10.0, 179.99, 10.0, -179.99), (90.0, 0.0, 0.0, 7.0)]
    rows += [(y, x, -y + rng.uniform(-4, 4), x + 180 + rng.uniform(-4, 4)) for y, x in (anywhere() for _ in range(300)) if abs(y) < 80]
    df = spark.createDataFrame([tuple(map(float, r)) for r in rows], "a double, b double, c double, d double").select("*", geo.geodesic_km(*(F.col(c) for c in "abcd")).alias("km"), geo.distance_km(*(F.col(c) for c in "abcd")).alias("round"))
    far = 0
    for r in df.collect():
        if r.round < math.pi * geo.EARTH_KM - geo.SETTLED:
            assert r.km == pytest.approx(plain_km(r.a, r.b, r.c, r.d), abs=0.001)
        else:
            far += 1
            assert r.km == r.round
    assert far < 120
    near = df.select("km", geo.within_km(*(F.col(c) for c in "abcd"), 111.3).alias("near")).collect()
    assert all(r.near == (r.km <= 111.3) for r in near)


def test_boundary_on_the_ellipsoid(spark):
    """A square at 60 degrees, where the sphere is some 0.3 % off: points within and beyond a limit that the sphere would judge otherwise."""
    ring = [(0.0, 59.0), (2.0, 59.0), (2.0, 60.0), (0.0, 60.0), (0.0, 59.0)]
    sides = geo.edges(spark.createDataFrame([("p", k, x, y) for k, (x, y) in enumerate(ring)], "poly string, seq int, lon double, lat double"), "poly")
    rng = random.Random(8)
    points = [(k, "p", 60.0 + rng.uniform(0.0895, 0.0903), rng.uniform(0.2, 1.8)) for k in range(200)] + [(900, "p", 59.5, 1.0), (901, "p", 70.0, 1.0), (902, "p", None, 1.0)]
    df = spark.createDataFrame(points, "id int, poly string, latitude double, longitude double")
    km = {k: plain_km(y, x, 60.0, x) for k, _, y, x in points[:200]}
    limit = sorted(km.values())[100] + 1e-9
    off = {r.id: r.off_limits for r in geo.off_limits(df, sides, "poly", limit, ellipsoid=True).collect()}
    assert off == {k: v > limit for k, v in km.items()} | {900: False, 901: True, 902: None}
    told = {r.id: r.boundary_km for r in geo.boundary_km(df, sides, "poly", limit, ellipsoid=True).collect()}
    assert all((told[k] is None) == (v > limit) and (told[k] is None or told[k] == pytest.approx(v, abs=1e-6)) for k, v in km.items())
    on_sphere = {r.id: r.off_limits for r in geo.off_limits(df, sides, "poly", limit).collect()}
    assert on_sphere != off


def test_folders_are_shared_ones(spark):
    assert new_folder(spark, "a").rsplit("/", 1)[0] == new_folder(spark, "b").rsplit("/", 1)[0]
