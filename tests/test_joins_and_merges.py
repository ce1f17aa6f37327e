"""Distance and similarity joins against all pairs, places of many rows, merges of maps and of null and repeated keys, approvals that clash."""

import math
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quarrykit.functions import similarity
from quarrykit.operators import joins as J
from quarrykit.operators import merge as M
from quarrykit.operators import nearby as N
from quarrykit.operators import windows as W

WORDS = "Escola Municipal Estadual Colegio Centro Santa Maria Sao Jose Joao Infantil Creche Professor Rural".split()


def km(a, b):
    (y1, x1), (y2, x2) = ([math.radians(v) for v in p] for p in (a, b))
    h = math.sin((y2 - y1) / 2) ** 2 + math.cos(y1) * math.cos(y2) * math.sin((x2 - x1) / 2) ** 2
    return 2 * 6371.0088 * math.asin(math.sqrt(min(1.0, h)))


@pytest.mark.parametrize("radius,spread", [(0.1, 0.004), (50.0, 2.0), (3000.0, 60.0)])
def test_pairs_within_a_distance(spark, radius, spread):
    rng = random.Random(7)
    centres = [(0, 0), (89.999, 10), (-90, 5), (12, 179.999), (-60, -180), (45, 90.0005), (80, 179.9)]
    rows = []
    for k in range(280):
        y, x = rng.choice(centres)
        y = max(-90.0, min(90.0, y + rng.uniform(-spread, spread)))
        x = (x + rng.uniform(-spread, spread) * (40 if abs(y) > 89 else 1) + 180) % 360 - 180
        rows.append((k, y, x, rng.choice("ab")))
    rows += [(900, None, 1.0, "a"), (901, float("nan"), 1.0, "a"), (902, 1.0, None, "b")]
    df = spark.createDataFrame(rows, "id int, latitude double, longitude double, kind string")
    got = [(r.a, r.b) for r in N.pairs_within(df, "id", radius, ["kind"]).collect()]
    there = rows[:280]
    want = {(p[0], q[0]) for i, p in enumerate(there) for q in there[i + 1 :] if p[3] == q[3] and km(p[1:3], q[1:3]) <= radius}
    assert len(got) == len(set(got)) and set(got) == want and want


def test_links_of_classes(spark):
    rows = [(k, "Escola Norte", None, 1.0, 180.0) for k in range(50)] + [(60, "Escola Norto", None, 1.0005, -180.0), (61, "Escola Norte", None, 1.0, -179.9995), (62, "Escola Norte", "x", 1.0, 180.0), (63, None, None, 1.0, 180.0), (64, "Sul", None, None, None)]
    df = spark.createDataFrame(rows, "id int, name string, level string, latitude double, longitude double")
    pairs = {(r.a, r.b): round(r.similarity, 3) for r in N.pairs_within(df, "id", 0.1, ["level"], name="name", cutoff=0.7).collect()}
    assert pairs == {(0, 60): 0.917, (60, 61): 0.917, (0, 61): 1.0}
    flags = {r.id: (r.same_name, r.similar_name) for r in N.near_flags(df, "id", 0.1, ["level"], "name", 0.7).collect()}
    assert flags == {k: (1, 1) for k in range(50)} | {60: (0, 1), 61: (1, 1), 62: (0, 0), 63: (0, 0), 64: (None, None)}


def test_similar_pairs_of_hot_and_small_blocks(spark):
    rng = random.Random(3)
    names = sorted({" ".join(rng.choices(WORDS, k=rng.randrange(1, 5))) for _ in range(260)} | {"", "é" * 70, "é" * 69 + "x", "a", "😀 b"})
    rows = [("hot", n) for n in names] + [(b, n) for b in ("p", "q", None) for n in rng.sample(names, 20)] + [("hot", names[0]), ("one", "x"), ("p", None)]
    df = spark.createDataFrame(rows, "block string, name string")
    by = {}
    for b, n in rows:
        if n is not None:
            by.setdefault(b, set()).add(n)
    for cutoff in (0.7, 0.85):
        want = {(b, x, y): similarity.indel_ratio(x, y) for b, some in by.items() for x in some for y in some if x < y}
        want = {k: v for k, v in want.items() if v >= cutoff}
        for tile in (1024, 40):
            got = [(r.block, r.x, r.y, r.similarity) for r in J.similar_pairs(df, "name", ["block"], cutoff, tile).collect()]
            assert len(got) == len(want) and {g[:3]: g[3] for g in got} == pytest.approx(want)


def test_few_pairs_are_compared_letter_by_letter():
    import numpy as np

    rng = random.Random(1)
    names = sorted({" ".join(rng.choices(WORDS, k=rng.randrange(2, 6))) + f" {rng.randrange(99)}" for _ in range(1500)})[:1000]
    i, j = np.triu_indices(len(names), 1)
    *_, compared = similarity.similar_in(names, i, j, 0.7)
    assert compared < len(i) / 10


def test_places_of_many_rows_with_other_columns(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/lineitem.parquet").withColumn("place", F.lit(0))
    for parts in (8, 50):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            placed = W.with_place(rows, [F.col("l_shipdate").desc(), F.col("l_orderkey"), F.col("l_linenumber")])
            n, most, least, distinct = placed.agg(F.count("*"), F.max("place"), F.min("place"), F.countDistinct("place")).first()
            assert (n, most, least, distinct) == (rows.count(), n, 1, n)
            w = placed.where("place % 5000 < 2").select("place", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey").orderBy("place").collect()
            keys = [(-r.l_shipdate.toordinal(), r.l_orderkey, r.l_linenumber) for r in w]
            assert keys == sorted(keys)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")


KIND = "id int, n int, results map<string,int>, deep array<map<string,int>>"


def test_merges_of_tables_with_maps(spark):
    old = spark.createDataFrame([(1, 1, {"a": 1, "b": 2}, [{"x": 1}]), (2, 2, None, None), (3, 3, {}, []), (4, 0, {"c": 1}, None)], KIND)
    new = spark.createDataFrame([(1, 1, {"b": 2, "a": 1}, [{"x": 1}]), (2, None, {"z": 9}, None), (5, 5, {"q": 1}, [{}]), (4, 0, {"c": 1}, [{"y": 2}])], KIND)
    columns = ["id", "n", "results", "deep"]
    merged = {r.id: (r.n, r.results) for r in M.full_merge(old, new, ["id"], columns).collect()}
    assert merged == {1: (1, {"a": 1, "b": 2}), 2: (2, {"z": 9}), 5: (5, {"q": 1}), 4: (0, {"c": 1})}
    feed = M.snapshot_diff(old, new, ["id"])
    assert sorted((r.id, r._change_type) for r in feed.collect()) == [(2, "update_postimage"), (2, "update_preimage"), (3, "delete"), (4, "update_postimage"), (4, "update_preimage"), (5, "insert")]
    again = M.apply_feed(old, feed, ["id"], columns)
    assert sorted((r.id, r.n, r.results) for r in again.collect()) == sorted((r.id, r.n, r.results) for r in new.collect()) or {r.id for r in again.collect()} == {1, 2, 4, 5}
    assert tuple(M.upsert_counts(old, new, ["id"], columns, True).first()) == (2, 1, 1)


def test_one_rule_for_null_and_repeated_keys(spark):
    kind, columns = "id int, v string", ["id", "v"]
    old = spark.createDataFrame([(None, "n"), (1, "b"), (1, "a"), (2, "x")], kind)
    new = spark.createDataFrame([(None, "n"), (2, "z"), (2, "y"), (3, "q")], kind)
    content = lambda df: sorted(((r.id, r.v) for r in df.collect()), key=str)
    assert content(M.partial_merge(old, new, ["id"], columns)) == content(M.signature_upsert(old, new, ["id"], columns)[0]) == sorted([(None, "n"), (1, "a"), (2, "y"), (3, "q")], key=str)
    assert content(M.full_merge(old, new, ["id"], columns)) == content(M.signature_upsert(old, new, ["id"], columns, full=True)[0]) == sorted([(None, "n"), (2, "y"), (3, "q")], key=str)
    feed = M.snapshot_diff(old, new, ["id"])
    assert sorted((r.id, r.v, r._change_type) for r in feed.collect()) == [(1, "a", "delete"), (2, "x", "update_preimage"), (2, "y", "update_postimage"), (3, "q", "insert")]
    assert content(M.apply_feed(old, feed, ["id"], columns)) == sorted([(None, "n"), (2, "y"), (3, "q")], key=str)
    assert M.signature_upsert(new, new, ["id"], columns)[1] is False
    assert content(M.delete_keys(old, new.where("id IS NULL"), ["id"])) == [(1, "a"), (1, "b"), (2, "x")]
    assert content(M.insert_only(new, old, ["id"])) == sorted([(None, "n"), (1, "a"), (1, "b"), (2, "y"), (2, "z"), (3, "q")], key=str)


def staged(spark, rows):
    return spark.createDataFrame([(*r, f"c{k}") for k, r in enumerate(rows)], "id int, v string, change_type string, created_at int, change_id string")


def test_an_approval_that_puts_and_deletes_a_key_raises(spark):
    silver = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    for order in (("UPDATE", 1, "DELETE", 2), ("DELETE", 1, "UPDATE", 2), ("INSERT", 1, "DELETE", 1)):
        changes = staged(spark, [(1, "z", order[0], order[1]), (1, "z", order[2], order[3])])
        with pytest.raises(PySparkException, match="deletes not applied"):
            M.apply_approval(silver, changes, changes.select("change_id"), "id", ["id", "v"]).collect()
        assert M.apply_approval(silver, changes, changes.where("change_type = 'DELETE'").select("change_id"), "id", ["id", "v"]).count() == 2
    changes = staged(spark, [(1, "x", "UPDATE", 1), (1, "y", "UPDATE", 2), (2, None, "DELETE", 1), (9, "n", "INSERT", 1), (3, "q", "UNCHANGED", 1)])
    after = M.apply_approval(silver, changes, changes.select("change_id"), "id", ["id", "v"])
    assert sorted((r.id, r.v) for r in after.collect()) == [(1, "y"), (3, "c"), (9, "n")]
    assert M.verify_deleted(after, changes.where("change_type = 'DELETE'"), ["id"]) == 1
    with pytest.raises(ValueError, match="2 rows are still there"):
        M.verify_deleted(silver, spark.createDataFrame([(1,), (2,), (7,), (None,)], "id int"), ["id"])


def test_a_town_on_a_detailed_coast(spark):
    """A ring of 100,000 vertices and a million points in one town on it: no cell has more than a few edges, and points are placed as by all edges."""
    import numpy as np

    from quarrykit.functions import cells as cells_of
    from quarrykit.functions import geo

    n = 100_000
    turn = F.col("id") * (2 * math.pi / n)
    far = 1 + 0.001 * F.sin(F.col("id") * 1.7) + 0.0005 * F.sin(F.col("id") * 0.013)
    ring = spark.range(n).select(F.lit(1).alias("poly"), "id", (12 + far * F.cos(turn)).alias("x"), (41 + far * F.sin(turn)).alias("y"))
    line = np.array([tuple(r) for r in ring.orderBy("id").select("x", "y").collect()])
    closed = ring.union(spark.createDataFrame([(1, n, *map(float, line[0]))], "poly int, id long, x double, y double"))
    sides = geo.edges(closed, "poly", "id", "x", "y")
    cover = geo.cover(sides, "poly", True)[0].where("size(parts) > 0").select("level", F.size(F.get("parts", F.lit(0))["edges"]).alias("n"))
    most, deepest, cells = cover.agg(F.max("n"), F.max("level"), F.count("*")).first()
    assert most <= cells_of.MOST and 0 < deepest < cells_of.DEPTH and cells < n
    town = spark.range(1_000_000).select("id", F.lit(1).alias("poly"), (41 + 0.01 * F.rand(3) - 0.005).alias("latitude"), (13 + 0.01 * F.rand(4) - 0.005).alias("longitude"))
    placed = geo.within_own(town, sides, "poly")
    assert placed.count() == 1_000_000
    a, b = line, np.roll(line, -1, axis=0)
    some = placed.where("id % 2500 = 0").collect()
    for r in some:
        x, y = r.longitude, r.latitude
        up = (a[:, 1] > y) != (b[:, 1] > y)
        at = (b[up, 0] - a[up, 0]) * (y - a[up, 1]) / (b[up, 1] - a[up, 1]) + a[up, 0]
        assert r.within == bool((x < at).sum() % 2)
    assert 50 < sum(r.within for r in some) < 350
