"""Pairs of rows within a distance of each other.

The globe is cut into bands of latitude and each band into cells, both at least as wide as the distance. A row is at home in its cell, and a guest in those cells east of it and in the band north of it that
its distance reaches; two rows within the distance are then together in exactly one cell, at least one of them at home: that of the more northern one, or of the eastern one of a band. Cells of a band close
around the 180th meridian. So candidates come from an equality on cells, and the distance is worked out for each once. Rows that are equal in all that is compared are one class, known by its smallest id: a class
of n rows gives n - 1 links to it, not all pairs."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import EARTH_KM, distance_km
from .joins import similar_pairs
from .project import col
from .windows import no_location


def with_cells(df: DataFrame, km: float, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Each row with coordinates (in degrees, of any turn) once for each cell: _band, _cell, _home."""
    high = math.degrees(km / EARTH_KM) * (1 + 1e-9) + 1e-9
    bands = max(1, math.floor(180 / (high * 1.01)))
    tall = 180 / bands
    band = lambda y: F.least(F.floor((y + 90) / tall), F.lit(bands - 1)).cast("bigint")
    # cells of a band: as many as are wider than the distance reaches at its edge nearest to a pole, which is asin(sin(high) / cos(edge)) and at most pi / 2 times high / cos(edge); one where fewer than three are
    edge = lambda b: F.radians(F.least(F.greatest(F.abs(b * tall - 90), F.abs((b + 1) * tall - 90)), F.lit(90.0)))
    wide = lambda b, more: F.floor(F.lit(360.0) * F.cos(edge(b)) / (high * more)).cast("bigint")
    cells = lambda b: F.when(wide(b, 1.001) >= 90, wide(b, 1.001)).when(wide(b, 1.6) >= 3, wide(b, 1.6)).otherwise(F.lit(1).cast("bigint"))
    y, x = F.col("_lat"), F.col("_lon")
    turned = lambda c: F.pmod(c + 180, F.lit(360.0))
    own = F.least(F.floor(turned(x) / 360 * cells(F.col("_band"))), cells(F.col("_band")) - 1).cast("bigint")
    # how far east or west the distance reaches at most
    near_pole = F.abs(y) + high >= 90
    reach = F.when(near_pole, F.lit(180.0)).otherwise(F.degrees(F.asin(F.least(F.sin(F.radians(F.lit(high))) / F.cos(F.radians(y)), F.lit(1.0)))) + 1e-9)
    n, above = cells(F.col("_band")), cells(F.col("_band") + 1)
    east = F.when((n > 1) & (turned(x) + reach >= (F.col("_own") + 1) * 360.0 / n), F.array(F.struct(F.col("_band").alias("b"), F.pmod(F.col("_own") + 1, n).alias("c")))).otherwise(F.array())
    from_cell, to_cell = F.floor((turned(x) - reach) / 360 * above).cast("bigint"), F.floor((turned(x) + reach) / 360 * above).cast("bigint")
    across = F.sequence(from_cell, F.least(to_cell, from_cell + above - 1))
    north = F.when((F.col("_band") + 1 < bands) & (y + high >= (F.col("_band") + 1) * tall - 90), F.transform(across, lambda c: F.struct((F.col("_band") + 1).alias("b"), F.pmod(c, above).alias("c")))).otherwise(F.array())
    there = df.where(~no_location(lat, lon)).withColumns({"_lat": col(lat).cast("double"), "_lon": col(lon).cast("double")}).where("_lat BETWEEN -90 AND 90")
    there = there.withColumn("_band", band(y)).withColumn("_own", own)
    home = F.array(F.struct(F.col("_band").alias("b"), F.col("_own").alias("c"), F.lit(True).alias("h")))
    guest = F.transform(F.array_union(east, north), lambda s: F.struct(s["b"].alias("b"), s["c"].alias("c"), F.lit(False).alias("h")))
    placed = there.withColumn("_at", F.explode(F.concat(home, guest)))
    return placed.withColumns({"_band": F.col("_at.b"), "_cell": F.col("_at.c"), "_home": F.col("_at.h")}).drop("_at", "_own")


def classes(df: DataFrame, id_col: str, columns: Sequence[str]) -> DataFrame:
    """first, size and the columns: one row for rows that are equal in all of them (null-safe)."""
    return df.groupBy(*(col(c) for c in columns)).agg(F.min(id_col).alias("first"), F.count(F.lit(1)).alias("size"))


def members(df: DataFrame, groups: DataFrame, id_col: str, columns: Sequence[str]) -> DataFrame:
    """id and first, size of its class, for each row."""
    held = groups.select(*(F.col(c).alias(f"_m{n}") for n, c in enumerate(columns)), "first", "size")
    return df.join(held, reduce(lambda a, b: a & b, (df[c].eqNullSafe(F.col(f"_m{n}")) for n, c in enumerate(columns)))).select(id_col, "first", "size")


def pairs_within(df: DataFrame, id_col: str, km: float, equal: Sequence[str] = (), lat: str = "latitude", lon: str = "longitude", name: str | None = None, cutoff: float = 1.0) -> DataFrame:
    """a, b, km, similarity: pairs of different classes (their smallest ids, a < b) within the distance, equal in the columns `equal` (null to null), whose names have an indel ratio of the cut-off or
    more; at 1, equal names. Rows without coordinates or without a name meet none."""
    columns = [*equal, *([name] if name else []), lat, lon]
    groups = classes(df.where(col(name).isNotNull()) if name else df, id_col, columns)
    placed = with_cells(groups, km, lat, lon)
    cell = ["_band", "_cell", *equal]
    same = lambda names: reduce(lambda p, q: p & q, (F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in names))
    apart = distance_km(F.col("x._lat"), F.col("x._lon"), F.col("y._lat"), F.col("y._lon"))
    once = (F.col("x._home") | F.col("y._home")) & (apart <= km)
    out = [F.least("x.first", "y.first").alias("a"), F.greatest("x.first", "y.first").alias("b"), apart.alias("km")]
    alike = placed.alias("x").join(placed.alias("y"), same([*cell, *([name] if name else [])]) & (F.col("x.first") < F.col("y.first")) & once).select(*out, F.lit(1.0).alias("similarity"))
    if not name or cutoff >= 1:
        return alike
    # the names of a cell that are alike, then the rows that have them
    found = similar_pairs(placed, name, cell, cutoff).where("similarity < 1").alias("n")
    first = placed.alias("x").join(found, reduce(lambda p, q: p & q, (F.col(f"x.{c}").eqNullSafe(F.col(f"n.{c}")) for c in cell), F.col(f"x.{name}") == F.col("n.x")))
    both = first.join(placed.alias("y"), same(cell) & (F.col(f"y.{name}") == F.col("n.y")) & once)
    return alike.unionByName(both.select(*out, F.col("n.similarity").alias("similarity")))


def near_flags(df: DataFrame, id_col: str, km: float, equal: Sequence[str], name: str, cutoff: float, lat: str = "latitude", lon: str = "longitude", same_name: str = "same_name", similar_name: str = "similar_name") -> DataFrame:
    """df and two flags, null without coordinates: whether another row within the distance has the same name, or one of the cut-off or more, equal names among them. Links are of classes, so rows that
    repeat cost nothing."""
    columns = [*equal, name, lat, lon]
    pairs = pairs_within(df, id_col, km, equal, lat, lon, name, cutoff)
    ends = pairs.select(F.explode(F.array("a", "b")).alias("first"), (F.col("similarity") == 1).cast("int").alias("same")).groupBy("first").agg(F.max("same").alias("same"))
    groups = classes(df.where(col(name).isNotNull()), id_col, columns)
    told = groups.join(ends, "first", "left").select(*columns, (F.coalesce("same", F.lit(0)) == 1).alias("_same"), F.col("same").isNotNull().alias("_near"), (F.col("size") > 1).alias("_repeats"))
    told = told.select(*(F.col(c).alias(f"_m{n}") for n, c in enumerate(columns)), (F.col("_same") | F.col("_repeats")).alias("_same"), (F.col("_near") | F.col("_repeats")).alias("_near"))
    joined = df.join(told, reduce(lambda a, b: a & b, (df[c].eqNullSafe(F.col(f"_m{n}")) for n, c in enumerate(columns))), "left")
    flag = lambda c: F.when(~no_location(lat, lon), F.coalesce(c, F.lit(False)).cast("int"))
    return joined.withColumns({same_name: flag(F.col("_same")), similar_name: flag(F.col("_near"))}).drop("_same", "_near", *(f"_m{n}" for n in range(len(columns))))
