"""Windows, sorts, dedup and set operations."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .project import col, free, without
from .shared import cut


def no_location(lat: str = "latitude", lon: str = "longitude") -> Column:
    bad = lambda c: col(c).isNull() | F.isnan(col(c).try_cast("double"))
    return bad(lat) | bad(lon)


def with_group_size(df: DataFrame, keys: Sequence[Column | str], out: str, at_least: int = 2, base: DataFrame | None = None) -> DataFrame:
    """Size of each row's group where it reaches at_least, else null; null keys make groups as in a window.

    Groups are counted with partial sums before the shuffle, and only those that reach the size are joined back: few of
    them mean a broadcast, and a hot group is one row of the count, not one task's rows. Counts are taken of `base`, rows of which df
    was made by adding columns: a chain of such steps then reads the base once a step, instead of repeating all steps before."""
    names = [f"_k{i}" for i in range(len(keys))]
    sizes = (df if base is None else base).groupBy(*(col(k).alias(n) for k, n in zip(keys, names, strict=True))).agg(F.count(F.lit(1)).alias(out)).where(F.col(out) >= at_least)
    same = reduce(lambda a, b: a & b, (col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names, strict=True)))
    return df.join(sizes, same, "left").drop(*names)


def numbered(df: DataFrame, keys: Sequence[str], order: Iterable[Column], out: str = "row_num") -> DataFrame:
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Iterable[Column]) -> DataFrame:
    return numbered(df, keys, order, "_nth").where("_nth = 1").drop("_nth")


def last_before(events: DataFrame, key: str, time: str, value: str, cutoff: Column, tie: str) -> DataFrame:
    """Each key's last value before the cut-off; ties of time go to the greatest tie. One row a key, by partial aggregate."""
    last = events.where(col(time) < cutoff).groupBy(key).agg(F.max(F.struct(col(time), col(tie), col(value))).alias("_last"))
    return last.select(key, F.col(f"_last.{time}").alias(time), F.col(f"_last.{value}").alias(value))


def with_next(events: DataFrame, key: str, time: str, value: str, tie: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(time, tie)
    return events.withColumns({f"next_{value}": F.lead(value).over(w), f"next_{time}": F.lead(time).over(w)})


def count_per_key(df: DataFrame, keys: Sequence[str], out: str = "count") -> DataFrame:
    return df.withColumn(out, F.count(F.lit(1)).over(Window.partitionBy(*keys)))


def ids_first(df: DataFrame, ids: Sequence[str], flag: str, others: Sequence[str] = ()) -> DataFrame:
    """ids, flag and others first in column order, rows with the flag set on top, then by id."""
    front = [*(i for i in ids if i in df.columns), flag, *others]
    return df.select(*front, *(c for c in df.columns if c not in front)).orderBy(col(flag).desc(), *(i for i in ids if i in df.columns))


def with_place(df: DataFrame, order: Sequence[Column], out: str = "place") -> DataFrame:
    """The place (from 1) of each row in an order, without a window over all rows: rows are dealt to
    ranges of the order, counted in each, and offset by the counts of the ranges before, of which there is one row each.

    Bounds of ranges are sampled, anew by each plan that asks for them, so the dealt rows are checkpointed before they are counted and placed. Ties have any order among them, but one
    place each."""
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number, count, before, nth = (free(df, n) for n in ("_range", "_n", "_before", "_nth"))
    dealt = cut(df.repartitionByRange(ranges, *order).withColumn(number, F.spark_partition_id()))
    sizes = dealt.groupBy(number).agg(F.count(F.lit(1)).alias(count))
    offsets = sizes.select(number, (F.sum(count).over(Window.orderBy(number)) - F.col(count)).alias(before))
    placed = dealt.withColumn(nth, F.row_number().over(Window.partitionBy(number).orderBy(*order)))
    return placed.join(offsets, number).withColumn(out, F.col(nth) + F.col(before)).select(*(col(c) for c in without(df.columns, out)), out)


def latest(df: DataFrame, version: str) -> DataFrame:
    return df.orderBy(col(version).desc()).limit(1)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    return df.limit(n)


def exists(df: DataFrame) -> bool:
    return not df.isEmpty()


def union_by_name(frames: Sequence[DataFrame], missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=missing), frames)
