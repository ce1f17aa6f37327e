"""Reports over checks, and other aggregates."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .project import col


def check_counts(df: DataFrame, results: str | None = None, prefix: str = "dq_", groups: Sequence[str] = ()) -> DataFrame:
    """check_key, count_failed, count_passed, count_overall of all check columns, or of a map of them.

    Flat columns are counted side by side in one aggregate, then turned into rows, so that rows of data aren't multiplied."""
    if results:
        rows = df.select(*groups, F.explode(results).alias("check_key", "v"))
        counted = rows.groupBy(*groups, "check_key").agg(F.count_if(F.col("v") == 1).alias("count_failed"), F.count_if(F.col("v") == 0).alias("count_passed"))
    else:
        checks = [c for c, t in df.dtypes if c.startswith(prefix) and t in ("int", "bigint")]
        each = [F.struct(F.lit(c[len(prefix) :]).alias("check_key"), F.count_if(col(c) == 1).alias("count_failed"), F.count_if(col(c) == 0).alias("count_passed")) for c in checks]
        counted = df.groupBy(*groups).agg(F.array(*each).alias("_each")).select(*groups, F.inline("_each"))
    return counted.withColumn("count_overall", F.col("count_failed") + F.col("count_passed"))


def check_report(df: DataFrame, results: str | None = None, meta: DataFrame | None = None, how: str = "left", groups: Sequence[str] = ()) -> DataFrame:
    """Counts with shares in percent, remark, assertion and column, and the metadata of checks (check_key, type)."""
    share = lambda c: F.when(F.col("count_overall") > 0, F.round(F.col(c) * 100.0 / F.col("count_overall"), 2)).otherwise(F.lit(0.0))
    cut = F.split("check_key", "-", 2)
    made = check_counts(df, results, groups=groups).select(
        *groups, "check_key", F.element_at(cut, 1).alias("assertion"), F.coalesce(F.try_element_at(cut, F.lit(2)), F.lit("")).alias("column"), "count_failed", "count_passed", "count_overall",
        share("count_failed").alias("percent_failed"), share("count_passed").alias("percent_passed"), F.when(F.col("count_failed") == 0, "pass").otherwise("fail").alias("dq_remarks"),
    )
    return made if meta is None else made.join(meta.select("check_key", "type"), "check_key", how)


def dataset_summary(df: DataFrame, critical: str = "dq_has_critical_error", warnings: Iterable[str] = (), imprecise: Iterable[str] = (), is_new: str = "is_new", columns: int | None = None) -> DataFrame:
    """One row: rows, passed, failed, passed with warnings, low precision, created, updated, columns. One pass."""
    hit = lambda names: reduce(lambda a, b: a | b, (F.coalesce(col(n) == 1, F.lit(False)) for n in names), F.lit(False))
    ok = F.coalesce(col(critical) == 0, F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(ok).alias("rows_passed"), F.count_if(~ok).alias("rows_failed"), F.count_if(ok & hit(warnings)).alias("rows_passed_with_warnings"),
        F.count_if(hit(imprecise)).alias("rows_low_precision"), F.count_if(ok & col(is_new)).alias("rows_created"), F.count_if(ok & ~col(is_new)).alias("rows_updated"),
        F.lit(columns if columns is not None else len([c for c in df.columns if not c.startswith("dq_")])).cast("bigint").alias("columns"),
    )


def sections(report: DataFrame) -> DataFrame:
    """The report's checks by type, each section a sorted list of structs. A report has a row a check."""
    return report.groupBy("type").agg(F.sort_array(F.collect_list(F.struct("check_key", "count_failed", "count_passed"))).alias("checks"))


def value_map_report(df: DataFrame, source: str, target: str) -> DataFrame:
    """Pairs of source and target value with count and share, most frequent first."""
    pairs = df.groupBy(col(source).alias("source"), col(target).alias("target")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # of a row a pair
    return pairs.select("source", "target", "n", F.round(F.col("n") * 100.0 / total, 2).alias("percent")).orderBy(F.desc("n"), "source", "target")


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """column, nulls: one pass."""
    each = F.array(*(F.struct(F.lit(c).alias("column"), F.count_if(col(c).isNull()).alias("nulls")) for c in columns or df.columns))
    return df.agg(each.alias("_e")).select(F.inline("_e"))


def bounds(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    return df.agg(*(f(c).alias(f"{n}_{c}") for c in (lat, lon) for n, f in (("min", F.min), ("max", F.max))), F.avg(lat).alias("centre_latitude"), F.avg(lon).alias("centre_longitude"))


def first_times(df: DataFrame, keys: Sequence[str], time: str, out: str = "first_time") -> DataFrame:
    return df.groupBy(*keys).agg(F.min(time).alias(out))


def summary_by(df: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(id_col).alias("ids"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, n, least, most, mean of numeric columns in one pass."""
    each = F.array(*(F.struct(F.lit(c).alias("column"), F.count(c).alias("n"), F.min(c).cast("double").alias("least"), F.max(c).cast("double").alias("most"), F.avg(c).alias("mean")) for c in columns))
    return df.agg(each.alias("_e")).select(F.inline("_e"))


def high_water(df: DataFrame, time: str) -> DataFrame:
    return df.agg(F.max(time).alias("high_water"))


def cross_counts(df: DataFrame, row: Column, pivot: str, values: Sequence) -> DataFrame:
    return df.groupBy(row.alias("row")).pivot(pivot, list(values)).count().na.fill(0)
