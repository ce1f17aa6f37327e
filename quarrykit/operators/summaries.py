"""Summaries that merge: rows of a source, country and day are summed up once, and any range is told from those rows, without reading the data again.

A day's summary has counts, bounds and sums, which merge exactly, and two sketches: of distinct ids (HyperLogLog, relative standard error about 1.04 / sqrt(2 ** LG_IDS), 0.8 % at 14) and of a value's
quantiles (KLL, rank error about 1 % at 400). Sketches of any days are merged by their own aggregates, so that the result doesn't depend on how rows were dealt out to days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .project import col

#: Binary logarithm of the number of registers for distinct ids; size of a quantile sketch.
LG_IDS, K_VALUES = 14, 400


def day_summaries(df: DataFrame, keys: Sequence[str], time: str, id_col: str, value: Column | str | None = None) -> DataFrame:
    """One row for each of the keys and each day of `time`: rows, first, last, ids (sketch) and, of the value, n, least, most, total, values (sketch)."""
    number = col(value).cast("double") if value is not None else F.lit(None).cast("double")
    return df.groupBy(*(col(k) for k in keys), F.to_date(col(time)).alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(col(time)).alias("first"), F.max(col(time)).alias("last"), F.hll_sketch_agg(col(id_col).cast("string"), F.lit(LG_IDS)).alias("ids"),
        F.count(number).alias("n"), F.min(number).alias("least"), F.max(number).alias("most"), F.sum(number.cast("decimal(38,6)")).alias("total"), F.kll_sketch_agg_double(number, F.lit(K_VALUES)).alias("values"),
    )


def merged(summaries: DataFrame, by: Sequence[str], since: Column | None = None, until: Column | None = None, ranks: Sequence[float] = (0.5,)) -> DataFrame:
    """Of the days of [since, until], for each value of `by` (any of the keys, or none): rows, first, last, n, least, most, total, mean, all exact; ids, the estimated number of distinct ids; and the value's quantiles as an array."""
    some = summaries if since is None else summaries.where(F.col("day") >= since)
    some = some if until is None else some.where(F.col("day") <= until)
    whole = some.groupBy(*(col(k) for k in by)).agg(
        F.sum("rows").alias("rows"), F.min("first").alias("first"), F.max("last").alias("last"), F.hll_sketch_estimate(F.hll_union_agg("ids")).alias("ids"),
        F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"), F.sum("total").alias("total"), F.kll_merge_agg_double("values").alias("_values"),
    )
    quantiles = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("_values", F.array(*(F.lit(float(r)) for r in ranks))))
    return whole.withColumns({"mean": (F.col("total") / F.col("n")).cast("double"), "quantiles": quantiles}).drop("_values")
