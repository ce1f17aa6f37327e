"""Duplicates of an upload against all that is stored, from counts that are kept, so that stored rows aren't counted again.

For each check (a name and the columns that make its key) a table has the number of rows of each key, by two hashes of it. An upload adds its counts as one more folder, deletes add theirs below zero; a count is the
sum of its parts. An upload that is run again takes the place of its own folder, so counts don't grow by it. Flags of an upload come of a join with the keys that it has; `fold` makes a table of one folder."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .project import col, free

#: One folder of the table for each upload; that of folded ones.
UPLOAD, FOLDED = "upload", "folded"


def key_hashes(columns: Sequence[str]) -> tuple[Column, Column]:
    """Two hashes of a key, null where a column of it is null. 1 and '1' are different keys, as their columns are."""
    there = reduce(lambda a, b: a & b, (col(c).isNotNull() for c in columns))
    return tuple(F.when(there, F.xxhash64(F.lit(seed), *(col(c) for c in columns))) for seed in (1, 2))


def key_counts(df: DataFrame, checks: Mapping[str, Sequence[str]], sign: int = 1) -> DataFrame:
    """check, one, two, n: rows of each key that isn't null, from one pass over df with partial sums."""
    each = F.array(*(F.struct(F.lit(name).alias("check"), *(h.alias(n) for h, n in zip(key_hashes(columns), ("one", "two"), strict=True))) for name, columns in checks.items()))
    keys = df.select(F.explode(each).alias("k")).select("k.*").where("one IS NOT NULL")
    return keys.groupBy("check", "one", "two").agg((F.count(F.lit(1)) * sign).alias("n"))


class KeptCounts:
    """The table of counts at a path."""

    def __init__(self, spark: SparkSession, path: str, checks: Mapping[str, Sequence[str]]) -> None:
        self.spark, self.path, self.checks = spark, path.rstrip("/"), dict(checks)

    def add(self, upload: str, rows: DataFrame | None = None, deleted: DataFrame | None = None) -> None:
        """The counts of an upload's new rows and of the stored rows that it deletes."""
        parts = [key_counts(df, self.checks, sign) for df, sign in ((rows, 1), (deleted, -1)) if df is not None]
        whole = reduce(DataFrame.unionByName, parts).groupBy("check", "one", "two").agg(F.sum("n").alias("n")).where("n <> 0")
        whole.write.mode("overwrite").parquet(f"{self.path}/{UPLOAD}={upload}")

    def counts(self) -> DataFrame:
        """check, one, two, n of all keys that are there."""
        parts = self.spark.read.option("basePath", self.path).schema("check string, one bigint, two bigint, n bigint, upload string").parquet(self.path)
        return parts.groupBy("check", "one", "two").agg(F.sum("n").alias("n")).where("n > 0")

    def flagged(self, upload: DataFrame, prefix: str = "dq_duplicate-") -> DataFrame:
        """upload and, for each check, 1 where its key is on more than one row of all that are stored, this upload's among them (add it first), else 0; null keys are none.

        Only counts of keys that the upload has, and that more than one row has, are joined to it."""
        wanted = key_counts(upload, self.checks).select("check", "one", "two")
        repeated = self.counts().where("n > 1").join(wanted, ["check", "one", "two"], "left_semi")
        out = upload
        for name, columns in self.checks.items():
            one, two = free(out, "_one"), free(out, "_two")
            some = repeated.where(F.col("check") == name).select(F.col("one").alias(one), F.col("two").alias(two))
            a, b = key_hashes(columns)
            out = out.join(some, (a == F.col(one)) & (b == F.col(two)), "left").withColumn(f"{prefix}{name}", F.col(one).isNotNull().cast("int")).drop(one, two)
        return out

    def fold(self, to: str) -> KeptCounts:
        """The table with all folders as one, at another path; this one stays as it is, for readers that still have it."""
        self.counts().write.mode("overwrite").parquet(f"{to.rstrip('/')}/{UPLOAD}={FOLDED}")
        return KeptCounts(self.spark, to, self.checks)
