"""Sinks. Tables are Parquet; versions of a table are folders beside each other (`Snapshots`)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.project import col
from ..operators.schema import void_to_string
from ..operators.shared import new_folder  # noqa: F401  callers know it from here

#: Rows of a file that is written in order.
FILE_ROWS = 2_000_000


def overwrite(df: DataFrame, path: str, kind: str = "parquet") -> None:
    writer = void_to_string(df).write.mode("overwrite")
    (writer.option("header", True).option("escape", '"') if kind == "csv" else writer).format(kind).save(path)


def single_file(df: DataFrame, path: str, kind: str = "csv") -> None:
    """One part file, for results that people take away: one task writes it."""
    overwrite(df.coalesce(1), path, kind)


def append_merging(df: DataFrame, path: str) -> None:
    """Appends; columns may be new. read_merged reads all files with all columns."""
    void_to_string(df).write.mode("append").parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def create_table(spark: SparkSession, name: str, df: DataFrame, partitions: Sequence[str] = (), *, if_not_exists: bool = False, replace: bool = False) -> bool:
    """An empty table of df's schema. if_not_exists or replace, not both. Whether it was made."""
    if if_not_exists and replace:
        raise ValueError("if_not_exists or replace, not both")
    if if_not_exists and spark.catalog.tableExists(name):
        return False
    writer = df.limit(0).write.format("parquet").mode("overwrite" if replace else "errorifexists")
    (writer.partitionBy(*partitions) if partitions else writer).saveAsTable(name)
    return True


def overwrite_or_truncate(df: DataFrame, path: str) -> bool:
    """Overwrites; a result without rows leaves an empty table of its schema. Whether there were rows."""
    some = not df.isEmpty()
    overwrite(df if some else df.limit(0), path)
    return some


def replace_partitions(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Replaces only the partitions that df has: rows of one upload, or of the dates that a merge touched."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def error_rows(df: DataFrame, upload_id: str, file_name: str, dataset: str, country: str, at: Column) -> DataFrame:
    """Failed rows with where they came from, for replace_partitions by upload_id."""
    return df.withColumns({"upload_id": F.lit(upload_id), "file_name": F.lit(file_name), "dataset": F.lit(dataset), "country_code": F.lit(country), "created_at": at})


def summary_json(df: DataFrame, path: str) -> None:
    """Rows as lines of JSON."""
    df.select(F.to_json(F.struct(*(col(c) for c in df.columns))).alias("value")).write.mode("overwrite").text(path)


def compact(spark: SparkSession, path: str, to: str, key: str, partitions: int, rows: int = FILE_ROWS) -> None:
    """Rewrites a table clustered by a key, so that files have narrow ranges of it: so many files at least, and more where they would have over `rows` rows, since a task sorts a file."""
    df = spark.read.parquet(path)
    files = max(partitions, -(-df.count() // rows))
    df.repartitionByRange(files, key).sortWithinPartitions(key).write.mode("overwrite").parquet(to)


def split_by(df: DataFrame, path: str, column: str) -> None:
    """One folder a value."""
    df.write.mode("overwrite").partitionBy(column).parquet(path)


class Snapshots:
    """Versions of a table as folders v=0, v=1, ...; the listing is asked of the file system of the path."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[int]:
        jvm = self.spark._jvm
        place = jvm.org.apache.hadoop.fs.Path(self.path)
        files = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(place):
            return []
        names = [s.getPath().getName() for s in files.listStatus(place)]
        return sorted(int(n[2:]) for n in names if n.startswith("v=") and files.exists(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{n}/_SUCCESS")))

    def latest(self) -> int | None:
        return max(self.versions(), default=None)

    def read(self, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/v={self.latest() if version is None else version}")

    def publish(self, df: DataFrame) -> int:
        """Writes a new version; readers see it once it is whole."""
        version = -1 if (last := self.latest()) is None else last
        void_to_string(df).write.parquet(f"{self.path}/v={version + 1}")
        return version + 1

    def restore(self, version: int) -> int:
        return self.publish(self.read(version))

    def changes(self, since: int, keys: Sequence[str]) -> DataFrame:
        """The change feed of all versions after `since`."""
        from ..operators.merge import snapshot_diff
        from ..operators.windows import union_by_name

        later = [v for v in self.versions() if v > since]
        return union_by_name([snapshot_diff(self.read(v - 1), self.read(v), keys, v) for v in later if v])
