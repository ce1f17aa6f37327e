"""Versions of a table with digests, so that what didn't change isn't read again.

A version's rows lie in buckets by a hash of their keys, a folder each. Beside the version stands a digest of each bucket: number of rows and, over hashes of whole rows, two sums and an exclusive or, none of which depends
on the order of rows. The change feed between two versions reads the digests, a row a bucket, and then only buckets whose digests differ. Of equal digests, rows are equal but for a chance of some 2^-128."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import KIND, VERSION, snapshot_diff
from ..operators.project import col, comparable, free
from ..operators.schema import void_to_string
from ..operators.windows import union_by_name
from .sinks import FILE_ROWS, Snapshots

BUCKET = "_bucket"
#: Rows of a bucket that a table's first version aims at, and most buckets: each is a row of the driver's when versions are compared.
ROWS, MOST = 1_000_000, 4096


def row_hash(df: DataFrame, columns: Sequence[str], seed: int) -> Column:
    """Of the columns in this order with their names; nulls count by place, maps by their entries."""
    text = F.to_json(F.struct(*(comparable(df, c).alias(c) for c in columns)), {"ignoreNullFields": "false"})
    return F.xxhash64(F.lit(seed), text)


def digests(df: DataFrame, bucket: str = BUCKET) -> DataFrame:
    """bucket, rows and three numbers for each bucket of df."""
    columns = sorted(c for c in df.columns if c != bucket)
    first, second = free(df, "_first"), free(df, "_second")
    hashed = df.select(bucket, row_hash(df, columns, 1).alias(first), row_hash(df, columns, 2).alias(second))
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    return hashed.groupBy(bucket).agg(F.count(F.lit(1)).alias("rows"), wide(first).alias("one"), wide(second).alias("two"), F.bit_xor(second).alias("three"))


class DigestedSnapshots(Snapshots):
    """Snapshots of a table with these keys. The number of buckets is that of the first version, unless it is given."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int | None = None) -> None:
        super().__init__(spark, path)
        self.keys, self.buckets = list(keys), buckets

    def bucket(self, df: DataFrame) -> Column:
        return F.pmod(F.xxhash64(*(comparable(df, k) for k in self.keys)), F.lit(self.buckets)).cast("int")

    def digest_path(self, version: int) -> str:
        return f"{self.path}/digests/v={version}"

    def publish(self, df: DataFrame) -> int:
        version = -1 if (last := self.latest()) is None else last
        if self.buckets is None:
            self.buckets = min(MOST, max(1, -(-df.count() // ROWS))) if last is None else self.spark.read.parquet(self.digest_path(last)).first()["buckets"]
        at = f"{self.path}/v={version + 1}"
        placed = void_to_string(df)
        placed.withColumn(BUCKET, self.bucket(placed)).repartition(BUCKET).write.partitionBy(BUCKET).parquet(at)
        # of the rows as they were written, so that df may be one that isn't the same twice
        digests(self.spark.read.parquet(at)).withColumn("buckets", F.lit(self.buckets)).write.mode("overwrite").parquet(self.digest_path(version + 1))
        return version + 1

    def read(self, version: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        df = super().read(version)
        return (df if buckets is None else df.where(F.col(BUCKET).isin(list(buckets)))).drop(BUCKET)

    def changed_buckets(self, old: int, new: int) -> list[int] | None:
        """Buckets that differ, or None where the versions were dealt out differently."""
        a, b = (self.spark.read.parquet(self.digest_path(v)) for v in (old, new))
        if (x := a.first()) and (y := b.first()) and x["buckets"] != y["buckets"]:
            return None
        same = ["rows", "one", "two", "three"]
        both = a.select(BUCKET, F.struct(*same).alias("a")).join(b.select(BUCKET, F.struct(*same).alias("b")), BUCKET, "full")
        return sorted(r[0] for r in both.where(~F.col("a").eqNullSafe(F.col("b"))).select(BUCKET).collect())  # at most MOST

    def diff(self, old: int, new: int) -> DataFrame:
        """The change feed between two versions, of the buckets that differ."""
        some = self.changed_buckets(old, new)
        return snapshot_diff(self.read(old, some), self.read(new, some), self.keys, new)

    def changes(self, since: int, keys: Sequence[str] | None = None) -> DataFrame:
        versions = self.versions()
        feeds = [self.diff(v - 1, v) for v in versions if v > since and v]
        if feeds:
            return union_by_name(feeds)
        return self.read().limit(0).withColumns({KIND: F.lit(""), VERSION: F.lit(0)})


def bytes_of(spark: SparkSession, path: str) -> int:
    """What a folder's files have, as its file system tells."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()


#: Bits of each key on a space-filling curve, values that bounds are sampled from, and bytes of a file that clustering aims at.
CURVE_BITS, FILE_BYTES = 10, 128 << 20


def curve(df: DataFrame, keys: Sequence[str], bits: int = CURVE_BITS) -> Column:
    """A row's place on a Z-order curve over the ranks of its keys: bits of the keys in turn, the highest first, so that rows that are near in all of them are near on it.

    A rank is a key's place among 2^bits - 1 approximate quantiles, so that any spread of values fills the curve; text is ranked by its first bytes. Nulls come first."""
    edges = [F.percentile_approx(_number(df, k), [n / 2**bits for n in range(1, 2**bits)], 10_000) for k in keys]
    found = df.agg(*edges).first()
    ranks = [_rank(_number(df, k), sorted(set(some or [])), bits) for k, some in zip(keys, found, strict=True)]

    def place(r: Column) -> Column:
        out = F.lit(0).cast("bigint")
        for b in range(bits - 1, -1, -1):
            for n in range(len(keys)):
                out = F.shiftleft(out, 1).bitwiseOR(F.shiftright(r[n], b).bitwiseAND(F.lit(1).cast("bigint")))
        return out

    return F.transform(F.array(F.array(*ranks)), place)[0]  # ranks are worked out once a row, though each of their bits is used


def _number(df: DataFrame, key: str) -> Column:
    kind = dict(df.dtypes)[key]
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return F.unix_micros(col(key).cast("timestamp")).cast("double")
    if kind == "string":  # six bytes fit a double
        return F.conv(F.rpad(F.hex(F.substring(F.encode(key, "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("double")
    return col(key).cast("double")


def _rank(value: Column, bounds: Sequence[float], bits: int) -> Column:
    """The number of bounds at or under the value, found by halving; 0 of null. There are under 2^bits bounds; NaN is over all others."""
    if not bounds:
        return F.lit(0).cast("bigint")
    held, steps = F.array(*map(F.lit, bounds)), F.array(*(F.lit(1 << b) for b in range(bits - 1, -1, -1)))
    under = lambda n, x: F.coalesce(F.get(held, n - 1) <= x, F.lit(False))  # noqa: E731  past the last bound it is null
    found = F.transform(F.array(value), lambda x: F.aggregate(steps, F.lit(0), lambda n, step: F.when(under(n + step, x), n + step).otherwise(n)))
    return found[0].cast("bigint")


def cluster(df: DataFrame, keys: Sequence[str], files: int) -> DataFrame:
    """df in as many ranges of the curve over its keys; one key is ordered by itself."""
    place = free(df, "_place")
    order = df.withColumn(place, curve(df, keys) if len(keys) > 1 else col(keys[0]))
    return order.repartitionByRange(files, place).sortWithinPartitions(place).drop(place)


def compact_tables(spark: SparkSession, paths: Sequence[str], keys: Sequence[str], file_bytes: int = FILE_BYTES) -> dict[str, int | str]:
    """Each table (a folder of versions) clustered by those of the keys that it has and published as its next version: number of files, which have FILE_ROWS rows or so at most, or why not. One that can't be read or has none of the keys
    doesn't keep the others from theirs."""
    done: dict[str, int | str] = {}
    for path in paths:
        try:
            store = Snapshots(spark, path)
            if (last := store.latest()) is None:
                done[path] = "no version"
                continue
            df = store.read()
            own = [k for k in keys if k in df.columns]
            if not own:
                done[path] = "none of the keys"
                continue
            files = max(1, -(-bytes_of(spark, f"{path.rstrip('/')}/v={last}") // file_bytes), -(-df.count() // FILE_ROWS))
            store.publish(cluster(df, own, files))
            done[path] = files
        except Exception as e:  # noqa: BLE001  an unreadable table is reported, not fatal
            done[path] = f"failed: {type(e).__name__}"
    return done
