"""Readers: files, managed tables, names of files, nested payloads."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.project import col
from ..operators.schema import cast_to_schema


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None, id_columns: Iterable[str] = (), encoding: str | None = None, multi_line: bool = False) -> DataFrame:
    """CSV with header, quotes escaped by quotes. Without schema all columns are text, so that ids keep their zeros. Line ends in quotes need multi_line, which
    makes a file one task."""
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    if encoding:
        reader = reader.option("encoding", encoding)
    df = (reader.schema(schema) if schema else reader).csv(path)
    return df.withColumns({c: col(c).cast("string") for c in id_columns if c in df.columns})


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def load_upload(spark: SparkSession, path: str, types: Mapping[str, str] | None = None, encoding: str | None = None, multi_line: bool = True) -> DataFrame:
    """CSV, JSON or Parquet by extension; types override those of columns. Uploads are files of people: CSV may have line ends in quotes and JSON is a record or
    an array a file. Large files with a record a line are read by many tasks without multi_line."""
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind == "csv":
        df = read_csv(spark, path, encoding=encoding, multi_line=multi_line)
    elif kind == "json":
        df = spark.read.option("multiLine", multi_line).option("encoding", encoding or "UTF-8").json(path)
    elif kind == "parquet":
        df = spark.read.parquet(path)
    else:
        raise ValueError(f"no reader for .{kind}")
    return cast_to_schema(df, types or {})


MISSING = ("", "nan", "NaN", "null", "None", "N/A")


def null_normalised(df: DataFrame, missing: Iterable[str] = MISSING) -> DataFrame:
    """Blank texts and words for missing become null, NaN too."""
    words = [m.lower() for m in missing]
    clean = {"string": lambda c: F.when(~F.lower(F.trim(c)).isin(words), c), "double": lambda c: F.nanvl(c, F.lit(None).cast("double")), "float": lambda c: F.nanvl(c, F.lit(None).cast("float"))}
    return df.withColumns({c: clean[t](col(c)) for c, t in df.dtypes if t in clean})


def best_effort(spark: SparkSession, path: str, kind: str, schema: str) -> DataFrame:
    """What can be read: corrupt files are skipped, a path that isn't there gives no rows."""
    try:
        return spark.read.format(kind).schema(schema).option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).load(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    spark.catalog.refreshTable(name)
    return spark.table(name)


def parts_of_name(name: Column | str, pattern: str, names: Iterable[str]) -> dict[str, Column]:
    """Columns of the groups of a pattern in file names; null where it doesn't match."""
    c = col(name)
    return {n: F.when(c.rlike(pattern), F.regexp_extract(c, pattern, k)) for k, n in enumerate(names, 1)}


UPLOAD_NAME = r"([^/]+)_([A-Za-z]{3})_([A-Za-z-]+)_(?:([A-Za-z0-9]+)_)?(\d{8}-\d{6})\.\w+$"


def upload_parts(name: Column | str) -> dict[str, Column]:
    """id, country, dataset, source and time of <id>_<country>_<dataset>[_<source>]_<yyyyMMdd-HHmmss>.<ext>."""
    made = parts_of_name(name, UPLOAD_NAME, ["upload_id", "country_code", "dataset", "source", "time"])
    return made | {"source": F.when(made["source"] != "", made["source"]), "time": F.try_to_timestamp(made["time"], F.lit("yyyyMMdd-HHmmss"))}


def flatten_payload(df: DataFrame, column: str, schema: str, data_key: str | None = None) -> DataFrame:
    """Rows of a JSON text: under data_key if given, an array exploded; nested structs of one level become columns parent_child."""
    parsed = df.withColumn("_p", F.from_json(col(column), schema))
    item = F.col(f"_p.{data_key}") if data_key else F.col("_p")
    rows = parsed.withColumn("_p", item).drop(column)
    if isinstance(rows.schema["_p"].dataType, T.ArrayType):
        rows = rows.withColumn("_p", F.explode("_p"))
    fields = []
    for f in rows.schema["_p"].dataType:
        fields += [F.col(f"_p.{f.name}.{g.name}").alias(f"{f.name}_{g.name}") for g in f.dataType] if isinstance(f.dataType, T.StructType) else [F.col(f"_p.{f.name}")]
    return rows.select(*(col(c) for c in df.columns if c != column), *fields)


EVENT = (
    "device STRUCT<id: STRING, name: STRING, model: STRING, productType: STRING>, network STRUCT<id: STRING, name: STRING>, ts STRING, time STRING, occurredAt STRING,"
    " details STRUCT<old: ARRAY<STRUCT<name: STRING, value: STRING>>, new: ARRAY<STRUCT<name: STRING, value: STRING>>>"
)


def device_events(df: DataFrame, column: str) -> DataFrame:
    """Status events of nested device payloads: the time is the first that is there of ts, time, occurredAt."""
    p = F.from_json(col(column), EVENT)
    status = lambda side: F.try_element_at(F.filter(F.col(f"_p.details.{side}"), lambda x: x["name"] == "status"), F.lit(1))["value"]
    return df.withColumn("_p", p).select(
        F.col("_p.device.id").alias("device_id"), F.col("_p.device.name").alias("deviceName"), F.col("_p.device.model").alias("model"), F.col("_p.device.productType").alias("productType"), F.col("_p.network.id").alias("networkId"),
        F.col("_p.network.name").alias("networkName"), F.coalesce("_p.ts", "_p.time", "_p.occurredAt").try_cast("timestamp").alias("timestamp"), status("old").alias("previousStatus"), status("new").alias("newStatus"),
    )
