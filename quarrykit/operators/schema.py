"""Schema and type operators: registries, casts that never raise, evolution."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Names of data types that a registry may use, and Spark's types. Fixed values.
PRIMITIVES = {"string": "string", "integer": "int", "int": "int", "long": "bigint", "float": "float", "double": "double", "timestamp": "timestamp", "boolean": "boolean"}
VALID_PRIMITIVES = ("string", "integer", "long", "float", "double", "timestamp", "boolean")
TIERS = ("raw", "bronze", "transforms", "data_quality_checks", "error", "staging", "rejected", "silver", "gold")


def registry_schema(registry: DataFrame, core: Iterable[tuple[str, str]] = ()) -> T.StructType:
    """The StructType that a registry of columns describes; core columns (name, type) are appended where missing.

    A registry is one table's columns, so its rows are few and come to the driver."""
    rows = registry.select("name", "data_type", *(c for c in ("is_nullable",) if c in registry.columns)).collect()
    nullable = lambda r: bool(r["is_nullable"]) if "is_nullable" in registry.columns else True
    fields = [(r["name"], r["data_type"], nullable(r)) for r in rows]
    fields += [(n, t, True) for n, t in core if n not in {f[0] for f in fields}]
    return T.StructType([T.StructField(n, T._parse_datatype_string(PRIMITIVES[t.lower()]), ok) for n, t, ok in fields])


def invalid_types(registry: DataFrame, valid: Iterable[str] = VALID_PRIMITIVES) -> DataFrame:
    return registry.where(~F.lower("data_type").isin(*valid) | F.col("data_type").isNull())


def require_valid_types(registry: DataFrame) -> DataFrame:
    bad = sorted({str(r["data_type"]) for r in invalid_types(registry).select("data_type").distinct().limit(20).collect()})
    if bad:
        raise ValueError(f"data types that aren't known: {', '.join(bad)}")
    return registry


def key_columns(registry: DataFrame) -> DataFrame:
    """Primary key and partition columns: role, position, name."""
    keys = registry.where("primary_key").select(F.lit("key").alias("role"), F.lit(0).alias("position"), "name")
    return keys.unionByName(registry.where(F.col("partition_order").isNotNull()).select(F.lit("partition").alias("role"), F.col("partition_order").alias("position"), "name"))


def table_name(dataset: str, country: str, tier: str | None = None) -> str:
    if tier is not None and tier not in TIERS:
        raise ValueError(f"no such tier: {tier}")
    return f"{dataset}{'' if tier in (None, 'gold') else '_' + tier}.{country.lower()}"


def table_name_of(dataset: str, country: Column, tier: str | None = None) -> Column:
    """As table_name, for a column of countries."""
    return F.concat(F.lit(table_name(dataset, "", tier)), F.lower(country))


def registry_types(registry: DataFrame, core: Iterable[tuple[str, str]] = ()) -> DataFrame:
    """name and kind (Spark's type) of a registry's columns of known types, and of core columns that it lacks; for registries of any size."""
    kinds = F.create_map(*(F.lit(x) for pair in PRIMITIVES.items() for x in pair))
    own = registry.select("name", F.try_element_at(kinds, F.lower("data_type")).alias("kind")).where("kind IS NOT NULL")
    added = registry.sparkSession.createDataFrame([(n, PRIMITIVES[t]) for n, t in core], "name string, kind string")
    return own.unionByName(added.join(registry.select("name"), "name", "left_anti"))


def add_missing_columns(df: DataFrame, fields: Iterable[tuple[str, str]]) -> DataFrame:
    """Typed nulls for the (name, type) that df lacks."""
    return df.withColumns({n: F.lit(None).cast(t) for n, t in fields if n not in df.columns})


def conform(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Only these columns, in this order."""
    return df.select(*(F.col(f"`{c}`") for c in columns))


def rename_columns(df: DataFrame, mapping: Mapping[str | None, str | None]) -> DataFrame:
    """Source to new name; names are trimmed, pairs with a None or an absent source are left out."""
    pairs = {k.strip(): v.strip() for k, v in mapping.items() if k and v}
    return df.withColumnsRenamed({k: v for k, v in pairs.items() if k in df.columns})


def try_cast(c: Column | str, kind: str) -> Column:
    """Null instead of an error for what can't be cast."""
    return (F.col(f"`{c}`") if isinstance(c, str) else c).try_cast(kind)


def cast_to_schema(df: DataFrame, schema: Mapping[str, str], skip: Iterable[str] = ()) -> DataFrame:
    """Columns of the schema cast to its types; others and those to skip stay."""
    kinds, left = dict(df.dtypes), set(skip)
    return df.withColumns({c: try_cast(c, t) for c, t in schema.items() if c in kinds and c not in left and kinds[c] != t})


def guarded_cast(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """As cast_to_schema, but raises if a cast makes nulls. One pass over the rows."""
    todo = {c: t for c, t in schema.items() if c in df.columns}
    if not todo:
        return df
    lost = df.agg(*(F.count_if(F.col(f"`{c}`").isNotNull() & try_cast(c, t).isNull()).alias(c) for c, t in todo.items())).first()
    bad = {c: n for c, n in lost.asDict().items() if n}
    if bad:
        raise ValueError(f"values that can't be cast: {bad}")
    return cast_to_schema(df, schema)


def widen(df: DataFrame) -> DataFrame:
    """Integers to bigint, decimals to double, by type."""
    return df.withColumns({f.name: F.col(f"`{f.name}`").cast("bigint" if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)) else "double") for f in df.schema if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.DecimalType))})


def with_provenance(df: DataFrame, source: str | Column, at: str | Column, run: str) -> DataFrame:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return df.withColumns({"source_file": lit(source), "ingested_at": lit(at).cast("timestamp"), "ingestion_run_id": F.lit(run)})


def schema_changes(old: T.StructType, new: T.StructType) -> dict[str, list]:
    """added, removed, changed (name, from, to), required (nullable before, not now)."""
    a, b = {f.name: f for f in old}, {f.name: f for f in new}
    both = [n for n in b if n in a]
    return {
        "added": [n for n in b if n not in a],
        "removed": [n for n in a if n not in b],
        "changed": [(n, a[n].dataType.simpleString(), b[n].dataType.simpleString()) for n in both if a[n].dataType != b[n].dataType],
        "required": [n for n in both if a[n].nullable and not b[n].nullable],
    }


def sync_schema(df: DataFrame, new: T.StructType) -> tuple[DataFrame, list[str]]:
    """df with changed types cast and new columns added, and the predicates that required columns must hold."""
    found = schema_changes(df.schema, new)
    out = cast_to_schema(df, {n: to for n, _, to in found["changed"]})
    out = add_missing_columns(out, [(n, new[n].dataType.simpleString()) for n in found["added"]])
    return out, [f"`{n}` IS NOT NULL" for n in found["required"]]


def reconcile(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Rows of both; columns that one side lacks are null there."""
    return stored.unionByName(incoming, allowMissingColumns=True)


def enforce_schema(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Exactly these columns, coerced; what can't be coerced and what is absent is null."""
    return df.select(*((try_cast(c, t) if c in df.columns else F.lit(None).cast(t)).alias(c) for c, t in kinds.items()))


def struct_to_map(df: DataFrame, column: str, value: str = "int") -> DataFrame:
    return df.withColumn(column, F.from_json(F.to_json(column), f"map<string,{value}>"))


def void_to_string(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(f"`{c}`").cast("string") for c, t in df.dtypes if t == "void"})


def fill_required(df: DataFrame, columns: Iterable[str], key: str, now: Column | None = None) -> DataFrame:
    """Nulls of required columns by type: 'Unknown', 0, false, the time given; never the key."""
    kinds = dict(df.dtypes)
    blank = {"string": F.lit("Unknown"), "boolean": F.lit(False), "timestamp": now if now is not None else F.current_timestamp()}
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), blank.get(kinds[c], F.lit(0).cast(kinds[c]))) for c in columns if c in kinds and c != key})


def snake(name: str) -> str:
    name = re.sub(r"[^0-9A-Za-z]+", "_", name.strip())
    name = re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name)
    return re.sub("_+", "_", name).strip("_").lower()


def snake_case(df: DataFrame) -> DataFrame:
    """Column names, those in structs too."""

    def kind(t: T.DataType) -> T.DataType:
        if isinstance(t, T.StructType):
            return T.StructType([T.StructField(snake(f.name), kind(f.dataType), f.nullable) for f in t])
        return T.ArrayType(kind(t.elementType), t.containsNull) if isinstance(t, T.ArrayType) else t

    return df.select(*(F.col(f"`{f.name}`").cast(kind(f.dataType)).alias(snake(f.name)) for f in df.schema))


def drop_suffixed_duplicates(df: DataFrame) -> DataFrame:
    """Leaves out columns such as `name.1` that a reader made of a repeated header."""
    return df.select(*(F.col(f"`{c}`") for c in df.columns if not (m := re.fullmatch(r"(.+)\.\d+", c)) or m[1] not in df.columns))
