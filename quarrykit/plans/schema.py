"""Queries of schema and type operators."""

from pyspark.sql import functions as F

from ..operators import schema as S
from ..registry import query

TYPED = {"qty_text": "int", "level": "string", "day": "date", "flag": "boolean"}


@query("sch_01_registry_struct", "SELECT 'col_' || CAST(p_partkey AS VARCHAR) AS name, CASE CAST(p_size % 9 AS INT) WHEN 0 THEN 'string' WHEN 1 THEN 'int' WHEN 2 THEN 'bigint' WHEN 3 THEN 'double' WHEN 4 THEN 'boolean' WHEN 5 THEN 'timestamp' WHEN 6 THEN 'float' ELSE 'int' END AS kind FROM part WHERE p_size % 9 <> 7 UNION ALL SELECT 'extra', 'string'")
def sch_01(t):
    return S.registry_types(t.fx_registry, [("extra", "string"), ("col_1", "string")])


@query("sch_02_invalid_types", "SELECT id, name, data_type FROM fx_registry WHERE data_type NOT IN ('string','integer','long','float','double','timestamp','boolean')")
def sch_02(t):
    return S.invalid_types(t.fx_registry).select("id", "name", "data_type")


@query("sch_04_key_columns", "SELECT 'key' AS role, 0 AS position, name FROM fx_registry WHERE primary_key UNION ALL SELECT 'partition', partition_order, name FROM fx_registry WHERE partition_order IS NOT NULL")
def sch_04(t):
    return S.key_columns(t.fx_registry)


@query("sch_06_missing_columns", "SELECT pk, name, level, qty, country_key, CAST(NULL AS VARCHAR) AS note, CAST(NULL AS DOUBLE) AS speed FROM fx_master")
def sch_06(t):
    return S.add_missing_columns(t.fx_master, [("pk", "bigint"), ("note", "string"), ("speed", "double")])


@query("sch_07_conform", "SELECT level, pk, qty FROM fx_master")
def sch_07(t):
    return S.conform(t.fx_master, ["level", "pk", "qty"])


@query("sch_08_rename", "SELECT pk AS id, name AS school, level, qty, country_key FROM fx_master")
def sch_08(t):
    return S.rename_columns(t.fx_master, {" pk ": " id ", "name": "school", None: "x", "level": None, "absent": "y"})


TEXTS = "SELECT pk, CASE WHEN pk % 5 = 0 THEN 'n/a' ELSE CAST(qty AS VARCHAR) END AS qty_text, level, CASE WHEN pk % 7 = 0 THEN 'never' ELSE '2024-01-0' || CAST(1 + pk % 9 AS VARCHAR) END AS day, CASE CAST(pk % 3 AS INT) WHEN 0 THEN 'true' WHEN 1 THEN 'false' ELSE 'x' END AS flag FROM fx_master"


def texts(t):
    return t.fx_master.select("pk", F.when(F.expr("pk % 5 = 0"), "n/a").otherwise(F.col("qty").cast("string")).alias("qty_text"), "level", F.when(F.expr("pk % 7 = 0"), "never").otherwise(F.concat(F.lit("2024-01-0"), F.expr("1 + pk % 9").cast("string"))).alias("day"), F.expr("CASE CAST(pk % 3 AS INT) WHEN 0 THEN 'true' WHEN 1 THEN 'false' ELSE 'x' END").alias("flag"))


@query("sch_09_cast_to_schema", f"WITH x AS ({TEXTS}) SELECT pk, TRY_CAST(qty_text AS INT) AS qty_text, level, CAST(TRY_CAST(day AS DATE) AS VARCHAR) AS day, flag FROM x")
def sch_09(t):
    return S.cast_to_schema(texts(t), TYPED, skip=["flag"]).withColumn("day", F.col("day").cast("string"))


@query("sch_10_guarded_cast", "SELECT pk, CAST(qty AS DOUBLE) AS qty FROM fx_master")
def sch_10(t):
    return S.guarded_cast(t.fx_master.select("pk", F.col("qty").cast("string").alias("qty")), {"qty": "double"})


@query("sch_11_type_profile", "SELECT school_id_govt, school_name, TRY_CAST(latitude AS DOUBLE) AS latitude, CAST(num_computers AS INT) AS num_computers FROM fx_school")
def sch_11(t):
    from ..functions.profiles import EXPECTED_TYPES

    some = t.fx_school.select("school_id_govt", "school_name", F.col("latitude").cast("string"), F.col("num_computers").cast("string"))
    return S.cast_to_schema(some, {k: v for k, v in EXPECTED_TYPES.items() if k in some.columns})


@query("sch_12_widen", "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, 'lineitem' AS source_file, 'run1' AS ingestion_run_id, CAST(EXTRACT(YEAR FROM l_shipdate) AS BIGINT) AS at FROM lineitem")
def sch_12(t):
    rows = S.widen(S.with_provenance(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"), "lineitem", F.col("l_shipdate"), "run1"))
    return rows.select("l_orderkey", "l_linenumber", "l_quantity", "source_file", "ingestion_run_id", F.year("ingested_at").cast("bigint").alias("at"))


@query("sch_13_sync_schema", "SELECT pk, name, level, CAST(qty AS DOUBLE) AS qty, country_key, CAST(NULL AS VARCHAR) AS note FROM fx_master")
def sch_13(t):
    from pyspark.sql import types as T

    new = T.StructType([*(f if f.name != "qty" else T.StructField("qty", T.DoubleType()) for f in t.fx_master.schema), T.StructField("note", T.StringType())])
    return S.sync_schema(t.fx_master, new)[0]


@query("sch_14_reconcile", "SELECT pk, name, level, qty, CAST(NULL AS INT) AS country_key FROM (SELECT pk, name, level, qty FROM fx_master) UNION ALL SELECT pk, name, NULL, NULL, country_key FROM fx_incoming")
def sch_14(t):
    return S.reconcile(t.fx_master.drop("country_key"), t.fx_incoming.select("pk", "name", "country_key"))


@query("sch_15_enforce_schema", f"WITH x AS ({TEXTS}) SELECT TRY_CAST(qty_text AS INT) AS qty_text, CAST(TRY_CAST(day AS DATE) AS VARCHAR) AS day, CAST(NULL AS VARCHAR) AS absent FROM x")
def sch_15(t):
    return S.enforce_schema(texts(t), {"qty_text": "int", "day": "date", "absent": "string"}).withColumn("day", F.col("day").cast("string"))


@query("sch_16_struct_to_map", "SELECT pk, 'qty' AS k, qty AS v FROM fx_master WHERE qty IS NOT NULL UNION ALL SELECT pk, 'country_key', country_key FROM fx_master")
def sch_16(t):
    rows = t.fx_master.select("pk", F.struct("qty", "country_key").alias("dq"))
    return S.struct_to_map(rows, "dq").select("pk", F.explode("dq").alias("k", "v"))


@query("sch_17_void_to_string", "SELECT pk, CAST(NULL AS VARCHAR) AS nothing FROM fx_master")
def sch_17(t):
    return S.void_to_string(t.fx_master.select("pk", F.lit(None).alias("nothing")))


@query("sch_18_fill_required", "SELECT row_key, school_id_giga, coalesce(school_name, 'Unknown') AS school_name, coalesce(latitude, 0) AS latitude, num_computers FROM fx_school")
def sch_18(t):
    return S.fill_required(t.fx_school.select("row_key", "school_id_giga", "school_name", "latitude", "num_computers"), ["school_id_giga", "school_name", "latitude", "num_computers"], key="school_id_giga")


@query("sch_19_snake_case", "SELECT pk AS school_id, name AS school_name_en, qty AS qty_2 FROM fx_master")
def sch_19(t):
    return S.snake_case(t.fx_master.select(F.col("pk").alias("SchoolID"), F.col("name").alias("School Name (EN)"), F.col("qty").alias("qty-2")))


@query("sch_20_suffixed_duplicates", "SELECT pk, name FROM fx_master")
def sch_20(t):
    return S.drop_suffixed_duplicates(t.fx_master.select("pk", "name", F.col("name").alias("name.1")))
