"""Queries of scalar functions as the operators use them, one a family."""

from pyspark.sql import functions as F

from ..operators import project as P
from ..registry import query


@query("fn_str", r"SELECT row_key, 'id ' || school_id_govt AS a, concat_ws('-', school_name, education_level) AS b, lower(trim('  ' || connectivity_govt || ' ')) AS c, length(school_name) AS d, substr(school_name, 3, 5) AS e, split_part(school_name, ' ', 2) AS f, starts_with(school_name, 'Escola') AS g, regexp_extract(school_name, '(\d+)$', 1) AS h, regexp_replace(download_speed_govt, '[^0-9]', '', 'g') AS i FROM fx_school WHERE school_name IS NOT NULL")
def fn_str(t):
    name = F.col("school_name")
    return t.fx_school.where(name.isNotNull()).select(
        "row_key", F.concat(F.lit("id "), "school_id_govt").alias("a"), F.concat_ws("-", name, "education_level").alias("b"), F.lower(F.trim(F.concat(F.lit("  "), "connectivity_govt", F.lit(" ")))).alias("c"), F.length(name).cast("bigint").alias("d"),
        F.substring(name, 3, 5).alias("e"), F.split(name, " ").getItem(1).alias("f"), name.startswith("Escola").alias("g"), F.regexp_extract(name, r"(\d+)$", 1).alias("h"), F.regexp_replace("download_speed_govt", "[^0-9]", "").alias("i"),
    )


@query("fn_hash", "SELECT row_key, sha256(school_id_govt) AS sha, md5(school_name) AS md5, substr(md5(coalesce(school_name, '')), 1, 8) AS short FROM fx_school")
def fn_hash(t):
    return t.fx_school.select("row_key", F.sha2("school_id_govt", 256).alias("sha"), F.md5("school_name").alias("md5"), F.substring(F.md5(F.coalesce("school_name", F.lit(""))), 1, 8).alias("short"))


@query("fn_date", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS unix, strftime(ts - INTERVAL 2 HOURS, '%Y-%m-%d %H:%M:%S') AS earlier, len(generate_series(date_trunc('hour', ts), date_trunc('hour', ts) + INTERVAL 3 HOURS, INTERVAL 1 HOUR)) AS steps FROM events")
def fn_date(t):
    ts = F.col("ts").cast("timestamp")
    hour = F.date_trunc("hour", ts)
    return t.events.select(
        "event_id", F.to_date(ts).cast("string").alias("day"), F.date_format(hour, "yyyy-MM-dd HH").alias("hour"), F.unix_timestamp(ts).alias("unix"), F.date_format(ts - F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd HH:mm:ss").alias("earlier"),
        F.size(F.sequence(hour, hour + F.expr("INTERVAL 3 HOURS"), F.expr("INTERVAL 1 HOUR"))).cast("bigint").alias("steps"),
    )


@query("fn_math", "SELECT row_key, floor(latitude) AS f, greatest(row_key, num_computers) AS g, least(row_key, num_computers) AS l, round(num_computers / 7.0, 3) AS r, round(num_computers * 100.0 / 700, 2) AS p FROM fx_school")
def fn_math(t):
    n = F.col("num_computers")
    return t.fx_school.select("row_key", F.floor("latitude").cast("double").alias("f"), F.greatest("row_key", n.cast("bigint")).alias("g"), F.least("row_key", n.cast("bigint")).alias("l"), F.round(n / 7.0, 3).alias("r"), F.round(n * 100.0 / 700, 2).alias("p"))


@query("fn_null", "SELECT row_key, coalesce(school_name, education_level, '-') AS a, latitude IS NULL AS b, school_name IS NOT DISTINCT FROM education_level AS c, CASE WHEN row_key % 2 = 0 THEN 'even' WHEN row_key % 3 = 0 THEN 'third' ELSE 'other' END AS d, nullif(connectivity_govt, 'no') AS e FROM fx_school")
def fn_null(t):
    k = F.col("row_key")
    return t.fx_school.select("row_key", F.coalesce("school_name", "education_level", F.lit("-")).alias("a"), F.isnull("latitude").alias("b"), F.col("school_name").eqNullSafe(F.col("education_level")).alias("c"), F.when(k % 2 == 0, "even").when(k % 3 == 0, "third").otherwise("other").alias("d"), F.nullif("connectivity_govt", F.lit("no")).alias("e"))


@query("fn_arr", "SELECT country_key, v, count(*) AS n FROM (SELECT country_key, unnest([school_name, education_level, connectivity_govt]) AS v FROM fx_school) WHERE v IS NOT NULL GROUP BY 1, 2")
def fn_arr(t):
    rows = t.fx_school.select("country_key", F.explode(F.array_compact(F.array("school_name", "education_level", "connectivity_govt"))).alias("v"))
    return rows.groupBy("country_key", "v").agg(F.count(F.lit(1)).alias("n"))


@query("fn_map", "SELECT row_key, k, v FROM (SELECT row_key, unnest(['qty', 'country', 'one']) AS k, unnest([num_computers, country_key, 1]) AS v FROM fx_school) WHERE k <> 'one'")
def fn_map(t):
    whole = F.map_concat(F.create_map(F.lit("qty"), "num_computers", F.lit("country"), "country_key"), F.create_map(F.lit("one"), F.lit(1)))
    return t.fx_school.select("row_key", F.explode(F.map_filter(whole, lambda k, _: k != "one")).alias("k", "v"))


@query("fn_json", "SELECT row_key, num_computers AS n, school_name AS s FROM fx_school WHERE school_name IS NOT NULL")
def fn_json(t):
    body = F.to_json(F.struct(F.col("num_computers").alias("n"), F.struct(F.col("school_name").alias("s")).alias("in")))
    rows = t.fx_school.where("school_name IS NOT NULL").select("row_key", body.alias("body"))
    return rows.select("row_key", F.from_json("body", "n INT")["n"].alias("n"), F.get_json_object("body", "$.in.s").alias("s"))


@query("srt_04_preview", "SELECT row_key, school_name, latitude FROM fx_school ORDER BY row_key LIMIT 10")
def srt_04(t):
    from ..operators.windows import preview

    return preview(t.fx_school.orderBy("row_key").select("row_key", "school_name", "latitude"), 10)  # the feature is a preview


@query("agg_06_json_field_min", "SELECT DISTINCT user_id, event_type, strftime(min(ts) OVER (PARTITION BY user_id, event_type), '%Y-%m-%d %H:%M:%S') AS first_time FROM events WHERE json_valid(props)")
def agg_06(t):
    from ..operators.report import first_times

    rows = t.events.where(F.get_json_object("props", "$").isNotNull())
    return first_times(rows, ["user_id", "event_type"], "ts").withColumn("first_time", F.date_format("first_time", "yyyy-MM-dd HH:mm:ss"))


@query("snk_09_error_rows", "SELECT pk, 'u1' AS upload_id, 'f.csv' AS file_name, 'school' AS dataset, 'BRA' AS country_code FROM fx_incoming WHERE name IS NULL")
def snk_09(t):
    from ..sources.sinks import error_rows

    rows = error_rows(t.fx_incoming.where("name IS NULL").select("pk"), "u1", "f.csv", "school", "BRA", F.lit("2024-02-01").cast("timestamp"))
    return rows.drop("created_at")


@query("stm_03_files_after", "SELECT epoch(ts)::BIGINT AS mtime, CAST(event_id AS VARCHAR) AS name FROM (SELECT date_trunc('second', ts) AS ts, event_id FROM events) WHERE epoch(ts) > 1705276800 OR (epoch(ts) = 1705276800 AND CAST(event_id AS VARCHAR) > '5')")
def stm_03(t):
    from ..streaming.ingest import files_after

    listing = t.events.select(F.unix_timestamp(F.col("ts").cast("timestamp")).alias("mtime"), F.col("event_id").cast("string").alias("name"))
    return files_after(listing, 1705276800, "5")


@query("stm_09_ping_provenance", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, 'r1' AS ingestion_run_id FROM lineitem")
def stm_09(t):
    from ..operators.schema import widen

    return widen(t.lineitem.select("l_orderkey", "l_linenumber")).withColumn("ingestion_run_id", F.lit("r1"))


@query("prj_03_mapping_strict", "SELECT row_key, CASE WHEN lower(trim(education_level)) IN ('primary', 'basic') THEN 'Primary' WHEN lower(trim(education_level)) = 'secondary' THEN 'Secondary' ELSE 'Unknown' END AS mapped FROM fx_school")
def prj_03(t):
    return P.map_values(t.fx_school, "education_level", t.fx_map.union(t.fx_map), out="mapped").select("row_key", "mapped")
