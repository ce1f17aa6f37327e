"""Queries of projections and standardisation."""

from pyspark.sql import functions as F

from ..operators import project as P
from ..registry import query



def now():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def uuid_sql(text):
    h = f"md5(unhex('{P.DNS}') || encode({text}))"
    return f"substr({h},1,8) || '-' || substr({h},9,4) || '-3' || substr({h},14,3) || '-' || printf('%02x', (CAST('0x' || substr({h},17,2) AS INT) & 63) | 128) || substr({h},19,2) || '-' || substr({h},21,12)"


@query("prj_01_stable_id", f"SELECT row_key, coalesce(school_id_giga, {uuid_sql('(school_id_govt || school_name || education_level || CAST(num_computers AS VARCHAR))')}) AS school_id_giga FROM fx_school")
def prj_01(t):
    return P.stable_id(t.fx_school, "school_id_giga", ["school_id_govt", "school_name", "education_level", "num_computers"]).select("row_key", "school_id_giga")


@query("prj_02_facility_id", f"SELECT row_key, {uuid_sql('(school_id_govt || school_name || CAST(country_key AS VARCHAR))')} AS facility_id FROM fx_school")
def prj_02(t):
    return P.stable_id(t.fx_school, "facility_id", ["school_id_govt", "school_name", "country_key"]).select("row_key", "facility_id")


@query("prj_03_value_mapping", "SELECT row_key, coalesce(m.dst, 'Unknown') AS education_level FROM fx_school s LEFT JOIN fx_map m ON lower(trim(s.education_level)) = lower(trim(m.src))")
def prj_03(t):
    return P.map_values(t.fx_school, "education_level", t.fx_map).select("row_key", "education_level")


@query("prj_04_joined_name", "SELECT row_key, CASE WHEN country_key % 5 = 0 THEN concat_ws(' ', school_name, education_level) ELSE school_name END AS school_name FROM fx_school")
def prj_04(t):
    return P.joined_name(t.fx_school, "school_name", F.expr("country_key % 5 = 0"), ["school_name", "education_level"]).select("row_key", "school_name")


@query("prj_05_number_in_text", "SELECT row_key, TRY_CAST(regexp_replace(download_speed_govt, '[^0-9.]', '', 'g') AS DOUBLE) AS speed FROM fx_school")
def prj_05(t):
    return t.fx_school.select("row_key", P.number_in("download_speed_govt").alias("speed"))


@query("prj_06_root_category", "SELECT row_key, CASE WHEN lower(education_level) IN ('primary','basic') THEN 'Primary' WHEN lower(education_level) IN ('secondary') THEN 'Secondary' ELSE 'Other' END AS root FROM fx_school")
def prj_06(t):
    return t.fx_school.select("row_key", P.root_category("education_level", {"Primary": ["Primary", "Basic"], "Secondary": ["Secondary"]}, "Other").alias("root"))


@query("prj_07_title_case", "SELECT row_key, upper(substr(connectivity_govt,1,1)) || lower(substr(connectivity_govt,2)) AS connectivity_govt, upper(substr(electricity_availability,1,1)) || lower(substr(electricity_availability,2)) AS electricity_availability FROM fx_school")
def prj_07(t):
    return P.title_case(t.fx_school, ["connectivity_govt", "electricity_availability", "absent"]).select("row_key", "connectivity_govt", "electricity_availability")


@query("prj_08_ingestion_stamp", "SELECT row_key, CASE WHEN connectivity_govt IS NOT NULL THEN '2024-02-01 00:00:00' END AS stamp FROM fx_school")
def prj_08(t):
    return P.stamped(t.fx_school, "connectivity_govt", "stamp", now()).select("row_key", F.date_format("stamp", "yyyy-MM-dd HH:mm:ss").alias("stamp"))


@query("prj_09_default_status", "SELECT row_key, coalesce(connectivity_govt, 'unknown') AS connectivity_govt, 'PENDING' AS status FROM fx_school")
def prj_09(t):
    return P.default_value(P.default_value(t.fx_school, "connectivity_govt", "unknown"), "status", "PENDING").select("row_key", "connectivity_govt", "status")


@query("prj_10_default_for_new", "SELECT row_key, CASE WHEN school_id_giga IS NULL THEN coalesce(electricity_type, 'Unknown') ELSE electricity_type END AS electricity_type FROM fx_school")
def prj_10(t):
    rows = t.fx_school.withColumn("is_new", F.col("school_id_giga").isNull())
    return P.default_value(rows, "electricity_type", "Unknown", new_only="is_new").select("row_key", "electricity_type")


@query("prj_11_blank_without_location", "SELECT row_key, CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN country_key END AS country_key FROM fx_school")
def prj_11(t):
    return P.blank_without(t.fx_school, ["country_key", "absent"], ["latitude", "longitude"]).select("row_key", "country_key")


@query("prj_12_signature", "SELECT pk, sha256(concat_ws('|', CAST(country_key AS VARCHAR), level, name, CAST(pk AS VARCHAR), CAST(qty AS VARCHAR))) AS signature, sha256(concat_ws('|', CAST(country_key AS VARCHAR), coalesce(level, '~'), coalesce(name, '~'), CAST(pk AS VARCHAR), CAST(qty AS VARCHAR))) AS strict FROM fx_incoming")
def prj_12(t):
    return P.with_signature(t.fx_incoming).select("pk", "signature", P.signature(t.fx_incoming.columns, "~").alias("strict"))


@query("prj_13_event_key", "SELECT sha256(CAST(user_id AS VARCHAR) || '_' || event_type) AS event_key, count(*) AS n, CAST(CAST(min(ts) AS DATE) AS VARCHAR) AS date FROM events GROUP BY 1")
def prj_13(t):
    some = t.events.select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    kept = P.event_key(some, ["user_id", "event_type"], "ts").select("event_key", F.col("date").cast("string"))
    sizes = some.groupBy(F.sha2(F.concat_ws("_", F.col("user_id").cast("string"), "event_type"), 256).alias("event_key")).agg(F.count(F.lit(1)).alias("n"))
    return kept.join(sizes, "event_key").select("event_key", "n", "date")


@query("prj_14_time_by_format", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS iso, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS epoch, strftime(ts, '%Y-%m-%d') AS pattern FROM events")
def prj_14(t):
    ts = F.col("ts").cast("timestamp")
    rows = t.events.select("event_id", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss").alias("a"), F.unix_timestamp(ts).cast("string").alias("b"), F.date_format(ts, "dd/MM/yyyy").alias("c"))
    out = lambda c, form, to: F.date_format(P.time_from(c, form), to)
    return rows.select("event_id", out("a", "iso", "yyyy-MM-dd HH:mm:ss").alias("iso"), out("b", "epoch", "yyyy-MM-dd HH:mm:ss").alias("epoch"), out("c", "dd/MM/yyyy", "yyyy-MM-dd").alias("pattern"))


@query("prj_15_binary_flags", "SELECT school_key, mobile_2g = 1 AS g2, mobile_3g = 1 AS g3, dist_4g AS dist_4g FROM fx_cov_itu WHERE school_key IS NOT NULL")
def prj_15_binary(t):
    return P.coverage_flags(t.fx_cov_itu, "school_key", {"mobile_2g": "G2", "mobile_3g": "G3"}, binary=True, keep=["dist_4g"])


@query("prj_15_coverage_flags", "SELECT school_key, percent_2g > 0 AS g2, percent_3g > 0 AS g3, percent_4g > 0 AS g4 FROM fx_cov_a WHERE school_key IS NOT NULL")
def prj_15(t):
    return P.coverage_flags(t.fx_cov_a, "school_key", {"percent_2g": "G2", "percent_3g": "G3", "percent_4g": "G4"})


@query("prj_16_best_technology", "WITH x AS (SELECT school_key, CASE WHEN percent_4g > 0 THEN '4G' WHEN percent_3g > 0 THEN '3G' WHEN percent_2g > 0 THEN '2G' ELSE 'no coverage' END AS technology FROM fx_cov_a WHERE school_key IS NOT NULL) SELECT school_key, technology, CASE WHEN technology = 'no coverage' THEN 'no' ELSE 'yes' END AS available FROM x")
def prj_16(t):
    flags = P.coverage_flags(t.fx_cov_a, "school_key", {"percent_2g": "g2", "percent_3g": "g3", "percent_4g": "g4"})
    rows = flags.withColumn("technology", P.best_technology({"2G": "g2", "3G": "g3", "4G": "g4"}))
    return rows.select("school_key", "technology", P.availability("technology").alias("available"))


@query("prj_17_bucket_label", "SELECT event_id, strftime(time_bucket(INTERVAL 5 MINUTES, ts), '%H.%M') || ' - ' || strftime(time_bucket(INTERVAL 5 MINUTES, ts) + INTERVAL 5 MINUTES, '%H.%M') AS label FROM events")
def prj_17(t):
    return t.events.select("event_id", P.bucket_label(F.col("ts")).alias("label"))


@query("prj_18_label_parts", "SELECT row_key, country_key || ' - ' || school_name AS label, CAST(country_key AS VARCHAR) AS site, school_name AS room, num_computers / 1000.0 AS mbps FROM fx_school WHERE school_name IS NOT NULL")
def prj_18(t):
    rows = t.fx_school.where("school_name IS NOT NULL").select("row_key", F.concat_ws(" - ", F.col("country_key").cast("string"), "school_name").alias("label"), "num_computers")
    site, room = P.label_parts("label")
    return rows.select("row_key", "label", site.alias("site"), room.alias("room"), (F.col("num_computers") / F.lit(1000.0)).alias("mbps"))


@query("prj_19_ingestion_id", "SELECT event_id, CAST(user_id AS VARCHAR) || strftime(ts, '%Y%m%d%H%M%S') AS ingestion_id, CASE WHEN event_type = 'error' THEN 'Delete' ELSE 'Upsert' END AS operation FROM events")
def prj_19(t):
    return t.events.select("event_id", P.ingestion_id("user_id", "ts").alias("ingestion_id"), F.when(F.col("event_type") == "error", "Delete").otherwise("Upsert").alias("operation"))


@query("prj_20_truncated", "SELECT row_key, CAST(trunc(latitude * 1000) AS BIGINT) / 1000.0 AS lat, CAST(NULL AS DOUBLE) AS bad FROM fx_school")
def prj_20(t):
    return t.fx_school.select("row_key", P.truncated("latitude").alias("lat"), P.truncated("school_name").alias("bad"))


@query("prj_21_readable_flags", """SELECT row_key, CASE WHEN school_name IS NULL THEN 'No' ELSE 'Yes' END AS "Has a name" FROM fx_school""")
def prj_21(t):
    rows = t.fx_school.select("row_key", F.when(F.col("school_name").isNull(), 1).otherwise(0).alias("dq_is_null_mandatory-school_name"))
    return P.readable_flags(rows, {"dq_is_null_mandatory-school_name": "Has a name"})


@query("prj_22_checks_to_map", "SELECT row_key, 'a' AS k, CASE WHEN school_name IS NULL THEN 1 ELSE 0 END AS v FROM fx_school UNION ALL SELECT row_key, 'b', CASE WHEN latitude IS NULL THEN 1 ELSE 0 END FROM fx_school")
def prj_22(t):
    rows = t.fx_school.select("row_key", F.when(F.col("school_name").isNull(), 1).otherwise(0).alias("dq_a"), F.when(F.col("latitude").isNull(), 1).otherwise(0).alias("dq_b"))
    return P.checks_to_map(rows).select("row_key", F.explode("dq_results").alias("k", "v"))


@query("prj_23_value_predicates", "SELECT row_key, coalesce(lower(connectivity_govt) = 'yes', false) AS yes, coalesce(trim(electricity_type) <> '', false) AS valued, coalesce(lower(electricity_availability) = 'yes', false) = (electricity_type IS NOT NULL) AS same, length(split_part(CAST(num_computers AS VARCHAR) || '.5', '.', 2)) AS decimals, coalesce(num_computers BETWEEN 0 AND 500, false) AS inside FROM fx_school")
def prj_23(t):
    return t.fx_school.select("row_key", P.is_yes("connectivity_govt").alias("yes"), P.has_value("electricity_type").alias("valued"), P.same_availability("electricity_availability", "electricity_type").alias("same"), P.decimals(F.concat(F.col("num_computers").cast("string"), F.lit(".5"))).cast("bigint").alias("decimals"), P.in_range(F.col("num_computers"), 0, 500).alias("inside"))


@query("prj_24_verdict", "SELECT row_key, CASE WHEN lower(electricity_availability) = 'yes' OR lower(connectivity_govt) = 'yes' THEN 'Yes' WHEN lower(connectivity_govt) = 'no' THEN 'No' WHEN num_computers > 0 THEN 'Yes' WHEN num_computers = 0 THEN 'No' END AS all_inputs, CASE WHEN lower(connectivity_govt) = 'yes' THEN 'Yes' WHEN lower(connectivity_govt) = 'no' THEN 'No' WHEN school_id_giga IS NULL THEN 'Unknown' END AS declared_only, CASE WHEN lower(electricity_availability) = 'yes' THEN 'Yes' END AS measured_only FROM fx_school")
def prj_24(t):
    rt, govt, speed = F.col("electricity_availability"), F.col("connectivity_govt"), F.col("num_computers")
    return t.fx_school.select("row_key", P.verdict(rt, govt, speed).alias("all_inputs"), P.verdict(None, govt, None, F.col("school_id_giga").isNull()).alias("declared_only"), P.verdict(rt, None, None).alias("measured_only"))


@query("prj_25_source_list", "SELECT row_key, concat_ws(', ', CASE WHEN row_key % 2 = 0 THEN 'a' END, CASE WHEN row_key % 3 = 0 THEN 'b' END) AS sources FROM fx_school")
def prj_25(t):
    return t.fx_school.select("row_key", P.source_list(F.expr("CASE WHEN row_key % 2 = 0 THEN 'a' ELSE '' END"), F.expr("CASE WHEN row_key % 3 = 0 THEN 'b' ELSE '' END")).alias("sources"))
