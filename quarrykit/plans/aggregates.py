"""Queries of reports and aggregates."""

from pyspark.sql import functions as F

from ..operators import checks as C
from ..operators import project as P
from ..operators import report as R
from ..operators import summaries as D
from ..operators import windows as W
from ..registry import query


def flagged(t):
    made = C.duplicate_checks(t.fx_school, ["school_id_govt"])
    made = C.completeness_checks(made.select("row_key", "school_id_govt", "school_name", "num_computers", "connectivity_govt", "latitude", "longitude", "school_id_giga", "dq_duplicate-school_id_govt"), ["school_id_govt", "school_name"])
    made = C.domain_checks(C.range_checks(made, {"num_computers": (0, 500)}), {"connectivity_govt": ["yes", "no"]})
    keep = ["dq_duplicate-school_id_govt", "dq_is_null_mandatory-school_id_govt", "dq_is_null_mandatory-school_name", "dq_is_invalid_range-num_computers", "dq_is_invalid_domain-connectivity_govt"]
    made = made.withColumn("is_new", F.col("school_id_giga").isNull())
    made = C.critical_checks(made, keep[:2], keep[2:3])
    return made.select("row_key", "school_name", "num_computers", "connectivity_govt", "is_new", *(F.col(f"`{c}`") for c in keep), "dq_has_critical_error")


FLAGS = """f AS (SELECT row_key, school_id_giga IS NULL AS is_new, CASE WHEN count(*) OVER (PARTITION BY school_id_govt) > 1 THEN 1 ELSE 0 END AS a, CASE WHEN school_id_govt IS NULL THEN 1 ELSE 0 END AS b, CASE WHEN school_name IS NULL THEN 1 ELSE 0 END AS c,
CASE WHEN num_computers BETWEEN 0 AND 500 THEN 0 ELSE 1 END AS d, CASE WHEN lower(connectivity_govt) IN ('yes', 'no') THEN 0 ELSE 1 END AS e FROM fx_school),
g AS (SELECT *, CASE WHEN a = 1 OR b = 1 OR (is_new AND c = 1) THEN 1 ELSE 0 END AS h FROM f),
u AS (SELECT unnest(['duplicate-school_id_govt', 'is_null_mandatory-school_id_govt', 'is_null_mandatory-school_name', 'is_invalid_range-num_computers', 'is_invalid_domain-connectivity_govt', 'has_critical_error']) AS check_key, unnest([a, b, c, d, e, h]) AS v FROM g),
n AS (SELECT check_key, CAST(sum(v) AS BIGINT) AS count_failed, count_if(v = 0) AS count_passed, count(*) AS count_overall FROM u GROUP BY 1)"""


@query("agg_01_check_report", f"WITH {FLAGS} SELECT n.check_key, split_part(n.check_key, '-', 1) AS assertion, split_part(n.check_key, '-', 2) AS column, count_failed, count_passed, count_overall, round(count_failed * 100.0 / count_overall, 2) AS percent_failed, round(count_passed * 100.0 / count_overall, 2) AS percent_passed, CASE WHEN count_failed = 0 THEN 'pass' ELSE 'fail' END AS dq_remarks, m.type FROM n LEFT JOIN fx_check_meta m ON n.check_key = m.check_key")
def agg_01(t):
    return R.check_report(flagged(t), meta=t.fx_check_meta)


@query("agg_01_report_of_map", f"WITH {FLAGS} SELECT check_key, count_failed, count_passed, count_overall FROM n")
def agg_01_map(t):
    return R.check_counts(P.checks_to_map(flagged(t)), "dq_results")


@query("agg_02_dataset_summary", f"WITH {FLAGS} SELECT count(*) AS rows, count_if(h = 0) AS rows_passed, count_if(h = 1) AS rows_failed, count_if(h = 0 AND (d = 1 OR e = 1)) AS rows_passed_with_warnings, count_if(c = 1) AS rows_low_precision, count_if(h = 0 AND is_new) AS rows_created, count_if(h = 0 AND NOT is_new) AS rows_updated, CAST(5 AS BIGINT) AS columns FROM g")
def agg_02(t):
    return R.dataset_summary(flagged(t), warnings=["dq_is_invalid_range-num_computers", "dq_is_invalid_domain-connectivity_govt"], imprecise=["dq_is_null_mandatory-school_name"])


@query("agg_02_sections", f"WITH {FLAGS} SELECT coalesce(m.type, 'other') AS type, string_agg(n.check_key || ':' || n.count_failed, ',' ORDER BY n.check_key) AS checks FROM n LEFT JOIN fx_check_meta m ON n.check_key = m.check_key GROUP BY 1")
def agg_02_sections(t):
    report = R.check_report(flagged(t), meta=t.fx_check_meta).withColumn("type", F.coalesce("type", F.lit("other")))
    return R.sections(report).select("type", F.array_join(F.transform("checks", lambda c: F.concat_ws(":", c["check_key"], c["count_failed"].cast("string"))), ",").alias("checks"))


@query("agg_03_value_map", "SELECT education_level AS source, CASE WHEN lower(education_level) IN ('primary', 'basic') THEN 'Primary' WHEN lower(education_level) = 'secondary' THEN 'Secondary' ELSE 'Unknown' END AS target, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS percent FROM fx_school GROUP BY 1, 2")
def agg_03(t):
    rows = P.map_values(t.fx_school, "education_level", t.fx_map, out="mapped")
    return R.value_map_report(rows, "education_level", "mapped")


@query("agg_04_first_measurement", "SELECT school_id, country_key, source, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_time FROM fx_measure GROUP BY 1, 2, 3")
def agg_04(t):
    return R.first_times(t.fx_measure, ["school_id", "country_key", "source"], "ts").withColumn("first_time", F.date_format("first_time", "yyyy-MM-dd HH:mm:ss"))


@query("agg_05_over_tables", "SELECT school_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_time FROM fx_measure GROUP BY 1")
def agg_05(t):
    tables = [t.fx_measure.where(F.col("country_key") == k).select("school_id", "ts") for k in range(5)]
    return R.first_times(W.union_by_name(tables), ["school_id"], "ts").withColumn("first_time", F.date_format("first_time", "yyyy-MM-dd HH:mm:ss"))


@query("agg_06_json_min_over", "SELECT DISTINCT school_id, strftime(min(ts) OVER (PARTITION BY school_id), '%Y-%m-%d %H:%M:%S') AS first_time FROM fx_measure WHERE json_valid(props) AND length(props) > 2")
def agg_06(t):
    rows = t.fx_measure.where(F.get_json_object("props", "$").isNotNull() & (F.length("props") > 2))
    return R.first_times(rows, ["school_id"], "ts").withColumn("first_time", F.date_format("first_time", "yyyy-MM-dd HH:mm:ss"))


@query("agg_10_high_water", "SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS high_water FROM fx_status")
def agg_10(t):
    return R.high_water(t.fx_status, "ts").withColumn("high_water", F.date_format("high_water", "yyyy-MM-dd HH:mm:ss"))


@query("agg_11_summary_by", "SELECT source, country_key, count(*) AS rows, count(DISTINCT school_id) AS ids FROM fx_measure GROUP BY 1, 2")
def agg_11(t):
    return R.summary_by(t.fx_measure, ["source", "country_key"], "school_id")


@query("agg_11_describe", "SELECT 'num_computers' AS column, count(num_computers) AS n, CAST(min(num_computers) AS DOUBLE) AS least, CAST(max(num_computers) AS DOUBLE) AS most, avg(num_computers) AS mean FROM fx_school UNION ALL SELECT 'row_key', count(row_key), min(row_key), max(row_key), avg(row_key) FROM fx_school")
def agg_11_describe(t):
    return R.describe(t.fx_school, ["num_computers", "row_key"])


#: Distinct ids of a range of days against their estimate, which has to be within 3 %, four times its standard error.
RANGE = "day BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"


@query("agg_11_merged_days", f"WITH m AS (SELECT *, CAST(ts AS DATE) AS day FROM fx_measure) SELECT source, country_key, count(*) AS rows, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last, true AS near FROM m WHERE {RANGE} GROUP BY 1, 2")
def agg_11_merged(t):
    rows = t.fx_measure
    told = D.merged(D.day_summaries(rows, ["source", "country_key"], "ts", "school_id"), ["source", "country_key"], F.lit("2024-01-05").cast("date"), F.lit("2024-01-20").cast("date"))
    exact = rows.where(F.to_date("ts").between(F.lit("2024-01-05"), F.lit("2024-01-20"))).groupBy("source", "country_key").agg(F.countDistinct("school_id").alias("exact"))
    both = told.join(exact, ["source", "country_key"]).withColumn("near", F.abs(F.col("ids") - F.col("exact")) <= F.ceil(F.col("exact") * 0.03))
    return both.select("source", "country_key", "rows", *(F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("first", "last")), "near")


@query("agg_12_merged_values", "WITH m AS (SELECT event_type, round(value, 3) AS v FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-10') SELECT event_type, count(v) AS n, min(v) AS least, max(v) AS most, round(avg(v), 4) AS mean, true AS near FROM m GROUP BY 1")
def agg_12_merged(t):
    rows = t.events.withColumn("value", F.round("value", 3))
    told = D.merged(D.day_summaries(rows, ["event_type"], "ts", "user_id", "value"), ["event_type"], F.lit("2024-01-10").cast("date"), ranks=(0.25, 0.5, 0.9))
    # a quantile's rank among all values, which has to be within 2 % of what was asked for
    each = rows.where(F.to_date("ts") >= F.lit("2024-01-10")).join(told.select("event_type", "quantiles"), "event_type")
    ranks = each.groupBy("event_type").agg(*(F.avg((F.col("value") <= F.col("quantiles")[k]).cast("double")).alias(f"r{k}") for k in range(3)), *(F.avg((F.col("value") < F.col("quantiles")[k]).cast("double")).alias(f"l{k}") for k in range(3)))
    near = (F.col("r0") >= 0.23) & (F.col("l0") <= 0.27) & (F.col("r1") >= 0.48) & (F.col("l1") <= 0.52) & (F.col("r2") >= 0.88) & (F.col("l2") <= 0.92)
    return told.join(ranks, "event_type").select("event_type", "n", "least", "most", F.round("mean", 4).alias("mean"), near.alias("near"))


@query("agg_12_bounds", "SELECT min(latitude) AS min_latitude, max(latitude) AS max_latitude, min(longitude) AS min_longitude, max(longitude) AS max_longitude, round(avg(latitude), 6) AS centre_latitude, round(avg(longitude), 6) AS centre_longitude FROM fx_school")
def agg_12(t):
    return R.bounds(t.fx_school).withColumns({c: F.round(c, 6) for c in ("centre_latitude", "centre_longitude")})


@query("agg_13_bucket_mean", "SELECT user_id, round(avg(v), 6) AS mean FROM (SELECT user_id, date_trunc('hour', ts) AS h, max(value) AS v FROM events WHERE event_type <> 'error' GROUP BY 1, 2) GROUP BY 1")
def agg_13(t):
    buckets = t.events.where("event_type <> 'error'").groupBy("user_id", F.date_trunc("hour", "ts").alias("h")).agg(F.max("value").alias("v"))
    return buckets.groupBy("user_id").agg(F.round(F.avg("v"), 6).alias("mean"))


@query("agg_14_null_counts", "SELECT 'school_id_giga' AS column, count_if(school_id_giga IS NULL) AS nulls FROM fx_school UNION ALL SELECT 'latitude', count_if(latitude IS NULL) FROM fx_school UNION ALL SELECT 'row_key', count_if(row_key IS NULL) FROM fx_school")
def agg_14(t):
    return R.null_counts(t.fx_school, ["school_id_giga", "latitude", "row_key"])


@query("agg_15_cross_counts", "SELECT latitude IS NULL AS row, count_if(electricity_availability = 'yes') AS yes, count_if(electricity_availability = 'no') AS no FROM fx_school GROUP BY 1")
def agg_15(t):
    return R.cross_counts(t.fx_school, F.col("latitude").isNull(), "electricity_availability", ["yes", "no"])
