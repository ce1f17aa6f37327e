"""Queries of sources and of end-to-end jobs."""

from pyspark.sql import functions as F

from ..operators import merge as M
from ..operators import project as P
from ..operators.windows import union_by_name
from ..registry import query
from ..sources import readers as D
from . import jobs
from .checks import HOLDING, sides
from .events import UPTIME, window

COLS = ["pk", "name", "qty"]


def now():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")
YEAR = 2024


@query("src_02_read_parquet", "SELECT n_nationkey, n_name FROM nation")
def src_02(t):
    return D.read_parquet(t.spark, f"{t.sf_dir}/nation.parquet").select("n_nationkey", "n_name")


@query("src_04_null_normalised", "SELECT row_key, CASE WHEN row_key % 7 IN (1, 2) THEN NULL ELSE school_name END AS school_name, CASE WHEN row_key % 5 = 0 THEN NULL ELSE latitude END AS latitude FROM fx_school")
def src_04(t):
    rows = t.fx_school.select("row_key", F.expr("CASE WHEN row_key % 7 = 1 THEN ' ' WHEN row_key % 7 = 2 THEN 'NaN' ELSE school_name END").alias("school_name"), F.expr("CASE WHEN row_key % 5 = 0 THEN double('NaN') ELSE latitude END").alias("latitude"))
    return D.null_normalised(rows)


@query("src_06_read_table", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def src_06(t):
    t.nation.createOrReplaceTempView("quarrykit_nation")
    return D.read_table(t.spark, "quarrykit_nation").select("n_nationkey", "n_name", "n_regionkey")


@query("src_09_measurement_scan", "SELECT e.school_id, n.n_name AS country, count(*) AS n FROM fx_measure e JOIN nation n ON e.country_key = n.n_nationkey WHERE e.source <> 'qos' GROUP BY 1, 2")
def src_09(t):
    sql = "SELECT e.school_id, n.n_name AS country, count(*) AS n FROM {measure} e JOIN {nation} n ON e.country_key = n.n_nationkey WHERE e.source <> 'qos' GROUP BY 1, 2"
    return t.spark.sql(sql, measure=t.fx_measure, nation=t.nation)


@query("src_10_parts_of_name", r"SELECT page_id, nullif(regexp_extract(url, '^(https?)://([^/]+)/([a-z]{2})/', 1), '') AS scheme, nullif(regexp_extract(url, '^(https?)://([^/]+)/([a-z]{2})/', 2), '') AS host, nullif(regexp_extract(url, '^(https?)://([^/]+)/([a-z]{2})/', 3), '') AS lang FROM pages")
def src_10(t):
    return t.pages.select("page_id", *(c.alias(n) for n, c in D.parts_of_name("url", "^(https?)://([^/]+)/([a-z]{2})/", ["scheme", "host", "lang"]).items()))


@query("src_11_flatten_payload", "SELECT event_id, event_type AS data_kind, CAST(user_id AS BIGINT) AS data_user FROM events")
def src_11(t):
    rows = t.events.select("event_id", F.to_json(F.struct(F.array(F.struct(F.struct(F.col("event_type").alias("kind"), F.col("user_id").alias("user")).alias("data"))).alias("items"))).alias("body"))
    return D.flatten_payload(rows, "body", "items ARRAY<STRUCT<data: STRUCT<kind: STRING, user: BIGINT>>>", "items")


@query("src_12_device_payload", "SELECT event_id, CAST(user_id AS VARCHAR) AS device_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, event_type AS status FROM events")
def src_12(t):
    when = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    body = F.to_json(F.struct(F.struct(F.col("user_id").cast("string").alias("id")).alias("device"), F.when(F.expr("event_id % 3 = 0"), when).alias("ts"), F.when(F.expr("event_id % 3 = 1"), when).alias("time"), when.alias("occurredAt"), F.struct(F.array(F.struct(F.lit("other").alias("name"), F.lit("x").alias("value")), F.struct(F.lit("status").alias("name"), F.col("event_type").alias("value"))).alias("new")).alias("details")))
    # the id travels as the device's name, since the operator keeps only what the payload has
    named = F.regexp_replace(body, '"device":\\{', F.concat(F.lit('"device":{"name":"'), F.col("event_id").cast("string"), F.lit('",')))
    made = D.device_events(t.events.select(named.alias("body")), "body")
    return made.select(F.col("deviceName").cast("bigint").alias("event_id"), "device_id", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("at"), F.col("newStatus").alias("status"))


def geolocation(t):
    stored = t.fx_school.where("row_key % 3 <> 0").select("school_id_govt", "school_name", "num_computers").dropDuplicates(["school_id_govt"])
    stored = stored.where("CAST(school_id_govt AS BIGINT) % 20 NOT IN (6)")
    return jobs.upload_job(t.fx_school, stored, "geolocation", key="school_id_govt", columns=["school_id_govt", "school_name", "num_computers"], upload="u1", at=now(), year=YEAR, always=["dq_is_null_mandatory-school_id_govt", "dq_duplicate-school_id_govt"])


GEO_STAGED = """p AS (SELECT school_id_govt, school_name, num_computers FROM (SELECT *, count(*) OVER (PARTITION BY school_id_govt) AS n FROM fx_school) WHERE n = 1),
m AS (SELECT school_id_govt, school_name, num_computers FROM fx_school WHERE row_key % 3 <> 0 AND CAST(school_id_govt AS BIGINT) % 20 <> 6),
s AS (SELECT p.school_id_govt, coalesce(p.school_name, m.school_name) AS school_name, coalesce(p.num_computers, m.num_computers) AS num_computers, CASE WHEN m.school_id_govt IS NULL THEN 'INSERT' ELSE 'UNCHANGED' END AS change_type FROM p LEFT JOIN m ON p.school_id_govt = m.school_id_govt)"""


@query("pipe_01_geolocation_staged", f"WITH {GEO_STAGED} SELECT *, school_id_govt || '|u1|' || change_type AS change_id FROM s")
def pipe_01(t):
    return geolocation(t).staged.select("school_id_govt", "school_name", "num_computers", "change_type", "change_id")


@query("pipe_01_geolocation_summary", f"WITH {GEO_STAGED}, k AS (SELECT school_id_govt, count(*) OVER (PARTITION BY school_id_govt) AS n, school_id_govt NOT IN (SELECT school_id_govt FROM m) AS is_new FROM fx_school) SELECT count(*) AS rows, count_if(n = 1) AS rows_passed, count_if(n > 1) AS rows_failed, count_if(n = 1 AND is_new) AS rows_created, count_if(n = 1 AND NOT is_new) AS rows_updated FROM k")
def pipe_01_summary(t):
    return geolocation(t).summary.select("rows", "rows_passed", "rows_failed", "rows_created", "rows_updated")


BETTER = """a AS (SELECT school_key, CASE coverage_type WHEN '5G' THEN 5 WHEN '4G' THEN 4 WHEN '3G' THEN 3 WHEN '2G' THEN 2 ELSE 1 END AS g FROM fx_cov_silver),
m AS (SELECT coalesce(b.school_key, a.school_key) AS school_id_giga, greatest(coalesce(a.g, 0), coalesce(b.g, 0)) AS g {others} FROM a FULL JOIN b ON a.school_key = b.school_key)
SELECT school_id_giga, CASE g WHEN 1 THEN 'no coverage' ELSE CAST(g AS VARCHAR) || 'G' END AS cellular_coverage_type, CASE g WHEN 1 THEN 'no' ELSE 'yes' END AS available {names} FROM m"""


def stored_coverage(t):
    return t.fx_cov_silver.select(F.col("school_key").alias("school_id_giga"), F.col("coverage_type").alias("cellular_coverage_type"), (F.col("school_key") * 1.5).cast("double").alias("nearest_LTE_distance"))


def coverage_fb(t):
    return jobs.coverage_job(t.fx_cov_a, stored_coverage(t), "fb", year=YEAR, renames={"school_key": "school_id_giga"} | {f"percent_{g}g": f"percent_{g}G" for g in (2, 3, 4)})


def coverage_itu(t):
    return jobs.coverage_job(t.fx_cov_itu, stored_coverage(t), "itu", year=YEAR, renames={"school_key": "school_id_giga", "dist_4g": "4g_cell_site_dist"} | {f"mobile_{g}g": f"{g}g_mobile_coverage" for g in (2, 3, 4, 5)})


@query("pipe_02_coverage", "WITH b AS (SELECT school_key, CASE WHEN percent_4g > 0 THEN 4 WHEN percent_3g > 0 THEN 3 WHEN percent_2g > 0 THEN 2 ELSE 1 END AS g FROM fx_cov_a WHERE school_key IS NOT NULL), " + BETTER.format(others="", names=""))
def pipe_02(t):
    return coverage_fb(t)[1].drop("nearest_LTE_distance")


@query("pipe_02_coverage_itu", "WITH b AS (SELECT school_key, dist_4g, CASE WHEN mobile_5g = 1 THEN 5 WHEN mobile_4g = 1 THEN 4 WHEN mobile_3g = 1 THEN 3 WHEN mobile_2g = 1 THEN 2 ELSE 1 END AS g FROM fx_cov_itu WHERE school_key IS NOT NULL AND mobile_3g IS NOT NULL), " + BETTER.format(others=", coalesce(b.dist_4g, a.school_key * 1.5) AS dist", names=', CAST(dist AS DOUBLE) AS "nearest_LTE_distance"'))
def pipe_02_itu(t):
    return coverage_itu(t)[1]


@query("pipe_02_checked", "SELECT school_key AS school_id_giga, CASE WHEN percent_2g + percent_3g + percent_4g <> 100 THEN 1 ELSE 0 END AS bad_sum, CASE WHEN school_key IS NULL THEN 1 ELSE 0 END AS critical FROM fx_cov_a UNION ALL SELECT school_key, CASE WHEN dist_4g IS NOT NULL THEN 1 ELSE 0 END, CASE WHEN school_key IS NULL OR mobile_3g IS NULL THEN 1 ELSE 0 END FROM fx_cov_itu")
def pipe_02_checked(t):
    fb = coverage_fb(t)[0].select("school_id_giga", F.col("dq_is_sum_of_percent_not_equal_100").alias("bad_sum"), F.col("dq_has_critical_error").alias("critical"))
    return fb.union(coverage_itu(t)[0].select("school_id_giga", F.col("`dq_column_relation_checks-nearest_LTE_id_4g_cell_site_dist`"), "dq_has_critical_error"))


APPROVED = """s AS (SELECT i.pk, coalesce(i.name, m.name) AS name, coalesce(i.qty, m.qty) AS qty, CASE WHEN m.pk IS NULL THEN 'INSERT' WHEN coalesce(i.name, m.name) IS NOT DISTINCT FROM m.name AND coalesce(i.qty, m.qty) IS NOT DISTINCT FROM m.qty THEN 'UNCHANGED' ELSE 'UPDATE' END AS change_type FROM fx_incoming i LEFT JOIN fx_master m ON i.pk = m.pk),
c AS (SELECT * FROM s WHERE change_type <> 'UNCHANGED' AND pk % 2 = 0),
v AS (SELECT m.pk, coalesce(c.name, m.name) AS name, coalesce(c.qty, m.qty) AS qty FROM fx_master m LEFT JOIN c ON m.pk = c.pk UNION ALL SELECT pk, name, qty FROM c WHERE pk NOT IN (SELECT pk FROM fx_master)),
w AS (SELECT pk, coalesce(name, 'Unknown') AS name, qty FROM v)"""


def approval(t):
    staged = M.stage_upload(t.fx_incoming, t.fx_master, "pk", COLS, "u1", now())
    approved = staged.where("change_type <> 'UNCHANGED' AND pk % 2 = 0").select("change_id")
    return jobs.approval_job(t.fx_master.select(COLS), t.fx_master.select(COLS), staged, approved, "pk", COLS, ["name", "qty"])


@query("pipe_03_approval_master", f"WITH {APPROVED} SELECT *, sha256(concat_ws('|', name, CAST(pk AS VARCHAR), CAST(qty AS VARCHAR))) AS signature FROM w")
def pipe_03(t):
    return approval(t).master


@query("pipe_03_release_notes", f"WITH {APPROVED}, d AS (SELECT w.pk, m.pk AS old, w.name AS n1, m.name AS n0, w.qty AS q1, m.qty AS q0 FROM w LEFT JOIN fx_master m ON w.pk = m.pk), u AS (SELECT 'name' AS column, count_if(old IS NULL OR n0 IS DISTINCT FROM n1) AS changes FROM d UNION ALL SELECT 'qty', count_if(old IS NULL OR q0 IS DISTINCT FROM q1) FROM d) SELECT * FROM u WHERE changes > 0")
def pipe_03_notes(t):
    return approval(t).column_counts


def measures(t):
    return t.fx_measure.select(F.col("school_id").alias("pk"), F.col("ts").cast("timestamp").alias("ts"), "source")


@query("pipe_04_qos", "SELECT pk, source, count(*) AS n FROM (SELECT DISTINCT school_id AS pk, ts, source FROM fx_measure WHERE school_id IN (SELECT pk FROM fx_master)) GROUP BY 1, 2")
def pipe_04(t):
    gold = P.event_key(measures(t).where("pk % 2 = 0").join(t.fx_master.select("pk"), "pk", "left_semi"), ["pk", "ts", "source"], "ts")
    return jobs.qos_job(measures(t), t.fx_master, gold, key="pk", time="ts", event_keys=["pk", "ts", "source"]).groupBy("pk", "source").agg(F.count(F.lit(1)).alias("n"))


@query("pipe_05_real_time", "WITH f AS (SELECT school_id AS pk, strftime(min(ts), '%Y-%m-%d') AS first_seen, string_agg(DISTINCT source, ', ' ORDER BY source) AS sources FROM fx_measure GROUP BY 1), m AS (SELECT pk, CASE WHEN pk % 2 = 0 THEN '2020-01-01' END AS first_seen, 'old' AS sources FROM fx_master) SELECT coalesce(m.pk, f.pk) AS pk, coalesce(m.first_seen, f.first_seen) AS first_seen, coalesce(f.sources, m.sources) AS sources FROM m FULL JOIN f ON m.pk = f.pk")
def pipe_05(t):
    stored = t.fx_master.select("pk", F.expr("CASE WHEN pk % 2 = 0 THEN timestamp('2020-01-01') END").alias("first_seen"), F.lit("old").alias("sources"))
    by = {n: measures(t).where(F.col("source") == n) for n in ("meter", "mlab", "qos")}
    return jobs.real_time_job(by, stored, ["pk"], "ts")[1].withColumn("first_seen", F.date_format("first_seen", "yyyy-MM-dd"))


@query("pipe_06_bulk_load", "SELECT min(row_key) AS row_key, school_id_govt, arg_min(CASE WHEN num_computers BETWEEN 0 AND 500 THEN 0 ELSE 1 END, row_key) AS bad_range FROM fx_school GROUP BY 2")
def pipe_06(t):
    rows = t.fx_school.withColumn("num_computers", F.col("num_computers").cast("string"))
    checked, _ = jobs.bulk_load_job(rows, "school_id_govt", [F.col("row_key")], "geolocation", YEAR, {"num_computers": "int"})
    return checked.select("row_key", "school_id_govt", F.col("dq_is_invalid_range-num_computers").alias("bad_range"))


@query("pipe_07_regenerate", "SELECT pk, name, qty FROM fx_incoming UNION ALL SELECT m.pk, coalesce(m.name, 'ref'), m.qty FROM fx_master m WHERE m.pk NOT IN (SELECT pk FROM fx_incoming)")
def pipe_07(t):
    reference = t.fx_master.select("pk", F.lit("ref").alias("name"))
    return jobs.regenerate_job(t.fx_master.select(COLS), reference, t.fx_incoming, "pk", COLS)


@query("pipe_08_facilities", f"{HOLDING.format(some='TRUE')} SELECT row_key, school_name IS NOT NULL AS named, CAST(NULL AS VARCHAR) AS owner, c AS admin1 FROM fx_place LEFT JOIN holding ON latitude = y AND longitude = x")
def pipe_08(t):
    made = jobs.facility_job(t.fx_place.drop("country_key"), ["school_id_govt", "school_name"], [("owner", "string")], sides(t), "country_key")
    return made.select("row_key", F.col("facility_id").isNotNull().alias("named"), "owner", "admin1")


@query("pipe_09_custom_dataset", "SELECT DISTINCT name, level FROM (SELECT name, level FROM fx_master UNION ALL SELECT name, level FROM fx_incoming)")
def pipe_09(t):
    return jobs.custom_dataset_job(union_by_name([t.fx_master.select("name", "level"), t.fx_incoming.select("name", "level")]))


@query("pipe_10_availability_files", "SELECT school_id AS pk, count(*) AS n FROM (SELECT DISTINCT school_id, ts, source FROM fx_measure) GROUP BY 1")
def pipe_10(t):
    gold = P.event_key(measures(t).where("pk % 3 = 0"), ["pk", "ts", "source"], "ts")
    raw = measures(t).withColumn("pk", F.col("pk").cast("string"))
    return jobs.availability_file_job(raw, gold, ["pk", "ts", "source"], "ts", {"pk": "bigint"}).groupBy("pk").agg(F.count(F.lit(1)).alias("n"))


@query("pipe_11_school_list", "SELECT i.pk, coalesce(i.name, m.name) AS name, m.level, CASE WHEN m.pk IS NULL THEN 'INSERT' WHEN coalesce(i.name, m.name) IS NOT DISTINCT FROM m.name THEN 'UNCHANGED' ELSE 'UPDATE' END AS change_type FROM fx_incoming i LEFT JOIN fx_master m ON i.pk = m.pk")
def pipe_11(t):
    rows = t.fx_incoming.select(F.col("pk").alias("code"), F.col("name").alias("title"))
    return jobs.list_job(rows, {"code": "pk", "title": "name"}, t.fx_master, "pk", ["level"], "u1", now()).select("pk", "name", "level", "change_type")


#: Time online in whole microseconds: an hour's percentage is rounded half up to thousandths, and sums of fractions of a second leave halves to chance.
UPTIME_US = UPTIME.replace(" / 1e6 AS s", " AS us")


@query("pipe_12_uptime", f"WITH {UPTIME_US}, h AS (SELECT device_id, hour, (CAST(sum(us) AS BIGINT) + 18000) // 36000 AS up FROM u GROUP BY 1, 2) SELECT h.device_id, count(*) AS hours, CAST(sum(up) AS BIGINT) AS total, min(name) AS name FROM h LEFT JOIN fx_master m ON h.device_id = CAST(m.pk AS VARCHAR) GROUP BY 1")
def pipe_12(t):
    devices = t.fx_master.select(F.col("pk").cast("string").alias("device_id"), "name")
    made = jobs.uptime_job(t.fx_status, devices, *window(t))
    return made.groupBy("device_id").agg(F.count(F.lit(1)).alias("hours"), F.sum(F.round(F.col("uptime_percentage") * 1000).cast("bigint")).alias("total"), F.min("name").alias("name"))


@query("pipe_13_registry", "SELECT name, CASE WHEN id % 2 = 0 THEN 'double' ELSE data_type END AS data_type FROM fx_registry")
def pipe_13(t):
    return jobs.registry_job(t.fx_registry, t.fx_registry.where("id % 2 = 0").withColumn("data_type", F.lit("double"))).select("name", "data_type")


@query("pipe_14_feed_fixture", "SELECT 'update_preimage' AS kind, count(*) AS n, 1 AS version FROM fx_master WHERE pk % 4 = 0 UNION ALL SELECT 'update_postimage', count(*), 1 FROM fx_master WHERE pk % 4 = 0 UNION ALL SELECT 'delete', count(*), 2 FROM fx_master WHERE pk % 5 = 0")
def pipe_14(t):
    versions = jobs.feed_fixture(t.fx_master, ["pk"], F.expr("pk % 4 = 0"), F.expr("pk % 5 = 0"))
    feed = union_by_name([M.snapshot_diff(a, b, ["pk"], k) for k, (a, b) in enumerate(zip(versions, versions[1:], strict=False), 1)])
    return feed.groupBy(F.col(M.KIND).alias("kind"), F.col(M.VERSION).alias("version")).agg(F.count(F.lit(1)).alias("n"))


@query("pipe_16_bronze_columns", "SELECT row_key, row_key % 2 <> 0 AS is_new, coalesce(m.dst, 'Unknown') AS education_level, upper(substr(connectivity_govt, 1, 1)) || lower(substr(connectivity_govt, 2)) AS connectivity_govt, CASE WHEN s.school_id_giga IS NOT NULL AND row_key % 3 = 0 THEN 'Yes' ELSE 'No' END AS \"connectivity_RT\", connectivity_govt IS NOT NULL AS stamped FROM fx_school s LEFT JOIN fx_map m ON lower(trim(s.education_level)) = lower(trim(m.src))")
def pipe_16(t):
    base = t.fx_school.where("row_key % 2 = 0").select("row_key")
    flags = t.fx_school.where("row_key % 3 = 0").select("school_id_giga", F.lit("Yes").alias("connectivity_RT"))
    made = jobs.bronze_columns(t.fx_school, base=base, key="row_key", levels=t.fx_map, real_time=flags, now=now())
    return made.select("row_key", "is_new", "education_level", "connectivity_govt", "connectivity_RT", F.col("connectivity_govt_ingestion_timestamp").isNotNull().alias("stamped"))
