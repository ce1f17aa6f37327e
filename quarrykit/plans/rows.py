"""Queries of filters, joins, windows, sorts and set operations."""

from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators import windows as W
from ..registry import query

CHECKED = "SELECT pk, name, qty, CASE WHEN name IS NULL THEN 1 ELSE 0 END AS dq_has_critical_error FROM fx_incoming"


def checked(t):
    return t.fx_incoming.select("pk", "name", "qty", F.when(F.col("name").isNull(), 1).otherwise(0).alias("dq_has_critical_error"))


@query("flt_01_passed", f"SELECT pk, name, qty FROM ({CHECKED}) WHERE dq_has_critical_error = 0")
def flt_01(t):
    return J.passed(checked(t))


@query("flt_01_failed", f"SELECT * FROM ({CHECKED}) WHERE dq_has_critical_error = 1")
def flt_01_failed(t):
    return J.failed(checked(t))


@query("flt_02_with_keys", "SELECT 'list' AS how, pk FROM fx_staged WHERE change_id IN ('c2', 'c4', 'c6') UNION ALL SELECT 'all', pk FROM fx_staged UNION ALL SELECT 'table', pk FROM fx_staged WHERE pk IN (SELECT pk FROM fx_master)")
def flt_02(t):
    made = {"list": J.with_keys(t.fx_staged, "change_id", ["c2", "c4", "c6"]), "all": J.with_keys(t.fx_staged, "change_id", [J.ALL]), "none": J.with_keys(t.fx_staged, "change_id", []), "table": J.with_keys(t.fx_staged, "pk", t.fx_master.select("pk"))}
    return W.union_by_name([df.select(F.lit(k).alias("how"), "pk") for k, df in made.items()])


@query("flt_03_pending_changes", "SELECT pk FROM fx_staged WHERE upload_id = 'up2' AND status = 'PENDING' AND change_type <> 'UNCHANGED'")
def flt_03(t):
    return J.pending_changes(t.fx_staged, "up2").select("pk")


@query("flt_04_delete_selection", "SELECT row_key FROM fx_school WHERE school_id_giga IN (SELECT school_id_giga FROM fx_school WHERE row_key % 5 = 0) OR school_id_govt IN ('4', '8')")
def flt_04(t):
    by_giga = J.with_keys(t.fx_school, "school_id_giga", t.fx_school.where("row_key % 5 = 0").select("school_id_giga"))
    return by_giga.union(J.with_keys(t.fx_school, "school_id_govt", ["4", "8"])).select("row_key").distinct()


@query("flt_06_on_map", "SELECT row_key FROM fx_school WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180")
def flt_06(t):
    return J.on_map(t.fx_school).select("row_key")


@query("flt_07_slice", "SELECT pk, name, level, qty FROM fx_master WHERE country_key = 3")
def flt_07(t):
    return J.slice_of(t.fx_master, "country_key", 3)


@query("flt_08_event_window", "SELECT event_id FROM fx_status WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12' AND device_id IS NOT NULL")
def flt_08(t):
    ts = F.col("ts").cast("timestamp")
    return t.fx_status.where((ts >= "2024-01-05") & (ts < "2024-01-12") & F.col("device_id").isNotNull()).select("event_id")


@query("flt_09_duplicates", "SELECT row_key, row_number() OVER (PARTITION BY school_id_govt ORDER BY row_key) <> 1 AS duplicate FROM fx_school")
def flt_09(t):
    return W.numbered(t.fx_school, ["school_id_govt"], [F.col("row_key")]).select("row_key", (F.col("row_num") != 1).alias("duplicate"))


@query("flt_10_keys_of_list", "SELECT pk, name FROM fx_master WHERE pk IN (SELECT pk FROM fx_incoming WHERE qty % 2 = 0)")
def flt_10(t):
    return J.with_keys(t.fx_master, "pk", t.fx_incoming.where("qty % 2 = 0").select("pk")).select("pk", "name")


@query("jn_01_is_new", "SELECT pk, pk NOT IN (SELECT pk FROM fx_master) AS is_new FROM fx_incoming")
def jn_01(t):
    return J.add_is_new(t.fx_incoming, t.fx_master.union(t.fx_master), "pk").select("pk", "is_new")


@query("jn_02_enrich", "SELECT i.pk, coalesce(i.name, m.name) AS name, coalesce(m.qty, i.qty) AS qty, m.level AS level FROM fx_incoming i LEFT JOIN fx_master m ON i.pk = m.pk")
def jn_02(t):
    return J.enrich(t.fx_incoming.select("pk", "name", "qty"), t.fx_master, "pk", ["name", "qty", "level"], authoritative=["qty"])


@query("jn_03_base_columns", "SELECT i.pk, i.name, m.level, m.country_key FROM (SELECT pk, name FROM fx_incoming) i LEFT JOIN fx_master m ON i.pk = m.pk")
def jn_03(t):
    return J.lookup(t.fx_incoming.select("pk", "name"), t.fx_master, "pk", ["level", "country_key"])


@query("jn_04_fill_from_base", "SELECT i.pk, coalesce(i.name, m.name) AS name, coalesce(i.level, m.level) AS level FROM fx_incoming i LEFT JOIN fx_master m ON i.pk = m.pk")
def jn_04(t):
    return J.enrich(t.fx_incoming, t.fx_master, "pk", ["name", "level"]).select("pk", "name", "level")


@query("jn_05_known_only", "SELECT school_id, props FROM fx_measure WHERE school_id IN (SELECT pk FROM fx_master)")
def jn_05(t):
    return J.known_only(t.fx_measure, t.fx_master, "pk") if "pk" in t.fx_measure.columns else J.known_only(t.fx_measure.withColumnRenamed("school_id", "pk"), t.fx_master, "pk").select(F.col("pk").alias("school_id"), "props")


@query("jn_06_resolve_id", "SELECT e.school_id, m.name FROM fx_measure e JOIN fx_master m ON e.school_id = m.pk")
def jn_06(t):
    return J.lookup(t.fx_measure.withColumnRenamed("school_id", "pk"), t.fx_master, "pk", ["name"], how="inner").select(F.col("pk").alias("school_id"), "name")


@query("jn_07_anti", "SELECT 'insert' AS kind, pk FROM fx_incoming WHERE pk NOT IN (SELECT pk FROM fx_master) UNION ALL SELECT 'delete', pk FROM fx_master WHERE pk NOT IN (SELECT pk FROM fx_incoming)")
def jn_07(t):
    new, gone = J.inserts_and_deletes(t.fx_master, t.fx_incoming, ["pk"])
    return new.select(F.lit("insert").alias("kind"), "pk").union(gone.select(F.lit("delete"), "pk"))


def by_source(t, *names):
    return {n: t.fx_measure.where(F.col("source") == n) for n in names}


@query("jn_08_reconcile_sources", "SELECT school_id, country_key, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_seen, string_agg(DISTINCT source, ', ' ORDER BY source) AS sources FROM fx_measure GROUP BY 1, 2")
def jn_08(t):
    made = J.first_seen(by_source(t, "meter", "mlab", "qos"), ["school_id", "country_key"], "ts")
    return made.withColumn("first_seen", F.date_format("first_seen", "yyyy-MM-dd HH:mm:ss"))


@query("jn_09_fourth_source", "WITH u AS (SELECT school_id, CASE WHEN country_key = 2 THEN 7 ELSE country_key END AS country_key, ts, source FROM fx_measure UNION ALL SELECT user_id, 7, ts, 'manual' FROM events WHERE event_type = 'signup') SELECT school_id, country_key, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_seen, string_agg(DISTINCT source, ', ' ORDER BY source) AS sources FROM u GROUP BY 1, 2")
def jn_09(t):
    moved = {n: df.withColumn("country_key", F.when(F.col("country_key") == 2, 7).otherwise(F.col("country_key"))) for n, df in by_source(t, "meter", "mlab", "qos").items()}
    moved["manual"] = t.events.where("event_type = 'signup'").select(F.col("user_id").alias("school_id"), F.lit(7).alias("country_key"), "ts")
    return J.first_seen(moved, ["school_id", "country_key"], "ts").withColumn("first_seen", F.date_format("first_seen", "yyyy-MM-dd HH:mm:ss"))


RANK = "CASE {0} WHEN '5G' THEN 5 WHEN '4G' THEN 4 WHEN '3G' THEN 3 WHEN '2G' THEN 2 WHEN 'no coverage' THEN 1 ELSE 0 END"


@query("jn_10_merge_coverage", f"WITH a AS (SELECT school_key, coverage_type FROM fx_cov_silver), b AS (SELECT school_key, CASE WHEN percent_4g > 0 THEN '4G' WHEN percent_3g > 0 THEN '3G' WHEN percent_2g > 0 THEN '2G' ELSE 'no coverage' END AS coverage_type FROM fx_cov_a WHERE school_key IS NOT NULL), m AS (SELECT coalesce(b.school_key, a.school_key) AS school_key, CASE WHEN {RANK.format('a.coverage_type')} >= {RANK.format('b.coverage_type')} THEN a.coverage_type ELSE b.coverage_type END AS coverage_type FROM a FULL JOIN b ON a.school_key = b.school_key) SELECT *, CASE WHEN coverage_type = 'no coverage' THEN 'no' ELSE 'yes' END AS available FROM m")
def jn_10(t):
    from ..operators.project import best_technology, coverage_flags

    new = coverage_flags(t.fx_cov_a, "school_key", {"percent_2g": "g2", "percent_3g": "g3", "percent_4g": "g4"})
    return J.merge_coverage(t.fx_cov_silver, new.select("school_key", best_technology({"2G": "g2", "3G": "g3", "4G": "g4"}).alias("coverage_type")), "school_key", "coverage_type")


@query("jn_11_two_lookups", "SELECT e.school_id, e.source, m.name, n.n_name FROM fx_measure e LEFT JOIN fx_master m ON e.school_id = m.pk LEFT JOIN nation n ON e.country_key = n.n_nationkey")
def jn_11(t):
    rows = J.lookup(t.fx_measure.withColumnRenamed("school_id", "pk"), t.fx_master, "pk", ["name"])
    return J.lookup(rows.withColumnRenamed("country_key", "n_nationkey"), t.nation, "n_nationkey", ["n_name"]).select(F.col("pk").alias("school_id"), "source", "name", "n_name")


@query("jn_12_flag_by_text_key", "SELECT s.row_key, coalesce(f.rt, 'No') AS rt FROM fx_school s LEFT JOIN (SELECT DISTINCT school_id_giga AS k, 'Yes' AS rt FROM fx_school WHERE row_key % 3 = 0 AND school_id_giga IS NOT NULL) f ON lower(s.school_id_giga) = lower(f.k)")
def jn_12(t):
    flags = t.fx_school.where("row_key % 3 = 0").select(F.upper("school_id_giga").alias("school_id_giga"), F.lit("Yes").alias("rt"))
    return J.flag_by_text_key(t.fx_school, flags, "school_id_giga", "rt").select("row_key", "rt")


@query("jn_15_device_to_school", "SELECT d.device_id, m.pk, m.name FROM (SELECT DISTINCT device_id FROM fx_status) d LEFT JOIN fx_master m ON d.device_id = CAST(m.pk AS VARCHAR)")
def jn_15(t):
    devices = W.first_per_key(t.fx_status, ["device_id"], [F.col("ts"), F.col("event_id")]).select(F.col("device_id").alias("pk"))
    held = t.fx_master.select("pk", F.col("pk").alias("master_pk"), "name")
    return J.lookup(devices, held, "pk", ["master_pk", "name"], key_as="string").select(F.col("pk").alias("device_id"), F.col("master_pk").alias("pk"), "name")


@query("jn_16_fan_in", "SELECT d.device_id, a.n, b.last FROM (SELECT DISTINCT device_id FROM fx_status) d LEFT JOIN (SELECT device_id, count(*) AS n FROM fx_status WHERE status = 'offline' GROUP BY 1) a USING (device_id) LEFT JOIN (SELECT device_id, max(event_id) AS last FROM fx_status GROUP BY 1) b USING (device_id)")
def jn_16(t):
    s = t.fx_status
    return J.fan_in(s.select("device_id").distinct(), {"offline": s.where("status = 'offline'").groupBy("device_id").agg(F.count(F.lit(1)).alias("n")), "last": s.groupBy("device_id").agg(F.max("event_id").alias("last"))}, ["device_id"])


@query("jn_17_image_pairs", "SELECT a.pk, a._commit_version, a.qty AS before, b.qty AS after FROM fx_feed a JOIN fx_feed b ON a.pk = b.pk AND a._commit_version = b._commit_version WHERE a._change_type = 'update_preimage' AND b._change_type = 'update_postimage' UNION ALL SELECT pk, 0, qty, qty + 1 FROM fx_master")
def jn_17(t):
    pairs = lambda df: J.image_pairs(df, "pk").select("pk", "_commit_version", F.col("before.qty").alias("before"), F.col("after.qty").alias("after"))
    image = lambda kind, qty: t.fx_master.select("pk", qty.alias("qty"), F.lit(0).alias("_commit_version"), F.lit(kind).alias("_change_type"))
    return pairs(t.fx_feed).union(pairs(image("update_preimage", F.col("qty")).union(image("update_postimage", F.col("qty") + 1))))


@query("jn_18_check_metadata", "WITH r AS (SELECT 'is_null_mandatory-school_name' AS check_key, count_if(school_name IS NULL) AS n FROM fx_school UNION ALL SELECT 'other', count(*) FROM fx_school) SELECT r.check_key, r.n, m.type FROM r LEFT JOIN fx_check_meta m USING (check_key)")
def jn_18(t):
    counts = t.fx_school.agg(F.count_if(F.col("school_name").isNull()).alias("a"), F.count(F.lit(1)).alias("b"))
    rows = counts.select(F.explode(F.create_map(F.lit("is_null_mandatory-school_name"), "a", F.lit("other"), "b")).alias("check_key", "n"))
    return J.lookup(rows, t.fx_check_meta, "check_key", ["type"]).select("check_key", "n", "type")


@query("jn_19_master_reference", "SELECT m.pk, coalesce(m.name, i.name) AS name, coalesce(m.level, i.level) AS level, m.qty FROM fx_master m LEFT JOIN fx_incoming i ON m.pk = i.pk")
def jn_19(t):
    return J.enrich(t.fx_master.drop("country_key"), t.fx_incoming, "pk", ["name", "level"])


@query("jn_20_to_update", "SELECT i.pk, CASE WHEN m.pk IS NULL THEN 'new' ELSE 'changed' END AS reason FROM fx_incoming i LEFT JOIN fx_master m ON i.pk = m.pk WHERE m.pk IS NULL OR i.name IS DISTINCT FROM m.name")
def jn_20(t):
    return J.to_update(t.fx_incoming, t.fx_master, "pk", "name").select("pk", "reason")


@query("jn_21_overlay_updates", "SELECT coalesce(m.pk, i.pk) AS pk, coalesce(i.name, m.name) AS name, coalesce(m.qty, i.qty) AS qty, m.level FROM fx_master m FULL JOIN fx_incoming i ON m.pk = i.pk")
def jn_21(t):
    return J.overlay(t.fx_master.drop("country_key"), t.fx_incoming, "pk", ["name", "qty"], stored_wins=["qty"], insert=True)


@query("jn_22_overlay_only", "SELECT m.pk, coalesce(i.name, m.name) AS name, m.qty FROM fx_master m LEFT JOIN fx_incoming i ON m.pk = i.pk")
def jn_22(t):
    return J.overlay(t.fx_master.select("pk", "name", "qty"), t.fx_incoming, "pk", ["name"])


@query("jn_23_duplicate_pairs", "WITH s AS (SELECT row_key, school_name, education_level, floor(latitude * 1000) AS a, floor(longitude * 1000) AS b FROM fx_school WHERE latitude IS NOT NULL AND school_name IS NOT NULL AND education_level IS NOT NULL), g AS (SELECT row_key AS second, min(row_key) OVER w AS first, count(*) OVER w AS size FROM s WINDOW w AS (PARTITION BY school_name, education_level, a, b)) SELECT * FROM g WHERE first < second")
def jn_23(t):
    s = t.fx_school.where("latitude IS NOT NULL").select("row_key", "school_name", "education_level", F.floor(F.col("latitude") * 1000).alias("la"), F.floor(F.col("longitude") * 1000).alias("lo"))
    return J.links_to_first(s, "row_key", ["school_name", "education_level", "la", "lo"]).select("first", F.col("row_key").alias("second"), "size")


@query("win_01_duplicate_flag", "SELECT row_key, CASE WHEN count(school_id_giga) OVER (PARTITION BY school_id_giga) > 1 THEN 1 ELSE 0 END AS a, CASE WHEN count(school_id_govt) OVER (PARTITION BY school_id_govt) > 1 THEN 1 ELSE 0 END AS b FROM fx_school")
def win_01(t):
    from ..operators.checks import duplicate_checks

    made = duplicate_checks(t.fx_school, ["school_id_giga", "school_id_govt"])
    return made.select("row_key", F.col("dq_duplicate-school_id_giga").alias("a"), F.col("dq_duplicate-school_id_govt").alias("b"))


@query("win_07_row_number", "SELECT row_key, row_number() OVER (PARTITION BY school_id_govt ORDER BY row_key) AS row_num FROM fx_school")
def win_07(t):
    return W.numbered(t.fx_school, ["school_id_govt"], [F.col("row_key")]).select("row_key", "row_num")


@query("win_08_last_state", "SELECT device_id, arg_max(status, (ts, event_id)) AS status FROM fx_status WHERE ts < TIMESTAMP '2024-01-15' GROUP BY 1")
def win_08(t):
    return W.last_before(t.fx_status, "device_id", "ts", "status", F.lit("2024-01-15").cast("timestamp_ntz"), "event_id").select("device_id", "status")


@query("win_09_next_state", "SELECT event_id, lead(status) OVER w AS next_status, strftime(lead(ts) OVER w, '%Y-%m-%d %H:%M:%S') AS next_ts FROM fx_status WINDOW w AS (PARTITION BY device_id ORDER BY ts, event_id)")
def win_09(t):
    return W.with_next(t.fx_status, "device_id", "ts", "status", "event_id").select("event_id", "next_status", F.date_format("next_ts", "yyyy-MM-dd HH:mm:ss").alias("next_ts"))


@query("win_10_day_count", "SELECT event_id, count(*) OVER (PARTITION BY device_id, CAST(ts AS DATE)) AS count FROM fx_status")
def win_10(t):
    return W.count_per_key(t.fx_status.withColumn("day", F.to_date("ts")), ["device_id", "day"]).select("event_id", "count")


@query("srt_01_critical_first", f"SELECT pk, dq_has_critical_error, row_number() OVER (ORDER BY dq_has_critical_error DESC, pk) AS place FROM ({CHECKED})")
def srt_01(t):
    # the place is written out so that the order can be compared
    rows = W.ids_first(checked(t), ["pk", "absent"], "dq_has_critical_error").select("pk", "dq_has_critical_error")
    return W.with_place(rows, [F.col("dq_has_critical_error").desc(), F.col("pk")]).withColumn("place", F.col("place").cast("bigint"))


@query("srt_01_all_columns", "SELECT *, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) AS place FROM orders")
def srt_01_all(t):
    return W.with_place(t.orders, [F.col("o_orderdate").desc(), F.col("o_orderkey")])


@query("srt_02_latest_version", "SELECT DISTINCT _commit_version FROM fx_feed ORDER BY 1 DESC LIMIT 1")
def srt_02(t):
    return W.latest(t.fx_feed.select("_commit_version").distinct(), "_commit_version")


@query("srt_03_by_count", "SELECT education_level, count(*) AS n FROM fx_school GROUP BY 1 ORDER BY n DESC")
def srt_03(t):
    return t.fx_school.groupBy("education_level").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"))


@query("srt_05_exists", "SELECT count(*) > 0 AS found FROM fx_school WHERE latitude IS NULL")
def srt_05(t):
    return t.fx_school.where("latitude IS NULL").limit(1).agg((F.count(F.lit(1)) > 0).alias("found"))


@query("srt_06_first_per_key", "SELECT school_id_govt, min(row_key) AS row_key FROM fx_school GROUP BY 1")
def srt_06(t):
    return W.first_per_key(t.fx_school.select("school_id_govt", "row_key").dropDuplicates(), ["school_id_govt"], [F.col("row_key")])


@query("set_01_union", "SELECT pk, name FROM fx_master UNION ALL SELECT pk, name FROM fx_incoming")
def set_01(t):
    return t.fx_master.select("pk", "name").union(t.fx_incoming.select("pk", "name"))


@query("set_02_union_by_name", "SELECT pk, name FROM fx_master UNION ALL SELECT pk, name FROM fx_incoming")
def set_02(t):
    return W.union_by_name([t.fx_master.select("pk", "name"), t.fx_incoming.select("name", "pk")])


@query("set_03_union_all", "SELECT country_key, count(*) AS n FROM (SELECT country_key FROM fx_master UNION ALL SELECT country_key FROM fx_incoming UNION ALL SELECT country_key FROM fx_school) GROUP BY 1")
def set_03(t):
    return W.union_by_name([df.select("country_key") for df in (t.fx_master, t.fx_incoming, t.fx_school)]).groupBy("country_key").agg(F.count(F.lit(1)).alias("n"))
