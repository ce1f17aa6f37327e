"""Queries of merges, change capture and review."""

from pyspark.sql import functions as F

from ..operators import merge as M
from ..operators import schema as S
from ..operators.windows import first_per_key
from ..operators.shared import new_folder
from ..registry import query
from ..sources.versions import DigestedSnapshots

COLS = ["pk", "name", "level", "qty", "country_key"]


def now():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")
ALL = "pk, name, level, qty, country_key"
OVER = "m.pk, coalesce(i.name, m.name) AS name, coalesce(i.level, m.level) AS level, coalesce(i.qty, m.qty) AS qty, coalesce(i.country_key, m.country_key) AS country_key"
NEW = f"SELECT {ALL} FROM fx_incoming WHERE pk NOT IN (SELECT pk FROM fx_master)"


@query("mrg_01_merge_frames", f"SELECT {OVER} FROM fx_master m LEFT JOIN fx_incoming i ON m.pk = i.pk WHERE m.pk % 5 <> 0 UNION ALL {NEW}")
def mrg_01(t):
    return M.merge_frames(t.fx_master, t.fx_incoming.join(t.fx_master, "pk", "left_anti"), t.fx_incoming, t.fx_master.where("pk % 5 = 0"), ["pk"], COLS)


@query("mrg_01_merge_to_null", f"SELECT m.pk, CASE WHEN i.pk IS NOT NULL THEN i.name ELSE m.name END AS name, m.level, CASE WHEN i.pk IS NOT NULL THEN i.qty ELSE m.qty END AS qty, m.country_key FROM fx_master m LEFT JOIN fx_incoming i ON m.pk = i.pk UNION ALL {NEW}")
def mrg_01_null(t):
    return M.merge_frames(t.fx_master, t.fx_incoming.join(t.fx_master, "pk", "left_anti"), t.fx_incoming, t.fx_master.limit(0), ["pk"], COLS, to_null=True)


LAST = "SELECT * FROM fx_feed QUALIFY row_number() OVER (PARTITION BY pk ORDER BY _commit_version DESC, CASE WHEN _change_type = 'update_preimage' THEN 1 ELSE 0 END) = 1"


@query("mrg_02_apply_feed", f"WITH l AS ({LAST}) SELECT pk, name, qty FROM fx_master WHERE pk NOT IN (SELECT pk FROM l WHERE _change_type <> 'update_preimage') UNION ALL SELECT pk, name, qty FROM l WHERE _change_type IN ('insert', 'update_postimage')")
def mrg_02(t):
    return M.apply_feed(t.fx_master, t.fx_feed, ["pk"], ["pk", "name", "qty"])


@query("mrg_03_partial_merge", f"SELECT {OVER} FROM fx_master m LEFT JOIN fx_incoming i ON m.pk = i.pk UNION ALL {NEW}")
def mrg_03(t):
    return M.partial_merge(t.fx_master, t.fx_incoming, ["pk"], COLS)


@query("mrg_04_full_merge", f"SELECT {OVER} FROM fx_master m JOIN fx_incoming i ON m.pk = i.pk UNION ALL {NEW}")
def mrg_04(t):
    return M.full_merge(t.fx_master, t.fx_incoming, ["pk"], COLS)


@query("mrg_05_latest_change", f"SELECT pk, qty, _commit_version, _change_type FROM ({LAST})")
def mrg_05(t):
    return M.latest_change(t.fx_feed, ["pk"]).select("pk", "qty", "_commit_version", "_change_type")


@query("mrg_06_upsert_counts", "SELECT count_if(m.pk IS NOT NULL AND i.pk IS NOT NULL AND (m.name IS DISTINCT FROM i.name OR m.qty IS DISTINCT FROM i.qty)) AS updates, count_if(m.pk IS NULL) AS inserts, count_if(i.pk IS NULL) AS deletes FROM fx_master m FULL JOIN fx_incoming i ON m.pk = i.pk")
def mrg_06(t):
    return M.upsert_counts(t.fx_master, t.fx_incoming, ["pk"], COLS, full=True)


@query("mrg_06_signature_upsert", f"SELECT {ALL} FROM fx_incoming UNION ALL SELECT {ALL} FROM fx_master WHERE pk NOT IN (SELECT pk FROM fx_incoming)")
def mrg_06_upsert(t):
    return M.signature_upsert(t.fx_master, t.fx_incoming, ["pk"], COLS)[0]


@query("mrg_07_delete_keys", f"SELECT {ALL} FROM fx_master WHERE pk NOT IN (SELECT pk FROM fx_incoming WHERE qty % 3 = 0)")
def mrg_07(t):
    return M.delete_keys(t.fx_master, t.fx_incoming.where("qty % 3 = 0"), ["pk"])


@query("mrg_08_upsert_all", f"SELECT {ALL} FROM fx_incoming UNION ALL SELECT {ALL} FROM fx_master WHERE pk NOT IN (SELECT pk FROM fx_incoming)")
def mrg_08(t):
    return M.upsert_all(t.fx_master, t.fx_incoming, ["pk"])


@query("mrg_09_insert_only", f"SELECT {ALL} FROM fx_master UNION ALL {NEW}")
def mrg_09(t):
    return M.insert_only(t.fx_master, t.fx_incoming, ["pk"])


@query("mrg_10_update_where", "SELECT pk, CASE WHEN upload_id = 'up1' AND status = 'PENDING' THEN 'PROCESSED' ELSE status END AS status FROM fx_staged")
def mrg_10(t):
    return M.update_where(t.fx_staged, F.expr("upload_id = 'up1' AND status = 'PENDING'"), {"status": F.lit("PROCESSED")}).select("pk", "status")


@query("mrg_11_delete_cascade", "SELECT 'master' AS source, pk FROM fx_master WHERE pk % 4 <> 0 UNION ALL SELECT 'dependent', pk FROM fx_incoming WHERE pk NOT IN (SELECT pk FROM fx_master WHERE pk % 4 = 0)")
def mrg_11(t):
    master, dependent = M.delete_cascade(t.fx_master, t.fx_incoming, t.fx_master.where("pk % 4 = 0"), ["pk"])
    return master.select(F.lit("master").alias("source"), "pk").union(dependent.select(F.lit("dependent"), "pk"))


@query("mrg_12_update_or_delete", f"SELECT {OVER} FROM fx_master m JOIN fx_incoming i ON m.pk = i.pk")
def mrg_12(t):
    return M.update_or_delete(t.fx_master, t.fx_incoming, ["pk"], COLS)


STAGED = "s AS (SELECT i.pk, coalesce(i.name, m.name) AS name, coalesce(i.qty, m.qty) AS qty, CASE WHEN m.pk IS NULL THEN 'INSERT' WHEN coalesce(i.name, m.name) IS NOT DISTINCT FROM m.name AND coalesce(i.qty, m.qty) IS NOT DISTINCT FROM m.qty THEN 'UNCHANGED' ELSE 'UPDATE' END AS change_type FROM fx_incoming i LEFT JOIN fx_master m ON i.pk = m.pk)"


def staged(t):
    return M.stage_upload(t.fx_incoming, t.fx_master, "pk", ["pk", "name", "qty"], "u1", now())


@query("mrg_13_stage_upload", f"WITH {STAGED} SELECT pk, name, qty, sha256(concat_ws('|', name, CAST(pk AS VARCHAR), CAST(qty AS VARCHAR))) AS signature, change_type, CAST(pk AS VARCHAR) || '|u1|' || change_type AS change_id, CASE WHEN change_type = 'UNCHANGED' THEN 'PROCESSED_UNCHANGED' ELSE 'PENDING' END AS status FROM s")
def mrg_13(t):
    return staged(t).select("pk", "name", "qty", "signature", "change_type", "change_id", "status")


@query("mrg_14_stage_deletes", "SELECT pk, CAST(pk AS VARCHAR) || '|u2|DELETE' AS change_id, 'PENDING' AS status FROM fx_master WHERE pk IN (SELECT pk FROM fx_incoming WHERE pk % 6 = 0)")
def mrg_14(t):
    return M.stage_deletes(t.fx_master, t.fx_incoming.where("pk % 6 = 0"), "pk", "u2", now()).select("pk", "change_id", "status")


@query("mrg_15_apply_approval", f"WITH {STAGED}, c AS (SELECT * FROM s WHERE change_type <> 'UNCHANGED' AND pk % 2 = 0), d AS (SELECT pk FROM fx_master WHERE pk % 9 = 1), r AS (SELECT m.pk, coalesce(c.name, m.name) AS name, coalesce(c.qty, m.qty) AS qty FROM fx_master m LEFT JOIN c ON m.pk = c.pk WHERE m.pk NOT IN (SELECT pk FROM d WHERE pk % 2 = 1) UNION ALL SELECT pk, name, qty FROM c WHERE pk NOT IN (SELECT pk FROM fx_master)) SELECT *, sha256(concat_ws('|', name, CAST(pk AS VARCHAR), CAST(qty AS VARCHAR))) AS signature FROM r")
def mrg_15(t):
    changes = staged(t).unionByName(M.stage_deletes(t.fx_master.select("pk", "name", "qty"), t.fx_master.where("pk % 9 = 1"), "pk", "u2", now()), allowMissingColumns=True)
    approved = changes.where("(change_type IN ('INSERT', 'UPDATE') AND pk % 2 = 0) OR (change_type = 'DELETE' AND pk % 2 = 1)").select("change_id")
    return M.apply_approval(t.fx_master, changes, approved, "pk", ["pk", "name", "qty"])


@query("mrg_16_keep_rejected", "SELECT pk, name, qty, 'REJECTED' AS status FROM fx_master WHERE pk % 11 = 0 AND pk NOT IN (SELECT pk FROM fx_staged WHERE upload_id = 'up3') UNION ALL SELECT s.pk, coalesce(s.name, m.name), s.qty, 'REJECTED' FROM fx_staged s LEFT JOIN (SELECT * FROM fx_master WHERE pk % 11 = 0) m ON s.pk = m.pk WHERE upload_id = 'up3'")
def mrg_16(t):
    return M.keep_rejected(t.fx_master.where("pk % 11 = 0"), t.fx_staged, t.fx_staged.where("upload_id = 'up3'"), "pk", ["pk", "name", "qty"])


@query("mrg_17_publish_master", f"SELECT *, sha256(concat_ws('|', CAST(country_key AS VARCHAR), level, name, CAST(pk AS VARCHAR), CAST(qty AS VARCHAR))) AS signature FROM (SELECT pk, coalesce(name, 'Unknown') AS name, coalesce(level, 'Unknown') AS level, qty, country_key FROM (SELECT {OVER} FROM fx_master m JOIN fx_incoming i ON m.pk = i.pk UNION ALL {NEW}))")
def mrg_17(t):
    return publish(t.fx_master, t.fx_incoming)


def publish(master, silver):
    from ..operators.project import with_signature

    merged = M.full_merge(master, S.conform(silver, COLS), ["pk"], COLS)
    return with_signature(S.fill_required(merged, ["name", "level", "qty"], key="pk"))


@query("mrg_18_review_counts", "SELECT upload_id, change_type, count(*) AS n, count_if(status = 'PENDING') AS pending FROM fx_staged GROUP BY 1, 2")
def mrg_18(t):
    return t.fx_staged.groupBy("upload_id", "change_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "PENDING").alias("pending"))


@query("mrg_19_change_counts", "SELECT count_if(_change_type = 'insert') AS added, count_if(_change_type = 'update_postimage') AS modified, count_if(_change_type = 'delete') AS deleted FROM fx_feed")
def mrg_19(t):
    return M.change_counts(t.fx_feed)


DIFF = "d AS (SELECT m.pk, m.name AS n0, i.name AS n1, m.level AS l0, i.level AS l1, m.qty AS q0, i.qty AS q1, m.country_key AS c0, i.country_key AS c1, i.pk AS ipk, m.pk AS mpk, coalesce(m.pk, i.pk) AS k FROM fx_master m FULL JOIN fx_incoming i ON m.pk = i.pk)"


@query("mrg_20_column_changes", f"WITH {DIFF}, u AS (SELECT 'name' AS column, count_if(mpk IS NOT NULL AND ipk IS NOT NULL AND n0 IS DISTINCT FROM n1) + count_if(mpk IS NULL AND n1 IS NOT NULL) AS changes FROM d UNION ALL SELECT 'qty', count_if(mpk IS NOT NULL AND ipk IS NOT NULL AND q0 IS DISTINCT FROM q1) + count_if(mpk IS NULL AND q1 IS NOT NULL) FROM d UNION ALL SELECT 'level', count_if(mpk IS NOT NULL AND ipk IS NOT NULL AND l0 IS DISTINCT FROM l1) + count_if(mpk IS NULL AND l1 IS NOT NULL) FROM d) SELECT * FROM u WHERE changes > 0")
def mrg_20(t):
    return M.column_change_counts(M.snapshot_diff(t.fx_master, t.fx_incoming, ["pk"]), ["pk"], ["name", "qty", "level"])


FEED = f"WITH {DIFF} SELECT k AS pk, n1 AS name, q1 AS qty, 'insert' AS _change_type, 1 AS _commit_version FROM d WHERE mpk IS NULL UNION ALL SELECT k, n0, q0, 'delete', 1 FROM d WHERE ipk IS NULL UNION ALL SELECT k, unnest([n0, n1]), unnest([q0, q1]), unnest(['update_preimage', 'update_postimage']), 1 FROM d WHERE mpk IS NOT NULL AND ipk IS NOT NULL AND (n0 IS DISTINCT FROM n1 OR q0 IS DISTINCT FROM q1)"


@query("mrg_21_snapshot_diff", FEED)
def mrg_21(t):
    some = ["pk", "name", "qty"]
    return M.snapshot_diff(t.fx_master.select(some), t.fx_incoming.select(some), ["pk"])


@query("mrg_21_digested_diff", FEED)
def mrg_21_digested(t):
    some = ["pk", "name", "qty"]
    versions = DigestedSnapshots(t.spark, new_folder(t.spark, "digested"), ["pk"], buckets=32)
    versions.publish(t.fx_master.select(some))
    versions.publish(t.fx_incoming.select(some))
    return versions.changes(0)


@query("src_07_feed_of_versions", f"""WITH a AS (SELECT pk, qty FROM fx_master), b AS (SELECT pk, CASE WHEN pk % 50 = 1 THEN qty + 1 ELSE qty END AS qty FROM a), c AS (SELECT * FROM b WHERE pk % 70 <> 2)
SELECT a.pk, unnest([a.qty, b.qty]) AS qty, unnest(['update_preimage', 'update_postimage']) AS _change_type, 1 AS _commit_version FROM a JOIN b ON a.pk = b.pk WHERE a.qty <> b.qty UNION ALL SELECT pk, qty, 'delete', 2 FROM b WHERE pk % 70 = 2""")
def src_07_versions(t):
    versions = DigestedSnapshots(t.spark, new_folder(t.spark, "feed"), ["pk"], buckets=64)
    rows = t.fx_master.select("pk", "qty")
    versions.publish(rows)
    versions.publish(rows.withColumn("qty", F.when(F.col("pk") % 50 == 1, F.col("qty") + 1).otherwise(F.col("qty"))))
    versions.publish(versions.read().where("pk % 70 <> 2"))
    return versions.changes(0)


@query("src_07_feed_since", "SELECT pk, _commit_version, _change_type FROM fx_feed WHERE _commit_version >= 2")
def src_07(t):
    return t.fx_feed.where("_commit_version >= 2").select("pk", "_commit_version", "_change_type")


@query("mrg_04_map_columns", """WITH m AS (SELECT pk, name, qty % 5 AS a, qty % 3 AS b FROM fx_master), i AS (SELECT pk, name, CASE WHEN pk % 4 <> 0 THEN qty % 5 END AS a, CASE WHEN pk % 4 <> 0 THEN qty % 3 END AS b FROM fx_incoming)
SELECT i.pk, coalesce(i.name, m.name) AS name, CASE WHEN i.pk % 4 <> 0 THEN i.a ELSE m.a END AS a, CASE WHEN i.pk % 4 <> 0 THEN i.b ELSE m.b END AS b FROM i LEFT JOIN m ON i.pk = m.pk""")
def mrg_04_maps(t):
    checks = F.create_map(F.lit("a"), F.col("qty") % 5, F.lit("b"), F.col("qty") % 3)
    master = t.fx_master.select("pk", "name", checks.alias("dq_results"))
    incoming = t.fx_incoming.select("pk", "name", F.when(F.col("pk") % 4 != 0, checks).alias("dq_results"))
    merged = M.full_merge(master, incoming, ["pk"], ["pk", "name", "dq_results"])
    return merged.select("pk", "name", F.col("dq_results")["a"].alias("a"), F.col("dq_results")["b"].alias("b"))


@query("mrg_15_map_columns", """WITH s AS (SELECT pk, name, qty % 2 = 0 AS even, qty % 7 AS k FROM fx_master) SELECT pk, CASE WHEN pk % 5 = 0 THEN 'new' ELSE name END AS name, CASE WHEN pk % 5 = 0 THEN 1 ELSE CAST(even AS INT) END AS even, k FROM s WHERE pk % 8 <> 4 OR pk % 5 = 0""")
def mrg_15_maps(t):
    silver = t.fx_master.select("pk", "name", F.create_map(F.lit("even"), (F.col("qty") % 2 == 0).cast("int"), F.lit("k"), F.col("qty") % 7).alias("dq_results"))
    update = silver.where("pk % 5 = 0").select("pk", F.lit("new").alias("name"), F.create_map(F.lit("even"), F.lit(1), F.lit("k"), F.col("dq_results")["k"]).alias("dq_results"), F.lit("UPDATE").alias("change_type"), F.concat(F.lit("u"), "pk").alias("change_id"))
    delete = silver.where("pk % 8 = 4 AND pk % 5 <> 0").select("*", F.lit("DELETE").alias("change_type"), F.concat(F.lit("d"), "pk").alias("change_id"))
    changes = update.unionByName(delete)
    after = M.apply_approval(silver, changes, changes.select("change_id"), "pk", ["pk", "name", "dq_results"])
    return after.select("pk", "name", F.col("dq_results")["even"].alias("even"), F.col("dq_results")["k"].alias("k"))


@query("mrg_22_outbox", "SELECT pk, pk % 3 = 0 OR pk IN (SELECT pk FROM fx_incoming WHERE pk % 3 <> 0 AND qty % 2 = 0) AS is_pushed FROM fx_incoming")
def mrg_22(t):
    rows = t.fx_incoming.withColumn("is_pushed", F.expr("pk % 3 = 0"))
    return M.mark_pushed(rows, M.unpushed(rows).where("qty % 2 = 0"), "pk").select("pk", "is_pushed")


@query("sch_03_registry_upsert", "SELECT name, data_type, id FROM fx_registry WHERE id % 4 <> 0 UNION ALL SELECT name, 'string', id FROM fx_registry WHERE id % 4 = 0 AND id % 3 = 0 UNION ALL SELECT name, data_type, id FROM fx_registry WHERE id % 4 = 0 AND id % 3 <> 0")
def sch_03(t):
    new = t.fx_registry.where("id % 4 = 0 AND id % 3 = 0").withColumn("data_type", F.lit("string"))
    return M.upsert_all(t.fx_registry, new, ["name"]).select("name", "data_type", "id")


@query("snk_05_upsert_evolved", f"SELECT {ALL}, CAST(NULL AS VARCHAR) AS note FROM fx_incoming UNION ALL SELECT {ALL}, NULL FROM fx_master WHERE pk NOT IN (SELECT pk FROM fx_incoming)")
def snk_05(t):
    fields = [("note", "string")]
    return M.signature_upsert(S.add_missing_columns(t.fx_master, fields), S.add_missing_columns(t.fx_incoming, fields), ["pk"], [*COLS, "note"])[0]


@query("pipe_15_master_counts", "SELECT count_if(mpk IS NULL) AS added, count_if(mpk IS NOT NULL AND ipk IS NOT NULL AND (n0 IS DISTINCT FROM n1 OR q0 IS DISTINCT FROM q1 OR l0 IS DISTINCT FROM l1 OR c0 IS DISTINCT FROM c1)) AS modified, count_if(ipk IS NULL) AS deleted FROM d".join([f"WITH {DIFF} ", ""]))
def pipe_15(t):
    return M.change_counts(M.snapshot_diff(t.fx_master, first_per_key(t.fx_incoming, ["pk"], [F.col("pk")]), ["pk"]))
