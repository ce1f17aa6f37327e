"""Queries of sources and sinks: what is written is read back. Every run writes to a folder of its own."""

from pyspark.sql import functions as F

from ..operators import schema as S
from ..operators.shared import cut
from ..registry import query
from ..sources import readers as D
from ..sources import sinks as K
from ..sources import versions as V
from ..streaming.ingest import upsert_touched

TEXTS = 'SELECT CAST(row_key AS VARCHAR) AS row_key, school_name || \' "x", y\' AS school_name, CAST(num_computers AS VARCHAR) AS num_computers FROM fx_school'


def texts(t):
    return t.fx_school.select("row_key", F.concat("school_name", F.lit(' "x", y')).alias("school_name"), "num_computers")


@query("src_01_read_csv", TEXTS)
def src_01(t):
    K.overwrite(texts(t), path := K.new_folder(t.spark, "csv"), "csv")
    return D.read_csv(t.spark, path)


@query("src_03_load_upload", "SELECT pk, name, CAST(qty AS DOUBLE) AS qty, 'json' AS kind FROM fx_master UNION ALL SELECT pk, name, qty, 'parquet' FROM fx_master UNION ALL SELECT pk, name, qty, 'csv' FROM fx_master")
def src_03(t):
    rows, folder, types = t.fx_master.select("pk", "name", "qty"), K.new_folder(t.spark, "upload"), {"pk": "bigint", "qty": "double"}
    K.overwrite(rows, f"{folder}/a.parquet")
    K.overwrite(rows, f"{folder}/a.csv", "csv")
    K.overwrite(rows, f"{folder}/a.json", "json")
    loaded = [D.load_upload(t.spark, f"{folder}/a.{kind}", types, multi_line=False).select("pk", "name", "qty", F.lit(kind).alias("kind")) for kind in ("json", "parquet", "csv")]
    return loaded[0].union(loaded[1]).union(loaded[2])


@query("src_05_best_effort", "SELECT pk, name FROM fx_master")
def src_05(t):
    K.overwrite(t.fx_master.select("pk", "name"), path := K.new_folder(t.spark, "there"))
    return D.best_effort(t.spark, path, "parquet", "pk BIGINT, name STRING").union(D.best_effort(t.spark, f"{path}-not", "parquet", "pk BIGINT, name STRING"))


@query("src_08_restored", "SELECT pk, name, qty, 2 AS version FROM fx_master")
def src_08(t):
    versions = K.Snapshots(t.spark, K.new_folder(t.spark, "versions"))
    versions.publish(t.fx_master.select("pk", "name", "qty"))
    versions.publish(t.fx_incoming.select("pk", "name", "qty"))
    latest = versions.restore(0)
    return versions.read().withColumn("version", F.lit(latest))


@query("src_05_corrupt_file", "SELECT pk, name FROM fx_master")
def src_05_corrupt(t):
    folder = K.new_folder(t.spark, "broken")
    K.overwrite(t.fx_master.select("pk", "name"), folder)
    # beside the good files one that has the name of a Parquet file and text in it
    t.fx_master.select(F.concat(F.lit("PAR1 "), "name").alias("value")).coalesce(1).write.text(f"{folder}-text")
    path = t.spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(t.spark._jsc.hadoopConfiguration())
    part = next(f.getPath() for f in files.listStatus(path(f"{folder}-text")) if f.getPath().getName().startswith("part-"))
    files.rename(part, path(f"{folder}/part-99999-broken.snappy.parquet"))
    return D.best_effort(t.spark, folder, "parquet", "pk BIGINT, name STRING")


@query("snk_01_overwrite", "SELECT pk, name, CAST(NULL AS VARCHAR) AS nothing FROM fx_incoming")
def snk_01(t):
    path = K.new_folder(t.spark, "table")
    K.overwrite(t.fx_master, path)
    K.overwrite(t.fx_incoming.select("pk", "name", F.lit(None).alias("nothing")), path)
    return D.read_parquet(t.spark, path)


@query("snk_02_single_file", "SELECT CAST(pk AS VARCHAR) AS pk, name, 1 AS files FROM fx_master")
def snk_02(t):
    K.single_file(t.fx_master.select("pk", "name").repartition(4), path := K.new_folder(t.spark, "one"))
    rows = D.read_csv(t.spark, path)
    return rows.withColumn("files", F.lit(rows.select(F.input_file_name()).distinct().count()))


@query("snk_03_append_merging", "SELECT pk, name, NULL::INT AS qty FROM fx_master UNION ALL SELECT pk, name, qty FROM fx_incoming")
def snk_03(t):
    path = K.new_folder(t.spark, "grown")
    K.append_merging(t.fx_master.select("pk", "name"), path)
    K.append_merging(t.fx_incoming.select("pk", "name", "qty"), path)
    return K.read_merged(t.spark, path)


@query("snk_04_create_table", "SELECT n_nationkey, n_name, n_regionkey, true AS made, false AS again FROM nation")
def snk_04(t):
    rows, name = t.nation.select("n_nationkey", "n_name", "n_regionkey"), "quarrykit_" + K.new_folder(t.spark, "t").rsplit("-", 1)[1]
    made = K.create_table(t.spark, name, rows, ["n_regionkey"])
    again = K.create_table(t.spark, name, rows, ["n_regionkey"], if_not_exists=True)
    rows.write.mode("append").partitionBy("n_regionkey").format("parquet").saveAsTable(name)
    found = cut(D.read_table(t.spark, name).withColumns({"made": F.lit(made), "again": F.lit(again)}))
    t.spark.sql(f"DROP TABLE {name}")
    return found


@query("snk_06_new_schema", "SELECT CAST(pk AS VARCHAR) AS pk, qty * 2 AS double_qty FROM fx_incoming")
def snk_06(t):
    path = K.new_folder(t.spark, "table")
    K.overwrite(t.fx_master, path)
    K.overwrite(t.fx_incoming.select(F.col("pk").cast("string").alias("pk"), (F.col("qty") * 2).alias("double_qty")), path)
    return D.read_parquet(t.spark, path)


@query("snk_07_truncate", "SELECT count(*) AS before, 0 AS after, true AS first, false AS second FROM fx_master")
def snk_07(t):
    path = K.new_folder(t.spark, "table")
    first = K.overwrite_or_truncate(t.fx_master, path)
    before = D.read_parquet(t.spark, path).agg(F.count(F.lit(1)).alias("before"))
    K.overwrite_or_truncate(t.fx_master, held := K.new_folder(t.spark, "held"))
    second = K.overwrite_or_truncate(t.fx_master.where("pk < 0"), path)
    before = D.read_parquet(t.spark, held).agg(F.count(F.lit(1)).alias("before"))
    return before.select("before", F.lit(D.read_parquet(t.spark, path).count()).alias("after"), F.lit(first).alias("first"), F.lit(second).alias("second"))


@query("snk_08_replace_by_key", "SELECT pk, upload_id, 'old' AS source FROM fx_staged WHERE upload_id <> 'up3' UNION ALL SELECT pk, 'up3', 'new' FROM fx_master WHERE pk % 2 = 0")
def snk_08(t):
    path = K.new_folder(t.spark, "errors")
    K.replace_partitions(t.fx_staged.select("pk", F.lit("old").alias("source"), "upload_id"), path, ["upload_id"])
    K.replace_partitions(t.fx_master.where("pk % 2 = 0").select("pk", F.lit("new").alias("source"), F.lit("up3").alias("upload_id")), path, ["upload_id"])
    return D.read_parquet(t.spark, path)


@query("snk_10_summary_json", "SELECT n_regionkey AS region, count(*) AS nations FROM nation GROUP BY 1")
def snk_10(t):
    K.summary_json(t.nation.groupBy(F.col("n_regionkey").alias("region")).agg(F.count(F.lit(1)).alias("nations")), path := K.new_folder(t.spark, "summary"))
    return t.spark.read.schema("region BIGINT, nations BIGINT").json(path)


@query("snk_11_compact", "SELECT l_orderkey, l_linenumber, true AS narrow FROM lineitem")
def snk_11(t):
    folder = K.new_folder(t.spark, "lines")
    K.overwrite(t.lineitem.select("l_orderkey", "l_linenumber").repartition(5), f"{folder}/a")
    K.compact(t.spark, f"{folder}/a", f"{folder}/b", "l_orderkey", 4)
    rows = D.read_parquet(t.spark, f"{folder}/b")
    ranges = rows.groupBy(F.input_file_name().alias("f")).agg(F.min("l_orderkey").alias("low"), F.max("l_orderkey").alias("high")).orderBy("low").collect()  # a row a file
    return rows.withColumn("narrow", F.lit(all(a["high"] <= b["low"] for a, b in zip(ranges, ranges[1:], strict=False))))


@query("snk_11_compact_tables", "SELECT l_orderkey, l_partkey, l_suppkey, true AS fewer_files FROM lineitem UNION ALL SELECT o_orderkey, o_custkey, -1, true FROM orders")
def snk_11_tables(t):
    folder = K.new_folder(t.spark, "tables")
    lines, orders, empty = (f"{folder}/{n}" for n in ("lines", "orders", "empty"))
    K.Snapshots(t.spark, lines).publish(t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey").repartition(12, "l_orderkey"))
    K.Snapshots(t.spark, orders).publish(t.orders.select("o_orderkey", "o_custkey").repartition(6, "o_orderkey"))
    V.compact_tables(t.spark, [lines, orders, empty], ["l_partkey", "l_suppkey", "o_custkey"], file_bytes=V.bytes_of(t.spark, lines) // 12)

    def read(path, version, some):
        """Files with ranges of the keys that hold what a filter asks for."""
        ranges = K.Snapshots(t.spark, path).read(version).groupBy(F.input_file_name()).agg(*(f(k).alias(f"{f.__name__}_{k}") for k in some for f in (F.min, F.max)))
        return ranges.where(" AND ".join(f"{v} BETWEEN min_{k} AND max_{k}" for k, v in some.items())).count()

    fewer = all(read(p, 1, some) < read(p, 0, some) for p, some in ((lines, {"l_partkey": 40, "l_suppkey": 3}), (orders, {"o_custkey": 50})))
    a, b = K.Snapshots(t.spark, lines).read(), K.Snapshots(t.spark, orders).read()
    return a.unionByName(b.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("l_partkey"), F.lit(-1).cast("bigint").alias("l_suppkey"))).withColumn("fewer_files", F.lit(fewer))


@query("snk_12_split_by", "SELECT pk, name, country_key FROM fx_master")
def snk_12(t):
    K.split_by(t.fx_master.select("pk", "name", "country_key"), path := K.new_folder(t.spark, "split"), "country_key")
    return D.read_parquet(t.spark, path)


@query("sch_05_table_names", "SELECT n_name, 'school_silver.' || lower(n_name) AS silver, 'school.' || lower(n_name) AS gold FROM nation")
def sch_05(t):
    return t.nation.select("n_name", S.table_name_of("school", F.col("n_name"), "silver").alias("silver"), S.table_name_of("school", F.col("n_name"), "gold").alias("gold"))


@query("stm_10_touched_partitions", "SELECT o_orderkey, CASE WHEN o_orderdate >= DATE '1997-01-01' AND o_orderkey % 3 = 0 THEN 'new' ELSE o_orderstatus END AS status, strftime(o_orderdate, '%Y') AS year FROM orders")
def stm_10(t):
    rows = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("status"), F.date_format("o_orderdate", "yyyy").alias("year"))
    path = K.new_folder(t.spark, "touched")
    upsert_touched(t.spark, rows, path, ["o_orderkey"], "year")
    upsert_touched(t.spark, rows.where("year >= '1997' AND o_orderkey % 3 = 0").withColumn("status", F.lit("new")), path, ["o_orderkey"], "year")
    return t.spark.read.schema("o_orderkey BIGINT, status STRING, year STRING").parquet(path)
