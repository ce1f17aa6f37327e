"""Readers, sinks, snapshots and incremental ingest."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from quarrykit.operators import merge as M
from quarrykit.sources import readers as D
from quarrykit.sources import sinks as K
from quarrykit.streaming import ingest


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_csv_keeps_zeros_quotes_and_line_ends(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name\n007,"say ""hi""\nthere"\n010,\n')
    assert rows(D.read_csv(spark, str(tmp_path / "a.csv"), multi_line=True)) == [("007", 'say "hi"\nthere'), ("010", None)]
    assert rows(D.load_upload(spark, str(tmp_path / "a.csv"), {"id": "int"})) == [(7, 'say "hi"\nthere'), (10, None)]
    (tmp_path / "b.csv").write_bytes("id,name\n1,Ñandú\n".encode("iso-8859-1"))
    assert rows(D.load_upload(spark, str(tmp_path / "b.csv"), encoding="ISO-8859-1")) == [("1", "Ñandú")]


def test_load_by_extension(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "a.parquet"))
    assert D.load_upload(spark, str(tmp_path / "a.parquet")).count() == 3
    (tmp_path / "a.json").write_text(json.dumps([{"a": 1}, {"a": 2}]))
    assert rows(D.load_upload(spark, str(tmp_path / "a.json"))) == [(1,), (2,)]
    with pytest.raises(ValueError, match="no reader"):
        D.load_upload(spark, "x.xls")


def test_best_effort(spark, tmp_path):
    assert D.best_effort(spark, str(tmp_path / "none"), "parquet", "a int").count() == 0
    spark.range(2).selectExpr("CAST(id AS INT) AS a").coalesce(1).write.parquet(str(tmp_path / "p"))
    (tmp_path / "p" / "broken.parquet").write_bytes(b"PAR1 no")
    assert D.best_effort(spark, str(tmp_path / "p"), "parquet", "a int").count() == 2


def test_upload_names(spark):
    names = spark.createDataFrame([("up/ab12_BRA_school-geolocation_gov_20240102-030405.csv",), ("x_KEN_qos_20240102-030405.csv",), ("other",)], "n string")
    got = names.select(*(c.alias(k) for k, c in D.upload_parts("n").items())).collect()
    at = datetime.datetime(2024, 1, 2, 3, 4, 5)
    assert [tuple(r) for r in got] == [("ab12", "BRA", "school-geolocation", "gov", at), ("x", "KEN", "qos", None, at), (None,) * 5]


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "id int, part string")
    name = "quarry_made"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert K.create_table(spark, name, df, ["part"])
    assert not K.create_table(spark, name, df, if_not_exists=True)
    assert K.create_table(spark, name, df, replace=True)
    assert D.read_table(spark, name).count() == 0
    with pytest.raises(ValueError, match="both"):
        K.create_table(spark, name, df, if_not_exists=True, replace=True)
    spark.sql(f"DROP TABLE {name}")


def test_file_sinks(spark, tmp_path):
    p = lambda n: str(tmp_path / n)
    df = spark.range(10).select("id", F.lit(None).alias("nothing"), (F.col("id") % 2).alias("k"))
    K.overwrite(df, p("o"))
    assert dict(spark.read.parquet(p("o")).dtypes)["nothing"] == "string"
    K.single_file(df.drop("nothing"), p("s"))
    assert len(list((tmp_path / "s").glob("part-*"))) == 1
    K.append_merging(df.select("id"), p("m"))
    K.append_merging(df.select("id", F.lit("x").alias("new")), p("m"))
    assert sorted(K.read_merged(spark, p("m")).columns) == ["id", "new"] and K.read_merged(spark, p("m")).count() == 20
    assert K.overwrite_or_truncate(df, p("t")) and not K.overwrite_or_truncate(df.limit(0), p("t"))
    assert spark.read.parquet(p("t")).count() == 0
    K.split_by(df.select("id", "k"), p("b"), "k")
    assert sorted(x.name for x in (tmp_path / "b").glob("k=*")) == ["k=0", "k=1"]
    K.replace_partitions(spark.createDataFrame([(99, 1)], "id bigint, k bigint"), p("b"), ["k"])
    assert spark.read.parquet(p("b")).where("k = 1").count() == 1 and spark.read.parquet(p("b")).where("k = 0").count() == 5
    K.summary_json(df.select("id").limit(1), p("j"))
    assert [json.loads(r.value) for r in spark.read.text(p("j")).collect()] == [{"id": 0}]
    K.compact(spark, p("o"), p("c"), "id", 2)
    assert spark.read.parquet(p("c")).count() == 10
    assert K.error_rows(df.select("id"), "u", "f.csv", "d", "BRA", F.current_timestamp()).columns == ["id", "upload_id", "file_name", "dataset", "country_code", "created_at"]


def test_compacted_files_have_bounded_rows(spark, tmp_path):
    """A larger table is written in more files, not in larger ones, since a task sorts a file."""
    K.overwrite(spark.range(1000).repartition(3), str(tmp_path / "a"))
    K.compact(spark, str(tmp_path / "a"), str(tmp_path / "b"), "id", 4, rows=100)
    files = spark.read.parquet(str(tmp_path / "b")).groupBy(F.input_file_name()).agg(F.count("id").alias("n"), F.min("id").alias("low"), F.max("id").alias("high")).orderBy("low").collect()
    assert len(files) == 10 and sum(f.n for f in files) == 1000 and max(f.n for f in files) < 200
    assert all(a.high < b.low for a, b in zip(files, files[1:], strict=False))


def test_snapshots(spark, tmp_path):
    store = K.Snapshots(spark, str(tmp_path / "snap"))
    assert store.latest() is None
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "z"), (4, "n")], "id int, v string")
    assert [store.publish(a), store.publish(b)] == [0, 1]
    got = {(r.id, r.v, r._change_type) for r in store.changes(0, ["id"]).collect()}
    assert got == {(2, "y", "update_preimage"), (2, "z", "update_postimage"), (3, None, "delete"), (4, "n", "insert")}
    assert store.restore(0) == 2 and rows(store.read()) == rows(a) and rows(store.read(1)) == rows(b)
    assert rows(M.apply_feed(a, store.changes(0, ["id"]).where("_commit_version = 1"), ["id"], ["id", "v"])) == rows(b)


def test_new_files_and_pings(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))

    def run():
        ingest.append_pings(ingest.new_files(spark, src, "id int, latency double"), out, mark, "r").awaitTermination()
        return K.read_merged(spark, out)

    spark.createDataFrame([(1, 0.5)], "id int, latency double").write.parquet(f"{src}/a")
    src = f"{src}/*"
    assert run().count() == 1
    spark.createDataFrame([(2, 0.5), (3, None)], "id int, latency double").write.parquet(f"{tmp_path}/in/b")
    got = run()
    assert sorted(r.id for r in got.collect()) == [1, 2, 3] and run().count() == 3
    assert {"source_file", "ingestion_run_id", "ingested_at"} <= set(got.columns) and dict(got.dtypes)["id"] == "bigint"


def test_files_after(spark):
    listing = spark.createDataFrame([(5, "a"), (5, "b"), (6, "a"), (4, "z")], "mtime bigint, name string")
    assert rows(ingest.files_after(listing, 5, "a"), "mtime", "name") == [(5, "b"), (6, "a")]
    assert ingest.files_after(listing, None, None).count() == 4


def test_upsert_touched(spark, tmp_path):
    path = str(tmp_path / "t")
    row = "id int, v string, date string"
    ingest.upsert_touched(spark, spark.createDataFrame([(1, "a", "d1"), (2, "b", "d2")], row), path, ["id"])
    ingest.upsert_touched(spark, spark.createDataFrame([(2, "c", "d2"), (3, "n", "d2")], row), path, ["id"])
    assert sorted((r.id, r.v) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "c"), (3, "n")]


def test_stream_dedupe_equals_batch(spark, tmp_path):
    src = str(tmp_path / "s")
    spark.createDataFrame([(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:10:00"), (1, "2024-01-01 00:20:00")], "id int, at string").select("id", F.col("at").cast("timestamp").alias("at")).write.parquet(src)
    stream = ingest.dedupe(ingest.new_files(spark, src, "id int, at timestamp"), ["id"], "at")
    q = stream.writeStream.format("memory").queryName("deduped").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.id for r in spark.table("deduped").collect()) == [1, 2]
