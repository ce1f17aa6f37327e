"""Incremental ingest: new files, dedupe within a watermark, appends with provenance, upserts of touched partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import upsert_all
from ..operators.project import col
from ..operators.schema import widen
from ..operators.shared import new_folder, remove
from ..sources.sinks import replace_partitions


def new_files(spark: SparkSession, path: str, schema: str, kind: str = "parquet", files_at_once: int = 100) -> DataFrame:
    """A stream of files not yet seen: the checkpoint is the cursor, oldest files first."""
    return spark.readStream.format(kind).schema(schema).option("maxFilesPerTrigger", files_at_once).option("latestFirst", False).load(path)


def files_after(listing: DataFrame, mtime: int | None, name: str | None) -> DataFrame:
    """Batch form: files of a listing (mtime, name) strictly after a cursor, in order."""
    rows = listing if mtime is None else listing.where((F.col("mtime") > mtime) | ((F.col("mtime") == mtime) & (F.col("name") > (name or ""))))
    return rows.orderBy("mtime", "name")


def dedupe(events: DataFrame, keys: Sequence[str], time: str, late: str = "2 hours") -> DataFrame:
    """One event a key within the time that late ones are waited for."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))


def append_pings(stream: DataFrame, path: str, checkpoint: str, run: str) -> StreamingQuery:
    """Appends batches with provenance, each a partition of its own: a batch that is run again replaces itself."""

    def put(batch: DataFrame, number: int) -> None:
        rows = widen(batch).withColumns({"ingestion_run_id": F.lit(f"{run}-{number}"), "ingested_at": F.current_timestamp()})
        replace_partitions(rows, path, ["ingestion_run_id"])

    return stream.withColumn("source_file", F.col("_metadata.file_name")).writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_touched(spark: SparkSession, batch: DataFrame, path: str, keys: Sequence[str], date: str = "date") -> None:
    """Upserts into a table partitioned by date: only the dates that come in are read and written.

    New partitions are written to a folder of their own first, since they are made of what they replace."""
    dates = [r[0] for r in batch.select(date).distinct().collect()]  # of one batch: some days
    stored = spark.read.parquet(path).where(col(date).isin(dates)) if _there(spark, path) else batch.limit(0)
    side = new_folder(spark, "touched")
    upsert_all(stored.select(batch.columns), batch, keys).write.parquet(side)
    replace_partitions(spark.read.parquet(side), path, [date])
    remove(spark, side)


def _there(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def upsert_stream(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], date: str = "date") -> StreamingQuery:
    return stream.writeStream.foreachBatch(lambda batch, _: upsert_touched(batch.sparkSession, batch, path, keys, date)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
