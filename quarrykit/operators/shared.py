"""Folders that all machines share, and cutting lineage there."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, else a folder of the warehouse; with a local master, which is one machine, a temporary folder that goes when Python ends.
    Where the session has no folder for checkpoints, this becomes it."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isEmpty():
        if re.match(r"local(\[|$)", spark.sparkContext.master):
            own = tempfile.mkdtemp(prefix="spark-")
            atexit.register(shutil.rmtree, own, ignore_errors=True)
        else:
            own = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_written"
        spark.sparkContext.setCheckpointDir(own)
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
    return held.get().rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path for something new."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, folder: str) -> None:
    """Removes a folder that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: later jobs read the files, whichever executors are lost."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
