"""What the operators share: cutting lineage on shared storage, and Arrow batches as Python values."""

from __future__ import annotations

import atexit
import ctypes
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows, and bytes of texts, that a Python operator holds at once; a batch from Spark is handed on in such slices.
ROWS_AT_ONCE, BYTES_AT_ONCE = 512, 32 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where it names none, a folder of the warehouse, which is shared too;
    with a local master, where driver and tasks are one machine, a temporary one that goes when Python ends."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isEmpty():
        if re.match(r"local(\[|$)", spark.sparkContext.master):
            own = tempfile.mkdtemp(prefix="spark-")
            atexit.register(shutil.rmtree, own, ignore_errors=True)
        else:
            own = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
        spark.sparkContext.setCheckpointDir(own)
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
    return held.get().rstrip("/")


def remove(spark: SparkSession, folder: str) -> None:
    """Removes a folder of new_folder that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: later jobs read the files, whichever executors are lost."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def column_type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def free(df: DataFrame, name: str) -> str:
    """The name, made longer until df has no such column, whatever the case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def sampled(df: DataFrame, key: str, text: str, rows: int) -> DataFrame:
    """About `rows` rows of df, at most twice as many, picked by a hash of key and beginning of the text: the same ones in every run.

    Each task picks its own share, so what is gathered doesn't grow with the table or its partitions."""
    n = df.count()
    chance = F.pmod(F.xxhash64(key, F.substring(text, 1, 64)), F.lit(1 << 30)) / float(1 << 30)
    return (df.where(chance < rows / n) if n > rows else df).limit(2 * rows)


def settle() -> None:
    """Gives freed memory back to the system. A Python worker stays for later tasks of its executor, and with it would stay what it once needed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_ONCE, most: int = BYTES_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Each batch in slices of so many rows and so many bytes of texts at most, one row at least; settles behind the last."""
    for batch in batches:
        size = np.zeros(batch.num_rows, np.int64)
        for c in batch.columns:
            if pa.types.is_string(c.type) or pa.types.is_large_string(c.type) or pa.types.is_binary(c.type) or pa.types.is_large_binary(c.type):
                size += pc.binary_length(c).fill_null(0).to_numpy(zero_copy_only=False)
        total, at = np.cumsum(size), 0
        while at < batch.num_rows:
            held = most + (int(total[at - 1]) if at else 0)
            end = max(at + 1, min(at + rows, int(np.searchsorted(total, held, "right"))))
            yield batch.slice(at, end - at)
            at = end
    batch = None
    settle()


def texts_of(column: pa.Array) -> list[str | None]:
    """The texts as Python has them. A string column may hold any bytes: those that aren't UTF-8 are read as U+FFFD."""
    try:
        return column.to_pylist()
    except UnicodeDecodeError:
        return [None if b is None else b.decode("utf-8", "replace") for b in column.cast(pa.binary()).to_pylist()]


def without(columns: list[str], made: list[str]) -> list[str]:
    """The columns whose names are none of those made, whatever the case of letters: as withColumn has it, a made column takes the place of one."""
    taken = {m.lower() for m in made}
    return [c for c in columns if c.lower() not in taken]


def per_text(df: DataFrame, keep: list[str], text: str, fields: str, work: Callable[[list], list], as_bytes: bool = False) -> DataFrame:
    """Columns `keep` and the columns `fields` that `work` makes of a list of texts, one list for each field.

    Rows stay where they are: no shuffle, and ROWS_AT_ONCE texts of BYTES_AT_ONCE bytes in memory, or one text. A kept column with the name of a field is left out."""
    names = [x.split()[0] for x in fields.split(", ")]
    keep = without(keep, names)
    schema = ", ".join([*(f"`{c}` {column_type(df, c)}" for c in keep), fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(len(keep))
            made = work(texts.cast(pa.binary()).to_pylist() if as_bytes else texts_of(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *(x if isinstance(x, pa.Array) else pa.array(x) for x in made)], names=[*keep, *names])

    return df.select(*(df[c] for c in keep), df[text]).mapInArrow(run, schema)
