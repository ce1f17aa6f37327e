"""Token counts by a separator scan over flat token files.

A flat file is nothing but ids of one fixed width (a numpy type: big-endian unsigned 16-bit integers unless told otherwise), each document
followed by the id of the end; no index, no document ids. Files, in order of their numbers (part-<number>...-c<number>) or else of their names, are the
blocks of one stream, and a document may run on from one to the next. Each block is searched for the end's id by vectorised comparison, SCAN ids at a time.

A prefix scan over one summary row a block (documents ended, ids, place after the last end) then gives each block's first document and where
it began, and the rows of all blocks are stitched by it. The scan has two levels: within ranges of as many blocks as there are ranges, and over one row a range.

Blocks are written by their size and end wherever they fall, in the middle of a document as a rule. So a block, which one task reads whole, has about BLOCK
ids whatever the texts are like; only a text in which no id has the end's last byte makes a longer one, of its own length.

Defined results: an empty document counts 0; ids after the last end are a document that isn't `ended`; no files, or empty
ones, give no rows; a file that doesn't hold a whole number of ids raises. Written files have documents in the order that the table's
partitions have them; a null text is an empty document; bytes that aren't UTF-8 are read as U+FFFD; repeated rows are documents each; columns other than the text are not read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, documents, new_folder, slices, texts_of
from .units import plain_byte_units

#: Ids compared at once, and ids of a file that is written (a file is a task's block when it is read).
SCAN, BLOCK = 1 << 20, 1 << 21
KIND = ">u2"


def write_flat(df: DataFrame, folder: str, path: str, end: int, text_col: str = "text", kind: str = KIND, block: int = BLOCK) -> None:
    """The documents as flat files of about `block` ids each, without a shuffle. The end's id must be none that a text can give; a text's special strings are
    ordinary text here.

    Spark's text writer puts the bytes of a row as they are and its line separator after them. The separator is the last byte of the end, which must be
    under 128; a row is a file, all bytes of a block but the last: so a block ends behind any id with that last byte."""
    mark, width = np.array([end], kind).tobytes(), np.dtype(kind).itemsize
    if mark[-1] > 127:
        raise ValueError(f"the last byte of {end} as {kind} is no character")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0
        body = lambda data: pa.RecordBatch.from_arrays([pa.array([data[:-1]], pa.binary())], names=["body"])
        for batch in slices(batches):
            ids, ends = plain_byte_units(path).ids(texts_of(batch.column(0)))
            data = np.insert(ids, ends, end).astype(kind).tobytes()
            at = 0
            while size + len(data) - at >= width * block:
                first = max(0, width * block - size - width) + at  # the first id that may be a block's last one
                may = np.flatnonzero(np.frombuffer(data, np.uint8)[first + width - 1 :: width] == mark[-1])
                if not len(may):
                    break
                cut_at = first + width * (int(may[0]) + 1)
                yield body(b"".join([*held, data[at:cut_at]]))
                held, size, at = [], 0, cut_at
            held.append(data[at:])
            size += len(data) - at
        if size:
            yield body(b"".join(held))

    rows = df.select(df[text_col]).mapInArrow(run, "body binary")
    rows.select(F.col("body").cast("string").alias("value")).write.option("lineSep", chr(mark[-1])).option("maxRecordsPerFile", 1).text(folder)


def _ends(content: bytes, end: int, kind: str) -> tuple[np.ndarray, int]:
    """Places of the end's id and the number of ids."""
    if len(content) % np.dtype(kind).itemsize:
        raise ValueError("not a whole number of ids")
    ids = np.frombuffer(content, kind)
    found = [at + np.flatnonzero(ids[at : at + SCAN] == end) for at in range(0, len(ids), SCAN)]
    return np.concatenate([*found, np.empty(0, np.int64)]).astype(np.int64), len(ids)


def _placed(blocks: DataFrame) -> DataFrame:
    """base, first and open of each block: ids, documents and the place after the last end before it."""
    order = [F.nullif(F.regexp_extract("block", pattern, 1), F.lit("")).cast("bigint").alias(n) for pattern, n in ((r"part-(\d+)[^/]*$", "_part"), (r"-c(\d+)(?:\.[^/]*)?$", "_file"))]
    summary = blocks.select("block", *order, "n", F.size("ends").cast("bigint").alias("docs"), F.when(F.size("ends") > 0, F.element_at("ends", -1) + 1).alias("last"))
    by = ["_part", "_file", "block"]
    ranges = max(1, int(blocks.count() ** 0.5))
    dealt = cut(summary.repartitionByRange(ranges, *by).withColumn("_range", F.spark_partition_id()))

    def sums(of: DataFrame, within: list[str], by: list[str]) -> DataFrame:
        before = Window.partitionBy(*within).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
        based = of.withColumns({"base": F.coalesce(F.sum("n").over(before), F.lit(0)), "first": F.coalesce(F.sum("docs").over(before), F.lit(0))})
        return based.withColumn("open", F.max(F.col("base") + F.col("last")).over(before))

    inner = sums(dealt, ["_range"], by)
    outer = sums(inner.groupBy("_range").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.max(F.col("base") + F.col("last")).alias("last")), [], ["_range"])
    outer = outer.select("_range", F.col("base").alias("_base"), F.col("first").alias("_first"), F.col("open").alias("_open"))
    opened = F.greatest("_open", F.col("_base") + F.col("open"))
    return cut(inner.join(outer, "_range").select("block", "n", "docs", "last", (F.col("_base") + F.col("base")).alias("base"), (F.col("_first") + F.col("first")).alias("first"), F.coalesce(opened, F.lit(0)).alias("open")))


def token_counts(spark: SparkSession, folder: str, end: int, kind: str = KIND) -> DataFrame:
    """One row per document: position (from 0), start (ids before it, ends included), n_tokens (without the end), ended."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(*batch.columns, strict=True):
                ends, n = _ends(content.as_py() or b"", end, kind)
                yield pa.RecordBatch.from_arrays([pa.array([path.as_py()]), pa.array([n], pa.int64()), pa.array([ends.tolist()], pa.list_(pa.int64()))], names=["block", "n", "ends"])

    blocks = cut(files.select("path", "content").mapInArrow(scan, "block string, n bigint, ends array<bigint>"))
    at = _placed(blocks)
    each = blocks.where(F.size("ends") > 0).select("block", "ends").join(at, "block")
    starts = F.concat(F.array("open"), F.transform(F.slice("ends", 1, F.size("ends") - 1), lambda e: F.col("base") + e + 1))
    each = each.select("first", F.posexplode(F.arrays_zip(starts.alias("start"), F.transform("ends", lambda e: F.col("base") + e).alias("end"))).alias("k", "d"))
    rows = each.select((F.col("first") + F.col("k")).alias("position"), F.col("d.start").alias("start"), (F.col("d.end") - F.col("d.start")).alias("n_tokens"), F.lit(True).alias("ended"))
    total = at.agg(F.sum("docs").alias("position"), F.max(F.coalesce(F.col("base") + F.col("last"), F.lit(0))).alias("start"), F.sum("n").alias("all"))
    rest = total.where("all > start").select("position", "start", (F.col("all") - F.col("start")).alias("n_tokens"), F.lit(False).alias("ended"))
    return rows.unionByName(rest)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder, end = new_folder(spark, "flat-ids"), 50256
    write_flat(documents(spark, sf_dir), folder, public_tokenizers.path("byte_bpe_50k.json"), end)
    return token_counts(spark, folder, end)
