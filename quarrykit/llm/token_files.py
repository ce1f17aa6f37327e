"""Token ids as binary files: each document compressed by itself with one shared zstandard dictionary.

A folder holds two Parquet tables. `dictionary` has one row: the dictionary's SHA-256 and its bytes, trained on the serialized ids of about
SAMPLE documents (at most twice that, picked by a hash, SAMPLE_CHARS characters of each; training only). `segments` has documents
in ascending id order, cut into shards and these into segments of about SEGMENT bytes: payload (the zstandard frames of the
documents one after another; a frame holds the ids as little-endian unsigned 32-bit integers), doc_ids, n_tokens and ends (the index:
place after each frame), start (ids before it in its shard), the number of ids and the hash of the dictionary. A short document costs one frame:
segments are skipped by the statistics of first_id and last_id. Spark writes and commits the files, so any store that Spark can
write will do, and a lost executor's files are written again.

Documents are compressed before they are sorted, so that only frames are shuffled. Starts are sums over documents of a shard and
over shards before it; only one row a shard meets in one task.

Defined results: a null text is an empty one; bytes that aren't UTF-8 are read as U+FFFD; columns other than id and text are not read; ids that are no numbers raise; a null id sorts first; rows that repeat an id are kept, in order of size and content; an empty table
gives an empty folder of segments, that reads as no rows."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import column_type, documents, new_folder, per_text, sampled, slices, texts_of
from .units import byte_units

SAMPLE, SAMPLE_CHARS, DICTIONARY, LEVEL = 1000, 4096, 65536, 1
SEGMENT = 1 << 20
#: Rows of a shard and shards at most.
SHARD_ROWS, SHARDS = 16384, 10_000
LITTLE = np.dtype("<u4")


def serialized(texts: list, path: str, end: int | None) -> list[bytes]:
    """The ids of each text, with the id of the end, as bytes."""
    ids, ends = byte_units(path).ids(texts)
    tail = b"" if end is None else np.array([end], LITTLE).tobytes()
    data = ids.astype(LITTLE).tobytes()
    starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    return [data[4 * a : 4 * b] + tail for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def train_dictionary(df: DataFrame, path: str, end: int | None, id_col: str, text_col: str) -> bytes:
    """A dictionary from a bounded sample; empty (no dictionary) where the sample is too small for one."""
    some = sampled(df, id_col, text_col, SAMPLE).select(F.substring(text_col, 1, SAMPLE_CHARS).alias("t"))
    rows = per_text(some, [], "t", "ids binary", lambda texts: [pa.array(serialized(texts, path, end), pa.binary())]).collect()
    samples = sorted(bytes(r["ids"]) for r in rows)
    try:
        return zstandard.train_dictionary(min(DICTIONARY, max(1024, sum(map(len, samples)) // 10)), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def squeezer(dictionary: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary), write_content_size=True) if dictionary else zstandard.ZstdCompressor(level=LEVEL)


def opener(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdDecompressor()


def in_order(df: DataFrame, id_col: str, text_col: str, fields: str, work: Callable[[list], list], rows: int | None = None) -> DataFrame:
    """What work makes of each text, in ascending order of a numeric id over partitions and in them.

    Bounds of shards of about `rows` (SHARD_ROWS) rows are percentiles of the id column alone; each row goes straight to its shard's partition. So texts
    are read and encoded once and nothing is written on the way. Over SHARDS times `rows` rows shards grow; their sort spills."""
    if column_type(df, id_col).split("(")[0] not in ("tinyint", "smallint", "int", "bigint", "float", "double"):
        raise TypeError(f"{id_col} is {column_type(df, id_col)}; ids must be numbers, so that shards follow their order")
    n = min(SHARDS, max(1, -(-df.count() // (rows or SHARD_ROWS))))
    cuts = df.agg(F.percentile_approx(id_col, [k / n for k in range(1, n)], 20 * n)).first()[0] if n > 1 else None
    bounds, kind = np.array(cuts or [], np.float64 if column_type(df, id_col) in ("double", "float") else np.int64), column_type(df, id_col)
    names = ["_shard", id_col, *(x.split()[0] for x in fields.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column(0)
            shard = np.searchsorted(bounds, ids.fill_null(0).to_numpy(zero_copy_only=False), side="right")
            shard[ids.is_null().to_numpy(zero_copy_only=False)] = 0
            yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int32)), ids, *work(texts_of(batch.column(1)))], names=names)

    made = df.select(df[id_col], df[text_col]).mapInArrow(run, f"_shard int, `{id_col}` {kind}, {fields}")
    return made.repartitionById(n, "_shard").sortWithinPartitions(F.col(id_col).asc_nulls_first(), *names[2:]).select(*names[1:])


def write_token_files(df: DataFrame, folder: str, path: str, end: int | None = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the folder; path is the tokenizer's file."""
    spark = df.sparkSession
    dictionary = train_dictionary(df, path, end, id_col, text_col)
    key = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(key, bytearray(dictionary))], "hash string, data binary").coalesce(1).write.parquet(f"{folder}/dictionary")

    def frames(texts: list) -> list:
        squeeze, data = squeezer(dictionary), serialized(texts, path, end)
        return [pa.array([len(x) // 4 for x in data], pa.int64()), pa.array([squeeze.compress(x) for x in data], pa.binary())]

    ids = column_type(df, id_col)
    schema = f"shard int, segment int, first_id {ids}, last_id {ids}, start bigint, total bigint, doc_ids array<{ids}>, n_tokens array<bigint>, ends array<int>, dictionary string, payload binary"

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, start, held = TaskContext.get().partitionId(), 0, 0, []

        def put() -> pa.RecordBatch:
            doc_ids, sizes, data = zip(*held, strict=True)
            known = [i for i in doc_ids if i is not None]
            row = {"shard": shard, "segment": number, "first_id": known[0] if known else None, "last_id": known[-1] if known else None, "start": start, "total": sum(sizes), "doc_ids": list(doc_ids), "n_tokens": list(sizes), "ends": np.cumsum([len(x) for x in data]).tolist(), "dictionary": key, "payload": b"".join(data)}
            types = {"shard": pa.int32(), "segment": pa.int32(), "ends": pa.list_(pa.int32()), "doc_ids": pa.list_(id_type), "first_id": id_type, "last_id": id_type}
            return pa.RecordBatch.from_arrays([pa.array([v], types.get(k)) for k, v in row.items()], names=list(row))

        size = 0
        for batch in slices(batches):
            id_type = batch.schema.field(0).type
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(row)
                size += len(row[2])
                if size >= SEGMENT:
                    yield put()
                    start, number, size = start + sum(r[1] for r in held), number + 1, 0
                    held.clear()
        if held:
            yield put()

    in_order(df, id_col, text_col, "n_tokens bigint, frame binary", frames).mapInArrow(segments, schema).write.option("compression", "none").parquet(f"{folder}/segments")


def _dictionary(spark: SparkSession, folder: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{folder}/dictionary").first()
    return row["hash"], bytes(row["data"])


def read_token_files(spark: SparkSession, folder: str, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """One row per document, from the files: id, start, n_tokens, ids_crc32, and the ids as array if asked for."""
    key, dictionary = _dictionary(spark, folder)
    segments = spark.read.parquet(f"{folder}/segments")
    fields = f"`{id_col}` {column_type(segments, 'first_id')}, shard int, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids
    names = [id_col, "shard", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def open_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = opener(dictionary)
        for batch in slices(batches, 1):
            shard, start, doc_ids, sizes, ends, used, payload = (c[0].as_py() for c in batch.columns)
            if used != key:
                raise ValueError(f"segment needs dictionary {used}; the folder has {key}")
            data = [unpack.decompress(payload[a:b]) if b > a else b"" for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            if [len(x) // 4 for x in data] != sizes:
                raise ValueError("frames don't fit the index")
            starts = start + np.cumsum(sizes) - np.array(sizes)
            out = [pa.array(doc_ids, batch.schema.field(2).type.value_type), pa.array([shard] * len(data), pa.int32()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array([zlib.crc32(x) for x in data], pa.int64())]
            yield pa.RecordBatch.from_arrays([*out, *([pa.array([np.frombuffer(x, LITTLE).astype(np.int64) for x in data], pa.list_(pa.int64()))] if with_ids else [])], names=names)

    rows = segments.select("shard", "start", "doc_ids", "n_tokens", "ends", "dictionary", "payload").mapInArrow(open_all, fields)
    totals = segments.groupBy("shard").agg(F.sum("total").alias("_n"))
    before = totals.select("shard", (F.sum("_n").over(Window.orderBy("shard")) - F.col("_n")).alias("_before"))  # a row a shard
    return rows.join(F.broadcast(before), "shard").select(id_col, (F.col("start") + F.col("_before")).alias("start"), *names[3:])


def read_document(spark: SparkSession, folder: str, doc_id: int) -> list[list[int]]:
    """The ids of each document with this id: only segments whose range holds it are read, only its frames opened."""
    key, dictionary = _dictionary(spark, folder)
    held = spark.read.parquet(f"{folder}/segments").where((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id))
    at = F.explode(F.filter(F.sequence(F.lit(1), F.size("doc_ids")), lambda k: F.element_at("doc_ids", k) == doc_id))
    found = held.select("payload", "ends", at.alias("k"))
    begin = F.when(F.col("k") > 1, F.element_at("ends", F.greatest(F.col("k") - 1, F.lit(1)))).otherwise(0)
    frames = found.select(F.expr("payload").substr(begin + 1, F.element_at("ends", F.col("k")) - begin).alias("f")).collect()
    return [np.frombuffer(opener(dictionary).decompress(bytes(r["f"])), LITTLE).tolist() for r in frames]


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = new_folder(spark, "token-files")
    write_token_files(documents(spark, sf_dir), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(spark, folder)
