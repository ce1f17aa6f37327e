"""Packing of documents into sequences by sums of squares.

A document is its ids and the end's id. Longer ones than a sequence are cut; a whole piece fills a sequence. Each other piece goes, longest first,
to the open sequence for which the sum over all residual gaps of the squared number of open sequences with that gap becomes smallest, the smallest
gap among equals; a new one is opened only where none has room (Csirik et al., "On the Sum-of-Squares Algorithm for Bin Packing",
2006). So a new sequence is never weighed against open ones with room. Pieces are dealt by a hash of their number in the table to groups of about GROUP, each packed by a task: a group wastes one or two sequences of its thousands,
whatever the table's size, and no task or driver holds more than a group.

Defined results: a null text is an empty one: one piece, the end alone; bytes that aren't UTF-8 are read as U+FFFD; columns other than id and text are not read; rows that repeat an id are packed each; ties of length go by id
and piece; an empty table gives no rows."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column_type, cut, documents, free, slices, texts_of
from .units import word_units

CAPACITY, GROUP, END = 2048, 16384, 0


def pieces(df: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32."""
    names = [id_col, "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, ends = word_units(path).ids(texts_of(batch.column(1)))
            data = memoryview(np.insert(ids, ends, end).astype("<u4").tobytes())
            ends = ends + np.arange(1, len(ends) + 1)
            size = np.diff(np.concatenate(([0], ends)))
            n = -(-size // capacity)
            row = np.repeat(np.arange(len(n)), n)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            length = np.minimum(capacity, size[row] - start)
            at = 4 * ((ends - size)[row] + start)
            crc = [zlib.crc32(data[a : a + 4 * k]) for a, k in zip(at.tolist(), length.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start.astype(np.int64)), pa.array(length.astype(np.int64)), pa.array(crc, pa.int64())], names=names)

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {column_type(df, id_col)}, piece int, start bigint, length bigint, ids_crc32 bigint")


def sum_of_squares(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Sequence number and offset of each length, in the order given."""
    count = np.zeros(capacity + 1, np.int64)  # open sequences of each residual gap
    open_with: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset, used = [], [], 0
    for n in lengths:
        gaps = np.flatnonzero(count[n:capacity]) + n
        if len(gaps):
            change = 2 * (count[gaps - n] * (gaps > n) - count[gaps]) + 1 + (gaps > n)
            gap = int(gaps[change.argmin()])
            count[gap] -= 1
            number = open_with[gap].pop()
        else:
            gap, number, used = capacity, used, used + 1
        sequence.append(number)
        offset.append(capacity - gap)
        if gap > n:
            count[gap - n] += 1
            open_with[gap - n].append(number)
    return sequence, offset


def pack(df: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut_up = cut(pieces(df, path, capacity, end, id_col, text_col))
    groups = max(1, -(-cut_up.count() // group))
    names, nth = [*cut_up.columns, "sequence_id", "offset"], free(cut_up, "nth")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).drop_columns([nth])
        table = table.sort_by([("length", "descending"), (id_col, "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        number, offset = sum_of_squares(table["length"].to_pylist(), capacity)
        first = TaskContext.get().partitionId() << 32
        table = table.append_column("sequence_id", pa.array([first + k for k in number], pa.int64())).append_column("offset", pa.array(offset, pa.int64()))
        yield from table.to_batches()

    fields = ", ".join(f"`{c}` {column_type(cut_up, c)}" for c in cut_up.columns)
    dealt = cut_up.withColumn(nth, F.monotonically_increasing_id()).repartition(groups, F.xxhash64(nth))  # by number: ids may repeat
    return dealt.mapInArrow(run, f"{fields}, sequence_id bigint, offset bigint").select(*names)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
