"""Quality rules by compression bands.

A text is compressed by zstandard as a whole and in fixed chunks of CHUNK bytes. The ratio, bytes before to bytes after, of
repetitive text is high, that of random or encoded text low; both bounds depend on the length, since longer texts compress
better and a frame costs some bytes. A text is kept if its whole ratio is within the band of its length and no more than
CHUNKS_OUT of its chunks are out of theirs. Base figures (words, symbols, repeated lines and windows) stand beside it.

Bands are half octaves of the bytes, for whole texts and for chunks apart. Their limits are learned from all texts that pass
the base rules: TAILS times as far from the median as the percentiles EDGES, and at least LEAST_MARGIN of it. Percentiles are exact, over
ratios cut to 1/CELLS, so a task holds a bounded histogram and runs agree. A band of fewer than LEAST_ROWS has the fixed limits.

Defined results: a null text counts as empty: no words, so base_failed; the last chunk joins the one before if it
is under half a chunk; repeated rows count as often as they are there; bytes that aren't UTF-8 are read as U+FFFD; columns other than id and text are not read, whatever their
names; rows of an empty table are none.

What ratios can't tell: words of base64 under about 250 bytes, words of hex under about 2 KB and hex bytes with spaces between
compress as prose of that length does; a kind of text that is under a tenth of its band (a rare script, say) counts by the others' limits."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column_type, cut, documents, free, per_text, slices

WINDOW, LEVEL, CHUNK = 8, 3, 4096
#: Limits of bands with few rows. Up to so many bytes: least and greatest ratio of the whole text; then those of a chunk.
BANDS = ((100, 0.6, 2.0), (200, 0.75, 2.2), (400, 1.05, 2.4), (700, 1.25, 2.6), (1000, 1.4, 2.7), (2000, 1.5, 2.9), (4000, 1.9, 3.0), (20_000, 2.0, 3.3), (float("inf"), 2.05, 4.0))
CHUNK_BAND = (1.9, 3.2)
EDGES, TAILS, LEAST_MARGIN, LEAST_ROWS = (0.1, 0.9), 3.5, 0.08, 100
#: Cells of a histogram for a ratio of one, and the ratio from which all count as one.
CELLS, MOST_RATIO = 256, 16
#: The greatest share of chunks out of the band of their own length.
CHUNKS_OUT = 0.2
#: (is a chunk, band) to least and greatest ratio.
Limits = dict[tuple[bool, int], tuple[float, float]]
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = re.compile(r"[#*$%&|<>]")
HAS_WORD = re.compile(r"[^\x20\x09-\x0D]")


def fixed(size: int) -> tuple[float, float]:
    return next((low, high) for most, low, high in BANDS if size <= most)


def half_octave(size: int) -> int:
    """Whole part of twice the binary logarithm."""
    return (size * size).bit_length() - 1


def band(limits: Limits, chunk: bool, size: int) -> tuple[float, float]:
    return limits.get((chunk, half_octave(size))) or (CHUNK_BAND if chunk else fixed(size))


def chunks(data: bytes, chunk: int = CHUNK) -> Iterator[bytes]:
    n = max(1, (len(data) + chunk // 2) // chunk)
    for k in range(n):
        yield data[k * chunk : (k + 1) * chunk if k < n - 1 else len(data)]


def measure(data: bytes, squeeze: zstandard.ZstdCompressor) -> tuple[list[int], list[float]]:
    """Bytes and ratios: of the whole text, then of each chunk if it has more than one chunk's bytes."""
    parts = [data, *(chunks(data) if len(data) > CHUNK else [])] if data else []
    return [len(x) for x in parts], [len(x) / len(squeeze.compress(x)) for x in parts]


def verdict(sizes: list[int], ratios: list[float], limits: Limits) -> tuple[float, float, bool]:
    """Whole ratio, share of chunks out of their band, whether the text is within its bands."""
    if not sizes:
        return 0.0, 0.0, False
    out = []
    for k, (size, ratio) in enumerate(zip(sizes, ratios, strict=True)):
        low, high = band(limits, k > 0, size)
        out.append(not low <= ratio <= high)
    share = sum(out[1:]) / len(out[1:]) if len(out) > 1 else float(out[0])
    return ratios[0], share, not out[0] and share <= CHUNKS_OUT


def compression(data: bytes, squeeze: zstandard.ZstdCompressor, limits: Limits | None = None) -> tuple[float, float, bool]:
    return verdict(*measure(data, squeeze), limits or {})


def learned(measured: DataFrame, sizes: str, ratios: str) -> Limits:
    """Limits of every band with LEAST_ROWS whole texts or chunks of texts that pass the base rules: an aggregate of a row a band."""
    part = measured.where(~F.col("base_failed")).select(F.posexplode(F.arrays_zip(F.col(sizes).alias("size"), F.col(ratios).alias("ratio"))).alias("at", "part"))
    octave = F.length(F.bin(F.col("part.size") * F.col("part.size"))) - 1
    cell = F.floor(F.least(F.col("part.ratio"), F.lit(MOST_RATIO)) * CELLS)
    rows = part.groupBy((F.col("at") > 0).alias("chunk"), octave.alias("octave")).agg(F.percentile(cell, F.array(F.lit(EDGES[0]), F.lit(0.5), F.lit(EDGES[1]))).alias("edges"), F.count("*").alias("n"))
    limits = {}
    for r in rows.where(F.col("n") >= LEAST_ROWS).collect():
        low, middle, high = (x / CELLS for x in r["edges"])
        least = LEAST_MARGIN * middle
        limits[r["chunk"], r["octave"]] = (middle - max(least, TAILS * (middle - low)), middle + max(least, TAILS * (high - middle)))
    return limits


def repeated_words(words: list[list[str]], window: int = WINDOW) -> np.ndarray:
    """For each text the words that lie in windows found twice or more in it. Exact: windows are compared by numbers
    that are equal only for equal words, of 1, 2, 4 and 8 words in turn."""
    sizes = np.array([len(w) for w in words], np.int64)
    out = np.zeros(len(words), np.int64)
    if not sizes.sum():
        return out
    ids = pd.factorize(np.array([w for x in words for w in x], object))[0].astype(np.int64)
    text = np.repeat(np.arange(len(words)), sizes)
    step = 1
    while step < window:
        ids = pd.factorize(ids[:-step] * (ids.max() + 1) + ids[step:])[0].astype(np.int64) if len(ids) > step else ids[:0]
        step *= 2
    n = len(ids)
    if not n:
        return out
    here = np.flatnonzero(text[:n] == text[window - 1 : n + window - 1])
    key = pd.factorize(ids[here] * len(words) + text[here])[0]
    twice = here[np.bincount(key)[key] > 1]
    mark = np.zeros(len(text) + 1, np.int64)
    np.add.at(mark, twice, 1)
    np.add.at(mark, twice + window, -1)
    np.add.at(out, text[np.cumsum(mark[:-1]) > 0], 1)
    return out


def repeated_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if HAS_WORD.search(x)]
    return len(lines) - len(set(lines))


def quality_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, ratio, chunks_out."""

    def work(texts: list) -> list:
        squeeze = zstandard.ZstdCompressor(level=LEVEL)
        texts = [t or "" for t in texts]
        words = [WORD.findall(t) for t in texts]
        n = np.array([len(w) for w in words], np.int64)
        repeat = repeated_words(words)
        failed = (n < 20) | (100 * repeat > 30 * n)
        sizes, ratios = zip(*(measure(t.encode("utf-8", "surrogatepass"), squeeze) for t in texts), strict=True) if texts else ([], [])
        longs = [n, [sum(map(len, w)) for w in words], [len(SYMBOLS.findall(t)) for t in texts], [repeated_lines(t) for t in texts], repeat]
        return [*(pa.array(x, pa.int64()) for x in longs), pa.array(failed), pa.array(sizes, pa.list_(pa.int64())), pa.array(ratios, pa.list_(pa.float64()))]

    base = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean"
    name = free(df, "id")
    measured = cut(per_text(df.select(df[id_col].alias(name), df[text_col]), [name], text_col, f"{base}, sizes array<bigint>, ratios array<double>", work))
    limits = learned(measured, "sizes", "ratios")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            told = [verdict(s, r, limits) for s, r in zip(batch.column(7).to_pylist(), batch.column(8).to_pylist(), strict=True)]
            ratio, share, good = zip(*told, strict=True) if told else ([], [], [])
            kept = pc.and_(pc.invert(batch.column(6)), pa.array(good, pa.bool_()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], kept, pa.array(ratio, pa.float64()), pa.array(share, pa.float64())], names=names)

    schema = f"`{id_col}` {column_type(df, id_col)}, {base}, kept boolean, ratio double, chunks_out double"
    names = [id_col, *(x.split()[0] for x in base.split(", ")), "kept", "ratio", "chunks_out"]
    return measured.mapInArrow(judge, schema)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))
