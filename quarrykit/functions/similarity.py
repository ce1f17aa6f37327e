"""Similarity of names: of single pairs, and of all pairs of names that share a block.

Pairs of a block never leave the task that compares them. A tile is the names of a block, or two parts of a large one; its pairs are held as places in an array, left out by lengths and by the sum
of the least counts of each letter (a common subsequence is a common multiset of letters), and the rest get the length of their longest common subsequence by bit-parallel rows, side by side in
numpy. Exact for any names; those over 64 letters are compared one by one after both bounds."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def indel_ratio(a: str | None, b: str | None) -> float | None:
    """2 * LCS / (len a + len b), the longest common subsequence by bit-parallel rows; 1 for two empty texts."""
    if a is None or b is None:
        return None
    if not a and not b:
        return 1.0
    places: dict[str, int] = {}
    for k, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << k
    full = row = (1 << len(a)) - 1
    for c in b:
        both = row & places.get(c, 0)
        row = ((row + both) | (row - both)) & full
    return 2 * (len(a) - row.bit_count()) / (len(a) + len(b))


def matcher_ratio(a: str | None, b: str | None) -> float | None:
    """Share of letters in the longest common blocks, found from the longest on to either side of it."""
    return None if a is None or b is None else SequenceMatcher(None, a, b).ratio()


def _per_pair(ratio: Callable[[str | None, str | None], float | None], a: pd.Series, b: pd.Series) -> pd.Series:
    """Names repeat from block to block, so a pair that a batch has more than once is compared once."""
    pairs = list(zip(a, b, strict=True))
    known = {p: ratio(*p) for p in set(pairs)}
    return pd.Series([known[p] for p in pairs], dtype="float64")


@F.pandas_udf(DoubleType())
def indel_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return _per_pair(indel_ratio, a, b)


@F.pandas_udf(DoubleType())
def matcher_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return _per_pair(matcher_ratio, a, b)


#: Names of a tile's side at most, names and pairs compared at once, and rows that a task holds besides one tile.
TILE, NAMES_AT_ONCE, PAIRS_AT_ONCE, ROWS = 1024, 4096, 1 << 18, 50_000


class Letters:
    """Names as arrays: codes of letters (0 behind the end), lengths, counts of each letter."""

    def __init__(self, names: list[str]) -> None:
        self.names = names
        self.size = np.fromiter(map(len, names), np.int64, len(names))
        flat = np.frombuffer("".join(names).encode("utf-32-le", "surrogatepass"), np.uint32)
        letters, codes = np.unique(flat, return_inverse=True)
        row = np.repeat(np.arange(len(names)), self.size)
        at = np.arange(len(flat)) - np.repeat(np.cumsum(self.size) - self.size, self.size)
        self.counts = np.zeros((len(names), len(letters) + 1), np.uint16)
        np.add.at(self.counts, (row, codes + 1), 1)
        short = at < 64
        self.codes = np.zeros((len(names), 64), np.intp)
        self.codes[row[short], at[short]] = codes[short] + 1
        self.places = np.zeros((len(names), len(letters) + 1), np.uint64)
        np.bitwise_or.at(self.places, (row[short], codes[short] + 1), np.uint64(1) << at[short].astype(np.uint64))

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common subsequence of each pair; names of `a` have 64 letters at most."""
        full = np.where(self.size[a] < 64, (np.uint64(1) << np.minimum(self.size[a], 63).astype(np.uint64)) - np.uint64(1), ~np.uint64(0))
        row = full.copy()
        for k in range(int(self.size[b].max(initial=0))):
            both = row & self.places[a, self.codes[b, k]]  # nothing behind the end
            row = ((row + both) | (row - both)) & full
        return self.size[a] - np.bitwise_count(row).astype(np.int64)


def similar_in(names: list[str], a: np.ndarray, b: np.ndarray, cutoff: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Of pairs (places of names) those with an indel ratio of the cut-off or more, their ratios, and how many pairs were compared letter by letter."""
    found, compared, letters = [], 0, Letters(names)
    for k in range(0, len(a), PAIRS_AT_ONCE):
        x, y = a[k : k + PAIRS_AT_ONCE], b[k : k + PAIRS_AT_ONCE]
        m, n = letters.size[x], letters.size[y]
        need = cutoff * (m + n) / 2 - 1e-9
        some = np.minimum(m, n) >= need
        x, y, need = x[some], y[some], need[some]
        some = np.minimum(letters.counts[x], letters.counts[y]).sum(axis=1) >= need
        x, y = x[some], y[some]
        compared += len(x)
        m, n = letters.size[x], letters.size[y]
        ratio = np.zeros(len(x))
        short, total = (m <= 64) & (n <= 64), m + n
        ratio[short] = 2 * letters.common(x[short], y[short]) / np.maximum(total[short], 1)
        ratio[total == 0] = 1.0
        for i in np.flatnonzero(~short).tolist():
            ratio[i] = indel_ratio(names[x[i]], names[y[i]])
        hit = ratio >= cutoff
        found.append((x[hit], y[hit], ratio[hit]))
    none = np.empty(0, np.intp)
    return *(np.concatenate([f[k] for f in found]) if found else none for k in range(3)), compared


def tile_pairs(tile: np.ndarray, side: np.ndarray, names: int = NAMES_AT_ONCE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For rows ordered by tile: spans of rows of whole tiles, and their pairs as places within the span. Sides -1: all pairs of a tile; 0 and 1: pairs across."""
    starts = np.flatnonzero(np.concatenate(([True], tile[1:] != tile[:-1]))) if len(tile) else np.empty(0, np.intp)
    ends = np.concatenate((starts[1:], [len(tile)])) if len(starts) else starts
    k = 0
    while k < len(starts):
        last = k
        while last + 1 < len(starts) and ends[last + 1] - starts[k] <= names:
            last += 1
        begin, a, b = int(starts[k]), [], []
        for s, e in zip((starts[k : last + 1] - begin).tolist(), (ends[k : last + 1] - begin).tolist(), strict=True):
            if side[begin + s] < 0:
                i, j = np.triu_indices(e - s, 1)
            else:
                of = side[begin + s : begin + e]
                i, j = (x.ravel() for x in np.meshgrid(np.flatnonzero(of == 0), np.flatnonzero(of == 1), indexing="ij"))
            a.append(i + s)
            b.append(j + s)
        yield begin, int(ends[last]), np.concatenate(a), np.concatenate(b)
        k = last + 1


def similar_rows(batches: Iterator[pa.RecordBatch], cutoff: float) -> Iterator[pa.RecordBatch]:
    """Rows (tile, again, side, block, name) ordered by the two numbers of a tile to block, x, y, similarity of similar pairs, x before y. Holds ROWS rows and the last tile."""
    held: list[pa.RecordBatch] = []

    def made(whole: bool) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        first, second = table.column(0).to_numpy(), table.column(1).to_numpy()
        tile = np.cumsum(np.concatenate(([0], (first[1:] != first[:-1]) | (second[1:] != second[:-1]))))
        end = len(tile) if whole else int(np.searchsorted(tile, tile[-1]))
        if end < len(tile):
            held.extend(table.slice(end).to_batches())
        side, block, name = table.column(2).to_numpy()[:end], table.column(3), table.column(4).slice(0, end).to_pylist()
        for begin, stop, a, b in tile_pairs(tile[:end], side):
            own = name[begin:stop]
            a, b, ratio, _ = similar_in(own, a, b, cutoff)
            if len(a):
                pairs = [sorted((own[i], own[j])) for i, j in zip(a.tolist(), b.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([block.take(pa.array(a + begin)).combine_chunks(), pa.array([p[0] for p in pairs]), pa.array([p[1] for p in pairs]), pa.array(ratio)], names=["block", "x", "y", "similarity"])

    rows = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
        if rows >= ROWS:
            yield from made(False)
            rows = 0
    if held:
        yield from made(True)
