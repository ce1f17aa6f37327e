"""Cells that follow the data: a cell whose polygons have many edges in it is split in four until each part has few.

A cell is a row: key columns, _i and _j (place in the grid), and `parts`, of each polygon that has edges in or near it or lies around it the polygon's name, whether the cell's place lies inside, and those edges. Splitting is done
where the row is, in numpy; levels double the grid, so that a point's cell of any level follows from its coordinates."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Place in a cell that it is judged by, where no boundary's own coordinates are likely to lie. Edges of a cell at most, and levels of splitting.
PLACE, MOST, DEPTH = (0.38196601, 0.61803399), 24, 14
EARTH_KM = 6371.0088
Part = tuple[object, bool, np.ndarray]


def reach(km: float, low: float, high: float) -> tuple[float, float]:
    """Degrees of latitude and of longitude that a distance spans at most, between these latitudes."""
    dy = math.degrees(km / EARTH_KM)
    return dy, dy / math.cos(math.radians(min(max(abs(low - dy), abs(high + dy)), 89.0))) + 1e-9


def touching(edges: np.ndarray, i: int, j: int, size: float, km: float) -> np.ndarray:
    """Which edges (x1, y1, x2, y2) pass the cell or come within so many km of it; may take some that just don't."""
    dy, dx = reach(km, j * size, (j + 1) * size)
    low, high = j * size - dy, (j + 1) * size + dy
    x1, y1, x2, y2 = edges.T
    bottom, top = np.minimum(y1, y2), np.maximum(y1, y2)
    there = (top >= low) & (bottom <= high)
    with np.errstate(divide="ignore", invalid="ignore"):
        slope = (x2 - x1) / (y2 - y1)
        a, b = (np.where(y1 == y2, x, slope * (y - y1) + x1) for x, y in ((x1, np.maximum(bottom, low)), (x2, np.minimum(top, high))))
    return there & (np.maximum(a, b) >= i * size - dx - 1e-12) & (np.minimum(a, b) <= (i + 1) * size + dx + 1e-12)


def crossed(edges: np.ndarray, x0: float, y0: float, x: float, y: float) -> bool:
    """Whether the way from one place to the other, level and then upright, crosses an odd number of edges."""
    x1, y1, x2, y2 = edges.T
    with np.errstate(divide="ignore", invalid="ignore"):
        at_x = (x2 - x1) * (y - y1) / (y2 - y1) + x1
        at_y = (y2 - y1) * (x0 - x1) / (x2 - x1) + y1
        level = ((y1 > y) != (y2 > y)) & ((at_x > x) != (at_x > x0))
        upright = ((x1 > x0) != (x2 > x0)) & ((at_y > y0) != (at_y > y))
    return bool((int(level.sum()) + int(upright.sum())) % 2)


def split(parts: list[Part], level: int, i: int, j: int, grid: float, km: float, most: int) -> Iterator[tuple[int, int, int, list[Part]]]:
    """The cells (level, i, j, parts) that a cell is split into, those without parts among them, so that they tile it: none has more than `most` edges but those of the last level, or no wider than twice the distance."""
    size = grid / 2**level
    if sum(len(e) for _, _, e in parts) <= most or level >= DEPTH or (km and size < 2 * math.degrees(km / EARTH_KM)):
        yield level, i, j, parts
        return
    x0, y0 = (i + PLACE[0]) * size, (j + PLACE[1]) * size
    for a, b in ((2 * i, 2 * j), (2 * i + 1, 2 * j), (2 * i, 2 * j + 1), (2 * i + 1, 2 * j + 1)):
        x, y = (a + PLACE[0]) * size / 2, (b + PLACE[1]) * size / 2
        made = []
        for name, inside, edges in parts:
            own, within = edges[touching(edges, a, b, size / 2, km)], inside != crossed(edges, x0, y0, x, y)
            if len(own) or within:
                made.append((name, within, own))
        yield from split(made, level + 1, a, b, grid, km, most)


def split_rows(batches: Iterator[pa.RecordBatch], keys: int, grid: float, km: float, most: int) -> Iterator[pa.RecordBatch]:
    """Rows (keys, _i, _j, parts) to rows (keys, level, _i, _j, parts)."""
    for batch in batches:
        column = batch.column(keys + 2)
        kind, starts = column.type, column.offsets.to_numpy()
        names, insides, lists = (column.values.field(k) for k in range(3))
        at = lists.offsets.to_numpy()
        edges = np.column_stack([lists.values.field(k).to_numpy(zero_copy_only=False) for k in range(4)]) if len(lists.values) else np.empty((0, 4))
        for row in range(batch.num_rows):
            parts = [(names[k].as_py(), insides[k].as_py(), edges[at[k] : at[k + 1]]) for k in range(starts[row], starts[row + 1])]
            own = [batch.column(k)[row] for k in range(keys)]
            cells = list(split(parts, 0, batch.column(keys)[row].as_py(), batch.column(keys + 1)[row].as_py(), grid, km, most))
            listed = [[{"polygon": n, "in_": w, "edges": [dict(zip(("x1", "y1", "x2", "y2"), e, strict=True)) for e in es.tolist()]} for n, w, es in ps] for *_, ps in cells]
            columns = [pa.array([v.as_py()] * len(cells), v.type) for v in own]
            columns += [pa.array([c[0] for c in cells], pa.int32()), *(pa.array([c[k] for c in cells], pa.int64()) for k in (1, 2)), pa.array(listed, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:keys], "level", *batch.schema.names[keys:]])
