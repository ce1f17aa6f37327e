"""Hard-negative mining by cover trees over norm-augmented candidates.

A candidate x gets one more component, the root of M * M - |x| * |x| with M the greatest norm of its block, an anchor q a zero there. All candidates then have the norm M, so that the inner product
is (|q|^2 + M^2 - d^2) / 2 of their distance d, and a node of a cover tree, centre c and covering radius r, bounds those of all it covers: their distances are within r of the centre's.

Candidates are dealt to blocks of bounded size, by label as far as sizes allow: labels over half a block get blocks of their own, as many as they fill, others share blocks. Each block is one tree, built once
and stored. Its levels are nets: centres are taken farthest first until all of a node's members are within half its radius of one, or WIDTH are taken; members go to the nearest centre, a
child's radius is the distance of its farthest member, and nodes of LEAF members are leaves. Anchors meet a tree in chunks of bounded size. A descent takes the nodes of the
greatest upper bounds first, leaves out those outside all windows or below the k-th best found, and verifies leaves by exact integer products. Positives come first, from the blocks of the anchor's label alone; their scores
are the windows with which the anchor then meets all blocks. What blocks find, at most k rows an anchor and window, is put together by a window function.

Defined results: an id is that of one row as a rule; exact copies of a row count once; rows of one id that differ are rows of their own, 'other' rows are those of another id, and an anchor's rows each give their results;
rows without id, label or vector or with a component that is null or not finite take no part; components that a shorter vector lacks count as zero; an empty vector is all zeros; equal scores go by the smaller id;
a negative positive score has an empty window (80 % of it lies above it), a score of zero takes zeros; anchors without another row of their label give no rows, as do windows without a row; columns other than id, vector and label are not read.
Products are exact up to 2 ** 53; beyond that they are worked out in Python's integers, and scores over 2 ** 63 raise."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut

#: Scale of components; shares of the positive score that bound a window, in percent; rows of each list; ids of anchors and of rows whose label moves on.
SCALE, LOW, HIGH, TOP = 256, 80, 100, 5
ANCHORS, MOVED, LABELS = 100, 7, 10
#: Rows of a block at most, at least, and blocks that a small table has; anchors of a chunk; children of a node, members of a leaf, nodes that a descent takes first.
BLOCK, LEAST, BLOCKS, CHUNK = 32768, 1024, 64, 2048
WIDTH, LEAF, FIRST = 64, 48, 16


@dataclass
class CoverTree:
    """Nodes in level order: centre (place of a row), radius, children or members as ranges. Rows are in the order of leaves."""

    ids: np.ndarray
    labels: np.ndarray
    rows: np.ndarray
    norm: float
    centre: np.ndarray
    radius: np.ndarray
    child: np.ndarray
    member: np.ndarray


def _exact(most: float) -> type:
    """A type in which products of rows whose norms' product is at most this are whole numbers."""
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else object


def build(ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, width: int = WIDTH, leaf: int = LEAF) -> CoverTree:
    """The tree of a block's rows (whole numbers, n by d)."""
    x = rows.astype(np.float64)
    square = (x * x).sum(axis=1)
    most = float(square.max())
    lifted = np.column_stack((x, np.sqrt(np.maximum(most - square, 0))))
    away = lambda some, c: np.sqrt(np.maximum(((lifted[some] - lifted[c]) ** 2).sum(axis=1), 0))
    everyone = np.arange(len(x))
    first = int(np.argmin(away(everyone, 0))) if len(x) else 0
    nodes: list[tuple[int, float, np.ndarray, np.ndarray]] = [(first, 0.0, everyone, away(everyone, first))]
    centre, radius, child, member, order = [], [], [], [], []
    for c, _, some, far in nodes:  # the list grows behind the node at hand: level order
        r = float(far.max())
        centre.append(c)
        radius.append(r)
        if len(some) <= leaf or r == 0:
            member.append((len(order), len(order) + len(some)))
            child.append((0, 0))
            order.extend(some.tolist())
            continue
        nearest, near, centres = np.zeros(len(some), np.intp), far.copy(), [c]
        while len(centres) < width and near.max() > r / 2:
            k = int(near.argmax())
            d = away(some, some[k])
            closer = d < near
            nearest[closer], near[closer] = len(centres), d[closer]
            centres.append(int(some[k]))
        start = len(nodes)
        for k, own in enumerate(centres):
            of = nearest == k
            nodes.append((own, 0.0, some[of], near[of]))
        child.append((start, len(nodes)))
        member.append((0, 0))
    at = np.array(order, np.intp)
    place = np.empty(len(at), np.intp)
    place[at] = np.arange(len(at))
    return CoverTree(ids[at], labels[at], rows[at], most**0.5, place[np.array(centre)], np.array(radius), np.array(child), np.array(member))


class Search:
    """Descents of one tree."""

    def __init__(self, tree: CoverTree, most_norm: float) -> None:
        self.tree = tree
        kind = _exact(tree.norm * most_norm + 1)
        self.rows = tree.rows.astype(kind) if kind is not object else tree.rows.astype(object)
        self.centres = tree.rows[tree.centre].astype(np.float64)

    def bounds(self, q: np.ndarray, square: float, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Upper and lower bound of the products of what the nodes cover, with some slack for rounding."""
        t = self.tree
        whole = square + t.norm * t.norm
        d, r = np.sqrt(np.maximum(whole - 2 * (self.centres[nodes] @ q), 0)), t.radius[nodes]
        slack = 1e-9 * whole + 1e-3
        return (whole - np.maximum(d - r, 0) ** 2) / 2 + slack, (whole - (d + r) ** 2) / 2 - slack

    def best(self, anchor: np.ndarray, own: int, label: object, same: bool, low: np.ndarray, high: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
        """For each window the k best (score, id) of rows of the same label (of other ids) or of others: highest score, then smallest id. `low` and `high` are compared in whole numbers."""
        t, q = self.tree, anchor.astype(np.float64)
        exact, square = anchor.astype(self.rows.dtype), float(q @ q)
        found: list[list[tuple[int, int]]] = [[] for _ in low]
        need, fmost = low.astype(np.float64), high.astype(np.float64)
        front, take = np.zeros(1, np.intp), FIRST
        upper, lower = self.bounds(q, square, front)
        while len(front):
            inside = ((upper[:, None] >= need) & (lower[:, None] <= fmost)).any(axis=1)
            front, upper, lower = front[inside], upper[inside], lower[inside]
            if not len(front):
                break
            if len(front) > take:
                order = np.argpartition(-upper, take)
                now, later = order[:take], order[take:]
            else:
                now, later = np.arange(len(front)), np.empty(0, np.intp)
            nodes, front, upper, lower = front[now], front[later], upper[later], lower[later]
            take *= 2
            leaf = t.child[nodes, 1] == 0
            inner = [np.arange(*t.child[n]) for n in nodes[~leaf].tolist()]
            if inner:
                new = np.concatenate(inner)
                up, down = self.bounds(q, square, new)
                front, upper, lower = np.concatenate((front, new)), np.concatenate((upper, up)), np.concatenate((lower, down))
            spans = t.member[nodes[leaf]].tolist()
            if not spans:
                continue
            score = np.concatenate([self.rows[a:b] @ exact for a, b in spans])
            at = np.concatenate([np.arange(a, b) for a, b in spans])
            some = (score >= need.min()) & (score <= fmost.max())
            score, at = score[some], at[some]
            other = (t.labels[at] == label) & (t.ids[at] != own) if same else t.labels[at] != label
            score, at = score[other], at[other]
            if not len(at):
                continue
            ids = t.ids[at]
            for w in range(len(low)):
                fits = (score >= need[w]) & (score <= fmost[w])
                if fits.any():
                    order = np.lexsort((ids[fits], -score[fits].astype(np.float64)))[:k]
                    new_rows = [(int(s), int(i)) for s, i in zip(score[fits][order].tolist(), ids[fits][order].tolist(), strict=True) if low[w] <= s <= high[w]]
                    found[w] = sorted([*found[w], *new_rows], key=lambda x: (-x[0], x[1]))[:k]
                    if len(found[w]) == k:
                        need[w] = max(need[w], found[w][-1][0])
        return found


def _matrix(column: pa.ChunkedArray | pa.Array, d: int) -> np.ndarray:
    """Lists of whole numbers as rows of d, short ones filled with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), d), np.int64)
    ends = np.cumsum(sizes)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(row)) - (ends - sizes)[row]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _tree_rows(table: pa.Table, d: int) -> pa.Table:
    """A block's rows to its tree. Exact copies of a row go."""
    ids, labels = (table.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label"))
    rows = _matrix(table.column("vec"), d)
    order = np.lexsort((*rows.T[::-1], labels, ids))
    ids, labels, rows = ids[order], labels[order], rows[order]
    new = np.concatenate(([True], (ids[1:] != ids[:-1]) | (labels[1:] != labels[:-1]) | (rows[1:] != rows[:-1]).any(axis=1)))
    tree = build(ids[new], labels[new], rows[new].astype(np.int32 if np.abs(rows).max(initial=0) < 1 << 31 else np.int64))
    return pa.table({"block": table.column("block")[:1], "tree": pa.array([pickle.dumps(tree, 5)], pa.binary())})


def _found(trees: pa.Table, anchors: pa.Table, d: int, same: bool, top: int) -> pa.Table:
    """A chunk of anchors (row, id, label, vec, positives) in one tree: for each anchor and positive what the block has best."""
    out: list[tuple] = []
    if trees.num_rows and anchors.num_rows:
        tree = pickle.loads(trees.column("tree")[0].as_py())
        rows, vec = anchors.select([c for c in anchors.column_names if c != "vec"]).to_pylist(), _matrix(anchors.column("vec"), d)
        norms = np.sqrt((vec.astype(np.float64) ** 2).sum(axis=1))
        search = Search(tree, float(norms.max()))
        for q, r in zip(vec, rows, strict=True):
            if same:
                windows, low, high = [(None, None)], np.array([-np.inf]), np.array([np.inf])
            else:
                windows = [(p["id"], p["score"]) for p in r["positives"]]
                scores = [p["score"] for p in r["positives"]]
                # whole numbers n with LOW * score <= 100 * n <= HIGH * score
                low, high = np.array([-(-LOW * s // 100) for s in scores], float), np.array([HIGH * s // 100 for s in scores], float)
            for (positive, of), best in zip(windows, search.best(q, r["id"], r["label"], same, low, high, top), strict=True):
                out.extend((r["row"], r["id"], positive, of, i, s) for s, i in best)
    names = ("row", "anchor_id", "positive_id", "positive_score", "found_id", "score")
    return pa.table([pa.array([o[k] for o in out], pa.int64()) for k in range(6)], names=list(names))


FOUND = "row bigint, anchor_id bigint, positive_id bigint, positive_score bigint, found_id bigint, score bigint"


def _met(trees: DataFrame, anchors: DataFrame, d: int, same: bool, top: int) -> DataFrame:
    """Anchors (with block and chunk) and the trees of their blocks, a task of each block and chunk."""
    pairs = anchors.select(F.col("block").alias("of"), F.col("chunk").alias("part")).distinct()
    dealt = trees.join(pairs, F.col("block") == F.col("of")).select("of", "part", "tree")
    return dealt.groupBy("of", "part").cogroup(anchors.groupBy("block", "chunk")).applyInArrow(lambda a, b: _found(a, b, d, same, top), FOUND)


def _first(found: DataFrame, keys: list[str], top: int) -> DataFrame:
    return found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "found_id"))).where(F.col("rank") <= top)


def hard_negatives(df: DataFrame, anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding", label: Column | str = "label", top: int = TOP, scale: int = SCALE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. `anchor` tells which rows are anchors, `label` is a column or expression over df."""
    own = df[label] if isinstance(label, str) else label
    whole = F.transform(df[vec_col], lambda c: F.floor(F.lit(scale) * c.cast("double")))
    bad = F.exists(df[vec_col], lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = df.select(df[id_col].cast("bigint").alias("id"), own.cast("bigint").alias("label"), F.when(~F.coalesce(bad, F.lit(True)), whole).alias("vec"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    rows = cut(rows.where("id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL"))
    d, n, n_anchors = rows.agg(F.max(F.size("vec")), F.count(F.lit(1)), F.count_if("anchor")).first()
    size = min(BLOCK, max(LEAST, (n or 0) // BLOCKS))
    shared = max(1, -(-(n or 0) // size))
    # labels of over half a block: fewer than two for each block
    own_blocks, at = [], shared
    for name, count in sorted((r[0], r[1]) for r in rows.groupBy("label").count().where(F.col("count") * 2 > size).collect()):
        own_blocks.append((name, at, -(-count // size)))
        at += own_blocks[-1][2]
    spark = df.sparkSession
    known = F.broadcast(spark.createDataFrame(own_blocks, "label bigint, from bigint, parts bigint"))
    dealt = rows.join(known, "label", "left")
    other = F.pmod(F.xxhash64("label"), F.lit(shared))
    block = F.coalesce(F.col("from") + F.pmod(F.xxhash64("id"), F.col("parts")), other)
    trees = cut(dealt.select("id", "label", "vec", block.alias("block")).groupBy("block").applyInArrow(lambda t: _tree_rows(t, max(1, d or 0)), "block bigint, tree binary"))
    chunks = max(1, -(-(n_anchors or 0) // CHUNK))
    asked = cut(dealt.where("anchor").select("id", "label", "vec", "from", "parts").distinct().withColumn("row", F.xxhash64("id", "label", "vec")).withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(chunks))))
    blocks = F.coalesce(F.sequence("from", F.col("from") + F.col("parts") - 1), F.array(other))
    positives = _met(trees, asked.select("row", "id", "label", "vec", "chunk", F.explode(blocks).alias("block")), max(1, d or 0), True, top)
    positives = cut(_first(positives, ["row", "anchor_id"], top).select("row", "anchor_id", F.struct(F.col("found_id").alias("id"), "score").alias("p")))
    windows = positives.groupBy("row", F.col("anchor_id").alias("id")).agg(F.collect_list("p").alias("positives"))  # at most `top` rows each
    ask = asked.select("row", "id", "label", "vec", "chunk").join(windows, ["row", "id"]).withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(at - 1).cast("bigint"))))
    found = _met(trees, ask, max(1, d or 0), False, top)
    best = _first(found, ["row", "anchor_id", "positive_id", "positive_score"], top)
    return best.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.pmod("vec_id", F.lit(MOVED)) == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return hard_negatives(rows, F.pmod("vec_id", F.lit(ANCHORS)) == 0, label=label)


#: All pairs of anchors and rows.
SQL = """
WITH whole AS (
SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_sum(list_transform(list_zip(a.vec, b.vec), lambda p: p[1] * p[2])) AS BIGINT) AS score
FROM whole a JOIN whole b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INT) AS rank, s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) QUALIFY row_number() OVER w <= 5
"""
