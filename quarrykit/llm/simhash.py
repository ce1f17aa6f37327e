"""SimHash near-dedup by deletion-variant signatures.

A fingerprint has 64 bits. Two that differ by at most four are cut into three segments (21, 21 and 22 bits), so that
one of them differs by at most one bit; for another radius r there are r // 2 + 1 segments. Each segment value is indexed under every variant with one bit deleted: values
that differ by at most one bit share a variant. An equality on (segment, deleted bit, rest) brings candidates
together, and the whole fingerprints are verified.

Only distinct fingerprints are indexed, so copies cost nothing, and within an index entry only connectivity is emitted: a search
through members not yet reached, never all pairs. Entries over BLOCK members are dealt out as pairs of blocks, each
a task of its own; every pair of members meets in one of them. No link is lost and no entry is capped.

similar_texts does the same for texts of a Jaccard similarity of about 0.8 or more in 5-word shingles. Fingerprints of 64 bits are too short for that:
such texts differ by about a sixth of the bits, give or take. Its sketches have 256 bits, of the distinct shingles; two link at DISTANCE or fewer
differing bits. No index of such sketches is both exact and selective (with every segment that must be near somewhere, an entry's candidates are an eighth of all pairs), so every
pair of distinct sketches is compared: sketches are dealt out to tiles, each pair of tiles is one task's work on arrays of bounded size, and what it emits is connectivity, at most an edge a member. Nothing
that links is left out; the work grows with the square of the distinct sketches (the README has the figures).

Defined results: a null text counts as empty; without words the fingerprint is zero, and zero links like any other;
bytes that aren't UTF-8 are hashed as they are; columns other than id and text are not read by near_duplicates and pass through drop_near_duplicates;
rows that repeat an id get the component of their own text; component_id is the smallest non-null id reachable (null if none is)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import column_type, cut, documents, new_folder, per_text, settle
from .components import connected_components

WIDTH, SEED, RADIUS, BLOCK = 4, 42, 4, 8192
#: Shingles whose bits are counted at once, rows of index that a task holds besides one entry, and entries compared by offsets.
BITS_AT_ONCE, ROWS, SMALL = 65536, 200_000, 32
#: A fingerprint with more than this share of all rows gets its class by broadcast.
HOT = 1024
#: Sketches for 0.8 of Jaccard: words of a shingle, 64-bit words of a sketch, and the most differing bits of a link. Of 256 bits
#: 39 differ in the mean at a Jaccard of 0.8, with a deviation of 6, 49 at 0.7 and 59 at 0.6.
SHINGLE, SKETCH, DISTANCE = 5, 4, 44
#: Sketches of a pair of tiles, tiles that smaller tables are dealt out to (of LEAST sketches or more), tasks at most, and rows and columns that are compared at once.
PAIR, TILES, LEAST, MOST_TASKS, ACROSS = 1 << 19, 16, 512, 10_000, (8, 4096)


def _hashes(text: bytes | None, width: int, seed: int) -> Iterator[np.ndarray]:
    """The XXH64 of a text's word shingles, BITS_AT_ONCE at once; none without words."""
    words = (text or b"").lower().split()
    if not words:
        return
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - width + 1)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, BITS_AT_ONCE):
        a, b = starts[at : min(n, at + BITS_AT_ONCE)].tolist(), ends[min(width, len(words)) - 1 :][at : at + BITS_AT_ONCE].tolist()
        yield np.array([digest(line[i:j], seed) for i, j in zip(a, b, strict=False)], np.uint64)


def _ones(h: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set."""
    return np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def simhash(text: bytes | None, width: int = WIDTH, seed: int = SEED) -> int:
    """Unsigned 64-bit fingerprint of UTF-8 text: a bit is 1 if set in over half the XXH64 of its word shingles."""
    ones, n = np.zeros(64, np.int64), 0
    for h in _hashes(text, width, seed):
        ones += _ones(h)
        n += len(h)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def sketch(text: bytes | None, width: int = SHINGLE, seed: int = SEED) -> bytes:
    """SKETCH * 64 bits of UTF-8 text: a bit is 1 if set in over half the hashes of its distinct word shingles. The first 64 are of their XXH64, the
    others of numbers mixed from these (the finalizer of SplitMix64)."""
    found = list(_hashes(text, width, seed))
    h = np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64)
    ones = np.zeros((SKETCH, 64), np.int64)
    for at in range(0, len(h), BITS_AT_ONCE):
        some = h[at : at + BITS_AT_ONCE]
        for k in range(SKETCH):
            x = some
            if k:
                x = some + np.uint64(0x9E3779B97F4A7C15 * k % (1 << 64))
                x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
                x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                x = x ^ (x >> np.uint64(31))
            ones[k] += _ones(x)
    return np.packbits(2 * ones > len(h), axis=1, bitorder="little").tobytes()


def segments(radius: int) -> list[tuple[int, int]]:
    """First bit and number of bits of each of the fewest segments of which one differs by at most one bit."""
    if not 2 <= radius < 64:
        raise ValueError("the radius must be between 2 and 63")
    ends = [64 * k // (radius // 2 + 1) for k in range(radius // 2 + 2)]
    return [(a, b - a) for a, b in zip(ends, ends[1:], strict=False)]


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """id, fp (the fingerprint as a signed long)."""
    return per_text(df, [id_col], text_col, "fp bigint", lambda texts: [np.array([simhash(t, width) for t in texts], np.uint64).view(np.int64)], as_bytes=True)


def variants(fp: Column, radius: int = RADIUS) -> Column:
    """The 64 index keys of a fingerprint: deleted bit in the upper bits, what is left of its segment below."""
    cuts = segments(radius)
    most = max(n for _, n in cuts)
    return F.array(*(F.shiftrightunsigned(fp, at).bitwiseAND((1 << n) - 1 & ~(1 << bit)).bitwiseOR(F.lit((at + bit) << most)) for at, n in cuts for bit in range(n)))


def _near(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Which rows differ by at most `radius` bits; a fingerprint is a number, a sketch a row of numbers."""
    n = np.bitwise_count(a ^ b)
    return (n if n.ndim == 1 else n.sum(axis=1, dtype=np.int64)) <= radius


def _numbers(column: pa.Array) -> np.ndarray:
    """Fingerprints as unsigned numbers, sketches as rows of them."""
    if not pa.types.is_binary(column.type):
        return column.to_numpy(zero_copy_only=False).view(np.uint64)
    _, ends, data = column.buffers()
    at = np.frombuffer(ends, np.int32)[column.offset]
    return np.frombuffer(data, np.uint8)[at : at + 8 * SKETCH * len(column)].copy().view(np.uint64).reshape(-1, SKETCH)


def _column(fps: np.ndarray) -> pa.Array:
    """What _numbers reads."""
    if fps.ndim == 1:
        return pa.array(fps.view(np.int64))
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(8 * SKETCH), len(fps), [None, pa.py_buffer(fps.tobytes())]).cast(pa.binary())


def reachable(fps: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For distinct fingerprints of one entry: the index of the first member of each one's component."""
    root, left = np.arange(len(fps)), np.arange(len(fps))
    while len(left):
        first, front, left = left[0], [left[0]], left[1:]
        while front and len(left):
            near = _near(fps[left], fps[front.pop()], radius)
            if near.any():
                root[left[near]] = first
                front.extend(left[near].tolist())
                left = left[~near]
    return root


def _links(key: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what is connected within each run of equal keys."""
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(key)])))
    a, b = [], []
    left = np.repeat(sizes <= SMALL, sizes)
    at = np.flatnonzero(left)
    for d in range(1, SMALL):
        at = at[at + d < len(key)]
        at = at[key[at] == key[at + d]]
        if not len(at):
            break
        near = at[_near(fps[at], fps[at + d], radius)]
        a.append(fps[near])
        b.append(fps[near + d])
    for s, n in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
        own = fps[s : s + n]
        root = reachable(own, radius)
        linked = root != np.arange(len(own))
        a.append(own[root[linked]])
        b.append(own[linked])
    none = fps[:0]
    return np.concatenate([*a, none]), np.concatenate([*b, none])


def _link_entries(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Batches ordered by entry. Holds ROWS rows and the last entry."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def made(whole: bool) -> Iterator[pa.RecordBatch]:
        key, fps = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        end = len(key) if whole else int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0
        held.append((key[end:], fps[end:]))
        if end:
            a, b = _links(key[:end], fps[:end], radius)
            if len(a):
                pairs = np.unique(np.hstack((a.reshape(len(a), -1), b.reshape(len(b), -1))), axis=0)
                ends = (np.ascontiguousarray(x).reshape(-1, *a.shape[1:]) for x in np.hsplit(pairs, 2))
                yield pa.RecordBatch.from_arrays([_column(x) for x in ends], names=["a", "b"])

    rows = 0
    for batch in batches:
        held.append((batch.column(0).to_numpy(zero_copy_only=False), _numbers(batch.column(1))))
        rows += batch.num_rows
        if rows >= ROWS:
            yield from made(False)
            rows = 0
    if held:
        yield from made(True)


def _links_of(index: DataFrame, block: int, radius: int) -> DataFrame:
    """Edges a, b between fingerprints of an index (columns fp, key) that connect all that links within its entries connect."""
    linked, schema = partial(_link_entries, radius=radius), ", ".join(f"{c} {column_type(index, 'fp')}" for c in "ab")
    index = index.select("*", F.count(F.lit(1)).over(Window.partitionBy("key")).alias("m"))
    usual = index.where(F.col("m").between(2, block)).sortWithinPartitions("key").select("key", "fp").mapInArrow(linked, schema)
    parts = F.ceil(F.col("m") / (block // 2)).cast("int")
    large = index.where(F.col("m") > block).select("key", "fp", F.pmod(F.xxhash64("fp"), parts).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("j"))
    pair = F.xxhash64("key", F.least("i", "j"), F.greatest("i", "j")).alias("key")  # should two entries meet in one number, they are verified alike
    return usual.union(large.select(pair, "fp").repartition("key").sortWithinPartitions("key").mapInArrow(linked, schema))


def links(fps: DataFrame, block: int = BLOCK, radius: int = RADIUS) -> DataFrame:
    """Edges a, b between distinct fingerprints (column fp) that connect all that a chain of links connects."""
    return _links_of(fps.select("fp", F.explode(variants(F.col("fp"), radius)).alias("key")), block, radius)


def _roots(parent: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The roots of these members, which they then point to."""
    root = parent[at]
    while len(up := parent[root]) and (up != root).any():
        root = up
    parent[at] = root
    return root


def tile_roots(a: np.ndarray, b: np.ndarray | None, distance: int) -> np.ndarray:
    """Of the sketches of a and then b: the index of the first member of each one's component, by links between a and b, or within a where b is None.

    Half of the bits are compared first; few pairs are left of which the rest is."""
    left, right = (a, a) if b is None else (a, b)
    shift = 0 if b is None else len(a)
    parent, half = np.arange(shift + len(right)), SKETCH // 2
    rows, columns = ([np.ascontiguousarray(x[:, k]) for k in range(half)] for x in (left, right))
    most, across = ACROSS
    for j in range(0, len(right), across):
        for i in range(0, min(len(left), j + across) if b is None else len(left), most):
            n = np.bitwise_count(rows[0][i : i + most, None] ^ columns[0][j : j + across])
            for k in range(1, half):
                n += np.bitwise_count(rows[k][i : i + most, None] ^ columns[k][j : j + across])
            if not (near := n <= distance).any():
                continue
            x, y = np.nonzero(near)
            x, y = x + i, y + j
            close = _near(left[x], right[y], distance)
            x, y = x[close], y[close] + shift
            while True:
                p, q = _roots(parent, x), _roots(parent, y)
                if not (apart := p != q).any():
                    break
                parent[np.maximum(p, q)[apart]] = np.minimum(p, q)[apart]  # of several the last holds; the others are met in the next round
                x, y = x[apart], y[apart]
    return _roots(parent, np.arange(len(parent)))


def _link_tiles(batches: Iterator[pa.RecordBatch], tiles: int, distance: int) -> Iterator[pa.RecordBatch]:
    """Batches (key, second, fp) ordered by key, a pair of tiles each; second tells the tile. Holds one pair."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def made(key: int) -> Iterator[pa.RecordBatch]:
        second, fps = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        a, b = fps[~second], fps[second]
        root = tile_roots(a, None if key // tiles == key % tiles else b, distance)
        both = np.concatenate((a, b))
        linked = np.flatnonzero(root != np.arange(len(both)))
        for at in range(0, len(linked), ROWS):
            some = linked[at : at + ROWS]
            yield pa.RecordBatch.from_arrays([_column(both[root[some]]), _column(both[some])], names=["a", "b"])

    last = None
    for batch in batches:
        key, second, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False), _numbers(batch.column(2))
        cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        for at, end in zip(cuts, cuts[1:], strict=False):
            if at == end:
                continue
            if held and key[at] != last:
                yield from made(last)
            last = int(key[at])
            held.append((second[at:end], fps[at:end]))
    if held:
        yield from made(last)
    settle()


def sketch_links(fps: DataFrame, block: int = PAIR, distance: int = DISTANCE) -> DataFrame:
    """As links, of sketches: edges a, b that connect all that pairs of at most `distance` differing bits connect. A pair of tiles has about `block` sketches at most."""
    n = fps.count()
    tiles = max(1, -(-2 * n // block), min(TILES, n // LEAST))
    dealt = fps.select("fp", F.pmod(F.xxhash64("fp"), F.lit(tiles)).alias("i")).select("fp", "i", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("j"))
    pairs = dealt.select((F.least("i", "j") * tiles + F.greatest("i", "j")).alias("key"), (F.col("i") > F.col("j")).alias("second"), "fp")
    shared = pairs.repartition(min(tiles * (tiles + 1) // 2, MOST_TASKS), "key").sortWithinPartitions("key")
    return shared.mapInArrow(partial(_link_tiles, tiles=tiles, distance=distance), "a binary, b binary")


def _with_component(rows: DataFrame, id_col: str, linked: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """rows (id, fp) and component_id, where `linked` gives the edges between distinct fp."""
    groups = cut(rows.groupBy("fp").agg(F.min(id_col).alias("_first"), F.count(F.lit(1)).alias("_n")))
    roots = cut(connected_components(linked(groups.select("fp"))).withColumnRenamed("node", "fp"))
    rooted = groups.join(roots, "fp")
    firsts = rooted.groupBy("root").agg(F.min("_first").alias("_reach"))
    reach = cut(roots.join(cut(firsts), "root").select("fp", "_reach"))
    classes = cut(groups.join(reach, "fp", "left").select("fp", F.coalesce("_reach", "_first").alias("component_id"), "_n"))
    frequent = classes.where(F.col("_n") * HOT > (groups.agg(F.sum("_n")).first()[0] or 0)).drop("_n")  # fewer than HOT rows: each has over a HOT-th of all
    usual = rows.join(F.broadcast(frequent), "fp", "left_anti").join(classes.drop("_n"), "fp")
    return rows.join(F.broadcast(frequent), "fp").unionByName(usual)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """One row per row of df: id, fingerprint (16 hex digits), component_id. Shingles have `width` words, linked fingerprints differ by
    at most `radius` bits. A larger radius has shorter segments, so that entries of the index are larger."""
    rows = _with_component(cut(fingerprints(df, id_col, text_col, width)), id_col, partial(links, radius=radius))
    return rows.select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def similar_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row per row of df: id, sketch (64 hex digits), component_id. Linked are texts whose sketches differ by at most `distance` bits."""
    rows = cut(per_text(df, [id_col], text_col, "fp binary", lambda texts: [pa.array([sketch(t, width) for t in texts], pa.binary())], as_bytes=True))
    return _with_component(rows, id_col, partial(sketch_links, distance=distance)).select(id_col, F.lower(F.hex("fp")).alias("sketch"), "component_id")


def _first_of_each(df: DataFrame, members: DataFrame, id_col: str) -> DataFrame:
    """The rows of df whose id is the smallest of their component; rows with a null id stay, rows of one id go together.

    Ids that go are joined away; they are unique, so no key is hot. They are written to a table first, so that Spark knows their size: few of them
    are broadcast by it and no text is shuffled, many are joined by a shuffle."""
    folder = new_folder(df.sparkSession, "near-duplicates")
    members.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("_gone")).distinct().write.parquet(folder)
    gone = df.sparkSession.read.parquet(folder)
    return df.join(gone, df[id_col] == gone["_gone"], "left_anti")


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """The rows whose id is the smallest of their component in near_duplicates, with all columns of df."""
    return _first_of_each(df, near_duplicates(df, id_col, text_col, width, radius), id_col)


def drop_similar_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows whose id is the smallest of their component in similar_texts, with all columns of df."""
    return _first_of_each(df, similar_texts(df, id_col, text_col, width, distance), id_col)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


SQL = None
