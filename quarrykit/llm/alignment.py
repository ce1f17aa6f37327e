"""Cross-tokenizer alignment by a monoid of fragments.

Tokens of two tokenizers cut the same bytes; where both have an end, a group closes. A fragment is what a range of bytes tells: the tokens before the range's first common end
(open prefix), the groups between common ends (closed), the tokens behind the last one (open suffix); a range without a common end is one open run. To join two
fragments, the left one's suffix and the right one's prefix become one closed group, or one run where either has no common end; that is associative, and the empty
run is its unit.

Texts over CHUNK bytes are cut into ranges of about CHUNK bytes that Spark deals out; each range gives its fragments, which a tree joins level by level, FAN
ranges of bytes at a time. Only the open edges travel up the tree: closed groups, and the bridge groups that a join closes, stay rows of their own with their place in the text, and
are put in order only to be digested. Text is cut for encoding before a blank between two other characters, where neither tokenizer merges; a stretch without such a place
is encoded in one piece and gives several fragments. Shorter texts are one range each, many of them aligned at once. As the ends cut the bytes into spans that one
A and one B token share, links are counted as ends, never by comparing tokens.

The links of the corpus are counted by pair with partial sums. Pairs with more than one link in HOT are fewer than HOT, so they are broadcast with their count; links of the
others get theirs by a join.

Defined results: texts that are null, empty, or that a tokenizer doesn't give back byte for byte have no tokens, zeros and '' (U+2581 is a blank to the piece tokenizer, for one),
and count nowhere; rows that repeat an id are texts of their own; bytes that aren't UTF-8 are read as U+FFFD; an empty table gives no rows; columns other than id and text aren't read."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column_type, cut, documents, new_folder, remove, slices, texts_of
from .units import Units, byte_letters, flattened, plain_byte_units, special_strings, tokenizer, words_behind

#: Bytes of a range, ranges that a join of the tree takes, and the share of all links (one in HOT) that makes a pair frequent.
CHUNK, FAN, HOT = 64 << 10, 32, 1 << 18
#: Units that a worker holds of each side, texts of a slice, and rows of pairs looked up at once.
UNITS, BYTES, ROWS = 100_000, 3 << 20, 1024
#: A blank before which neither tokenizer merges. Python's \s has all that is white space to them.
SAFE = re.compile(r"(?<=\S) (?=\S)")


@lru_cache(2)
def piece_encoder(path: str) -> Callable[[list[str]], list[list[int]]]:
    """Ids of units by a byte-pair model of pieces, in which blanks begin pieces. A unit that begins with a blank is encoded without it, since the library adds one; another one behind a line
    end, which is a byte of its own to such a model."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    if any(re.search("[^▁]▁", p) or "\n" in p for p in pieces) or model.encode("\nx")[:2] != [model.piece_to_id("▁"), model.piece_to_id("<0x0A>")]:
        raise ValueError(f"{path} merges over blanks or line ends")
    blank = [model.piece_to_id("▁")]

    def encode(units: list[str]) -> list[list[int]]:
        ids = model.encode([u[1:] if u[:1] == " " else "\n" + u for u in units], num_threads=1)
        return [blank if u == " " else i if u[:1] == " " else i[2:] for u, i in zip(units, ids, strict=True)]  # nothing has no blank added

    return encode


#: Added to ids of B where both sides' ids are in one array.
OF_B = 1 << 24


@lru_cache(1)
def both_units(a_path: str, b_path: str) -> Units:
    """Units with the ids of both sides, A's first, so that each is cut, looked up and held once."""
    a, b = plain_byte_units(a_path).encode, piece_encoder(b_path)

    def encode(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        (ids_a, n_a), (ids_b, n_b) = flattened(a(units)), flattened(b(units))
        sizes = n_a + n_b
        flat, start = np.empty(int(sizes.sum()), np.uint32), np.cumsum(sizes) - sizes
        flat[np.repeat(start - (np.cumsum(n_a) - n_a), n_a) + np.arange(len(ids_a))] = ids_a
        flat[np.repeat(start + n_a - (np.cumsum(n_b) - n_b), n_b) + np.arange(len(ids_b))] = ids_b + np.uint32(OF_B)
        return flat, sizes

    return Units(words_behind, encode, None, UNITS)


@dataclass(frozen=True)
class Side:
    """One tokenizer: the bytes of all ids, where each id's begin, and their number; each id's decimal text with a comma, and with the mark that ends
    this side's part of a group, as numbers whose bytes that aren't zero are the text."""

    flat: np.ndarray
    start: np.ndarray
    size: np.ndarray
    written: tuple[np.ndarray, np.ndarray]
    digits: np.ndarray


def _side(bytes_of: list[bytes], after: str) -> Side:
    size = np.array([len(b) for b in bytes_of], np.int64)
    written = tuple(np.frombuffer(b"".join(f"{i}{mark}".encode().ljust(8, b"\0") for i in range(len(bytes_of))), np.uint64) for mark in (",", after))
    return Side(np.frombuffer(b"".join(bytes_of), np.uint8), np.cumsum(size) - size, size, written, np.array([len(str(i)) + 1 for i in range(len(bytes_of))], np.int64))


@lru_cache(2)
def byte_side(path: str) -> Side:
    tok, byte = tokenizer(path), {c: b for b, c in enumerate(byte_letters())}
    special = special_strings(path)
    vocabulary = tok.get_vocab(with_added_tokens=True)
    bytes_of = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        bytes_of[i] = token.encode() if special and special.fullmatch(token) else bytes(byte[c] for c in token)
    return _side(bytes_of, "|")


@lru_cache(2)
def piece_side(path: str) -> Side:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    one = lambda i: bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
    return _side([one(i) for i in range(model.get_piece_size())], ";")


@dataclass
class Run:
    """Tokens of both sides in order."""

    a: np.ndarray
    b: np.ndarray

    def __add__(self, other: Run) -> Run:
        return Run(np.concatenate((self.a, other.a)), np.concatenate((self.b, other.b)))


NONE = Run(np.empty(0, np.int64), np.empty(0, np.int64))


@dataclass
class Fragment:
    """What a range of bytes tells. `closed` is whether it has a common end; if not, all is in `prefix`. The groups in the middle are kept elsewhere."""

    prefix: Run
    closed: bool
    suffix: Run


def join(left: Fragment, right: Fragment) -> tuple[Fragment, Run | None]:
    """The fragment of both ranges, and the group that their meeting closes, if it does; the group is empty where nothing was open."""
    if not left.closed:
        return Fragment(left.prefix + right.prefix, right.closed, right.suffix), None
    if not right.closed:
        return Fragment(left.prefix, True, left.suffix + right.prefix), None
    return Fragment(left.prefix, True, right.suffix), left.suffix + right.prefix


@dataclass(frozen=True)
class Pairs:
    """Pairs as numbers: A's id in the upper bits, B's in the lower `bits`; of four bytes where both vocabularies fit."""

    bits: int
    sql: str
    arrow: pa.DataType


def pairs_as(a: Side, b: Side) -> Pairs:
    bits_a, bits_b = ((len(side.size) - 1).bit_length() for side in (a, b))
    return Pairs(bits_b, *(("int", pa.int32()) if bits_a + bits_b <= 31 else ("bigint", pa.int64())))


def ends_of(side: Side, ids: np.ndarray) -> np.ndarray:
    return np.cumsum(side.size[ids])


class Ends:
    """Where the tokens of a run end, by bytes. Both sides of the run have the same bytes."""

    def __init__(self, a: Side, b: Side, run: Run) -> None:
        self.a, self.b, self.run = a, b, run
        self.at_a, self.at_b = ends_of(a, run.a), ends_of(b, run.b)
        n = int(self.at_a[-1]) + 1 if len(self.at_a) else 1
        self.is_a, self.is_b = np.zeros(n, bool), np.zeros(n, bool)
        self.is_a[self.at_a] = True
        self.is_b[self.at_b] = True
        self.upto_a, self.upto_b = np.cumsum(self.is_a, dtype=np.int32), np.cumsum(self.is_b, dtype=np.int32)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """The pairs (numbers) whose byte ranges overlap, in order, and where each one's span ends: one for each span between ends of either side."""
        ends = np.flatnonzero(self.is_a | self.is_b)
        before = lambda upto, there: upto[ends] - there[ends]
        return (self.run.a[before(self.upto_a, self.is_a)] << pairs_as(self.a, self.b).bits) | self.run.b[before(self.upto_b, self.is_b)], ends

    def written(self) -> tuple[bytes, np.ndarray]:
        """The groups as a1,a2|b1;... with ';' behind each, and the number of letters up to each token in the order of writing (0 first)."""
        common = self.is_a & self.is_b
        upto, at = np.cumsum(common, dtype=np.int32), np.flatnonzero(common)
        group = lambda ends: upto[ends] - common[ends]
        before_b = np.concatenate(([0], self.upto_b[at]))[group(self.at_a)]  # tokens of B in earlier groups
        before_a = self.upto_a[at][group(self.at_b)]
        place_a, place_b = np.arange(len(self.at_a)) + before_b, np.arange(len(self.at_b)) + before_a
        words, sizes = np.zeros(len(self.at_a) + len(self.at_b), np.uint64), np.zeros(len(self.at_a) + len(self.at_b) + 1, np.int64)
        for side, ids, ends, place in ((self.a, self.run.a, self.at_a, place_a), (self.b, self.run.b, self.at_b, place_b)):
            words[place] = np.where(common[ends], side.written[1][ids], side.written[0][ids])
            sizes[place + 1] = side.digits[ids]
        letters = words.view(np.uint8)
        return letters[letters != 0].tobytes(), np.cumsum(sizes)


def links_of(a: Side, b: Side, run: Run) -> np.ndarray:
    return Ends(a, b, run).links()[0]


def _wrong(side: Side, ids: np.ndarray, tokens: np.ndarray, raw: list[bytes]) -> np.ndarray:
    """Which texts (their bytes, the number of their tokens) aren't the joined bytes of their tokens."""
    size, of = side.size[ids], np.repeat(np.arange(len(raw)), tokens)
    given = np.bincount(of, size, len(raw)).astype(np.int64)
    wrong = given != np.fromiter(map(len, raw), np.int64, len(raw))
    use = ~wrong[of]
    size, ids = size[use], ids[use]
    ends = np.cumsum(size)
    joined = side.flat[np.repeat(side.start[ids] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
    differs = joined != np.frombuffer(b"".join(r for r, w in zip(raw, wrong.tolist(), strict=True) if not w), np.uint8)
    if differs.any():
        wrong[np.repeat(np.arange(len(raw)), np.where(wrong, 0, given))[differs]] = True
    return wrong


def tokens_of(units: Units, a: Side, b: Side, texts: list[str]) -> tuple[Run, np.ndarray, np.ndarray, np.ndarray]:
    """The tokens of texts (which begin with a blank) in one run, without those of texts whose bytes a side doesn't give back; of each text the numbers of A and B tokens and of bytes."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    both, ends = units.ids(texts)
    is_b = both >= OF_B
    upto = np.concatenate(([0], np.cumsum(is_b)))[np.concatenate(([0], ends))]
    n_b = np.diff(upto)
    n_a = np.diff(np.concatenate(([0], ends))) - n_b
    run = Run(both[~is_b].astype(np.int64), both[is_b].astype(np.int64) - OF_B)
    wrong = _wrong(a, run.a, n_a, raw) | _wrong(b, run.b, n_b, raw)
    if wrong.any():
        run, n_a, n_b = Run(run.a[np.repeat(~wrong, n_a)], run.b[np.repeat(~wrong, n_b)]), np.where(wrong, 0, n_a), np.where(wrong, 0, n_b)
    return run, n_a, n_b, np.where(wrong, 0, np.fromiter(map(len, raw), np.int64, len(raw)))


def fragments(a: Side, b: Side, run: Run, chunk: int = CHUNK) -> Iterator[tuple[int, Fragment, Run]]:
    """The run by ranges of about chunk bytes, tokens under the range of their end: first byte of the range, fragment, closed groups as a run."""
    at_a, at_b = ends_of(a, run.a), ends_of(b, run.b)
    total = int(at_a[-1]) if len(at_a) else 0
    for start in range(0, total, chunk):
        lo_a, hi_a = np.searchsorted(at_a, (start, start + chunk), "right")
        lo_b, hi_b = np.searchsorted(at_b, (start, start + chunk), "right")
        ids_a, ids_b = run.a[lo_a:hi_a], run.b[lo_b:hi_b]
        common = np.intersect1d(at_a[lo_a:hi_a], at_b[lo_b:hi_b], assume_unique=True)
        if not len(common):
            yield start, Fragment(Run(ids_a, ids_b), False, NONE), NONE
            continue
        cuts_a, cuts_b = (np.searchsorted(x, common[[0, -1]]) + 1 for x in (at_a[lo_a:hi_a], at_b[lo_b:hi_b]))
        yield start, Fragment(Run(ids_a[: cuts_a[0]], ids_b[: cuts_b[0]]), True, Run(ids_a[cuts_a[1] :], ids_b[cuts_b[1] :])), Run(ids_a[cuts_a[0] : cuts_a[1]], ids_b[cuts_b[0] : cuts_b[1]])


def ranges(text: str, chunk: int = CHUNK) -> Iterator[tuple[int, str]]:
    """First byte and text of pieces of at least chunk code points (the last may be shorter), cut at safe places."""
    begin = byte = 0
    while begin < len(text):
        found = SAFE.search(text, begin + chunk) if begin + chunk < len(text) else None
        end = found.start() if found else len(text)
        piece = text[begin:end]
        yield byte, piece
        byte += len(piece.encode("utf-8", "surrogatepass"))
        begin = end


def _lists(runs: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column of arrays."""
    ends = np.concatenate(([0], np.cumsum([len(r) for r in runs])))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(runs) if runs else np.empty(0, np.int64)).cast(kind))


#: What is known of a whole text before counts of pairs are.
WHOLE = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"


def _whole(a_path: str, b_path: str, batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Texts of one range each: id, text to id and WHOLE. As texts begin and end with common ends, all of a slice are aligned at once."""
    units, a, b = both_units(a_path, b_path), byte_side(a_path), piece_side(b_path)
    kind = pairs_as(a, b).arrow
    for batch in slices(batches, most=BYTES):
        run, n_a, n_b, size = tokens_of(units, a, b, [" " + t if t else "" for t in texts_of(batch.column(1))])
        ends = Ends(a, b, run)
        pairs, at = ends.links()
        letters, upto = ends.written()
        bounds = np.concatenate(([0], np.cumsum(size)))
        links = np.searchsorted(at, bounds, "right")
        cuts = upto[np.concatenate(([0], np.cumsum(n_a + n_b)))].tolist()
        shas = [hashlib.sha256(letters[i : j - 1]).hexdigest() if j > i else "" for i, j in zip(cuts, cuts[1:], strict=False)]
        n_links = np.diff(links)
        # every end of either side is an end of a link, and a common one an end of both
        columns = [pa.array(x, pa.int64()) for x in (n_a, n_b, n_a + n_b - n_links, n_links)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array(shas, pa.string()), pa.ListArray.from_arrays(pa.array(links, pa.int32()), pa.array(pairs, kind))], names=names)


#: A row of a long text: the place of its range; a fragment's edges (tree) or groups that are closed (text of groups, their number, pairs).
PART = "key bigint, at bigint, level int, closed boolean, bad boolean, prefix_a array<int>, prefix_b array<int>, suffix_a array<int>, suffix_b array<int>, groups string, n_a bigint, n_b bigint, n_groups bigint"
PART_NAMES = [*(x.split()[0] for x in PART.split(", ")), "pairs"]


def _edge(key: int, at: int, level: int, f: Fragment, bad: bool) -> tuple:
    return (key, at, level, f.closed, bad, f.prefix.a, f.prefix.b, f.suffix.a, f.suffix.b, None, 0, 0, 0, NONE.a)


def _closed(key: int, at: int, a: Side, b: Side, run: Run) -> tuple:
    """Closed groups as a row; level is null. Their place: twice a range's first byte for the group that its prefix closes, one more for those within, -1 for the first of all."""
    ends = Ends(a, b, run)
    pairs = ends.links()[0]
    return (key, at, None, None, False, NONE.a, NONE.a, NONE.a, NONE.a, ends.written()[0].decode(), len(run.a), len(run.b), len(run.a) + len(run.b) - len(pairs), pairs)


def _rows(rows: list[tuple], pairs: pa.DataType) -> pa.RecordBatch:
    by = list(zip(*rows, strict=True))
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), *[pa.int32()] * 4, pa.string(), pa.int64(), pa.int64(), pa.int64(), pairs]
    return pa.RecordBatch.from_arrays([_lists(list(c), k) if n.endswith(("_a", "_b")) and n[0] in "ps" or n == "pairs" else pa.array(c, k) for n, c, k in zip(PART_NAMES, by, kinds, strict=True)], names=PART_NAMES)


def _fragment_rows(a_path: str, b_path: str, batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.RecordBatch]:
    """Pieces (key, first byte, text) of long texts to the rows of their ranges."""
    units, a, b = both_units(a_path, b_path), byte_side(a_path), piece_side(b_path)
    kind = pairs_as(a, b).arrow
    for batch in slices(batches, 64):
        keys, ats, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_of(batch.column(2))
        for key, first, text in zip(keys, ats, texts, strict=True):
            run, *_, size = tokens_of(units, a, b, [text])
            if not size[0]:
                yield _rows([_edge(key, first, 0, Fragment(NONE, False, NONE), True)], kind)
                continue
            for start, edge, closed in fragments(a, b, run, 2 * chunk):
                made = [_edge(key, first + start, 0, edge, False)]
                if len(closed.a):
                    made.append(_closed(key, 2 * (first + start) + 1, a, b, closed))
                yield _rows(made, kind)


def _join_rows(a_path: str, b_path: str, batches: Iterator[pa.RecordBatch], level: int, width: int) -> Iterator[pa.RecordBatch]:
    """Edges ordered by key and place: those of one range of `width` bytes are joined to one edge; groups that close are rows."""
    a, b = byte_side(a_path), piece_side(b_path)
    kind = pairs_as(a, b).arrow

    def read() -> Iterator[tuple]:
        for batch in batches:
            columns = [batch.column(k) for k in range(8)]
            flat = [(c.values.to_numpy(zero_copy_only=False).astype(np.int64), c.offsets.to_numpy()) for c in columns[4:]]
            for n, (key, at, closed, bad) in enumerate(zip(*(c.to_pylist() for c in columns[:4]), strict=True)):
                runs = [v[o[n] : o[n + 1]] for v, o in flat]
                yield key, at, Fragment(Run(runs[0], runs[1]), closed, Run(runs[2], runs[3])), bad

    for (key, _), some in groupby(read(), lambda r: (r[0], r[1] // width)):
        made, first, whole, any_bad = [], None, Fragment(NONE, False, NONE), False
        for _, at, edge, bad in some:
            first, any_bad = at if first is None else first, any_bad or bad
            whole, bridge = join(whole, edge)
            if bridge is not None and len(bridge.a) and not any_bad:
                made.append(_closed(key, 2 * at, a, b, bridge))
        yield _rows([*made, _edge(key, first, level, whole, any_bad)], kind)


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of closed groups ordered by key and place: one digest a key."""
    key, sha, first = None, None, True
    for batch in batches:
        out: list[tuple[int, str]] = []
        for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if k != key:
                if key is not None:
                    out.append((key, sha.hexdigest()))
                key, sha, first = k, hashlib.sha256(), True
            sha.update((("" if first else ";") + text[:-1]).encode())
            first = False
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int64()), pa.array([s for _, s in out], pa.string())], names=["key", "groups_sha256"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([sha.hexdigest()], pa.string())], names=["key", "groups_sha256"])


def _long_texts(long: DataFrame, a_path: str, b_path: str, chunk: int, pairs: Pairs) -> tuple[DataFrame, DataFrame]:
    """Of texts over one range (key, text): key and WHOLE without pairs, and rows key, pairs."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            for key, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                for at, piece in ranges(" " + text, chunk):
                    yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([at], pa.int64()), pa.array([piece], pa.string())], names=["key", "at", "text"])

    schema = f"{PART}, pairs array<{pairs.sql}>"
    cuts = long.mapInArrow(pieces, "key bigint, at bigint, text string").repartition("key", "at")
    made = cut(cuts.mapInArrow(lambda x: _fragment_rows(a_path, b_path, x, chunk), schema))
    edges, closed, level, width = made.where("level IS NOT NULL"), [made.where("level IS NULL")], 0, chunk
    reach = made.agg(F.max("at")).first()[0] or 0
    while True:  # at least once, so that the last one's prefix closes
        level, width = level + 1, width * FAN
        deal = edges.select("key", "at", "closed", "bad", "prefix_a", "prefix_b", "suffix_a", "suffix_b").repartition("key", F.floor(F.col("at") / width)).sortWithinPartitions("key", "at")
        joined = cut(deal.mapInArrow(lambda x, n=level, w=width: _join_rows(a_path, b_path, x, n, w), schema))
        edges, closed = joined.where("level IS NOT NULL"), [*closed, joined.where("level IS NULL")]
        if width > reach:
            break
    # one edge a key is left: its prefix is the first group, and nothing is open behind the text's last byte

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_side(a_path), piece_side(b_path)
        kind = pairs_as(a, b).arrow
        for batch in batches:
            rows = [_closed(key, -1, a, b, Run(np.array(x, np.int64), np.array(y, np.int64))) for key, x, y in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)]
            if rows:
                yield _rows(rows, kind)

    good = edges.where("NOT bad")
    groups = good.select("key", "prefix_a", "prefix_b").mapInArrow(firsts, schema)
    for part in closed:
        groups = groups.unionByName(part)
    groups = cut(groups.join(good.select("key"), "key", "left_semi"))
    shas = groups.select("key", "groups", "at").repartition("key").sortWithinPartitions("key", "at").select("key", "groups").mapInArrow(_digest_rows, "key bigint, groups_sha256 string")
    sums = groups.groupBy("key").agg(*(F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups")), F.sum(F.size("pairs")).cast("bigint").alias("n_links"))
    return sums.join(shas, "key"), groups.select("key", "pairs")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a task's rows with their number of links, in slices."""
    for batch in slices(batches, ROWS):
        pair, n = np.unique(batch.column(0).flatten().to_numpy(zero_copy_only=False), return_counts=True)  # as long, so that counts of all kinds are joined alike
        yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int64()), pa.array(n, pa.int64())], names=["pair", "n"])


def pair_counts(pairs: DataFrame, bits: int) -> DataFrame:
    """pair, n, best: all pairs of the rows' lists with their number, and whether it is the highest of the pair's B id."""
    counts = cut(pairs.mapInArrow(_counted, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")))
    b = F.col("pair").bitwiseAND((1 << bits) - 1)
    most = counts.groupBy(b.alias("_b")).agg(F.max("n").alias("_most"))
    return counts.join(most, b == F.col("_b")).select("pair", "n", (F.col("n") == F.col("_most")).alias("best"))


def _looked_up(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """rows with n_best and count_sum of their frequent pairs instead of pairs, and `rare`, the others."""
    links = counts.agg(F.sum("n")).first()[0] or 0
    frequent = sorted((r[0], r[1], r[2]) for r in counts.where(F.col("n") * HOT > links).collect())  # fewer than HOT rows
    known = rows.sparkSession.sparkContext.broadcast(tuple(np.array(x, np.int64) for x in zip(*frequent, strict=True)) if frequent else (np.empty(0, np.int64),) * 3)
    others = [c for c in rows.columns if c != "pairs"]
    names = [*others, "n_best", "count_sum", "rare"]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = known.value
        for batch in slices(batches, ROWS):
            column = batch.column(len(others))
            found, sizes = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), sizes)
            at = np.minimum(np.searchsorted(pair, found), max(0, len(pair) - 1))
            hit = pair[at] == found if len(pair) else np.zeros(len(found), bool)
            total, tops = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(total, row[hit], n[at[hit]])
            np.add.at(tops, row[hit], best[at[hit]])
            ends = pa.array(np.concatenate(([0], np.cumsum(np.bincount(row[~hit], minlength=batch.num_rows)))), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], pa.array(tops), pa.array(total), pa.ListArray.from_arrays(ends, pa.array(found[~hit].astype(np.int64)))], names=names)

    schema = ", ".join(f"`{c}` {column_type(rows, c)}" for c in others)
    return rows.select(*others, "pairs").mapInArrow(look, f"{schema}, n_best bigint, count_sum bigint, rare array<bigint>")


def align(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of df."""
    numbered = df.select(F.monotonically_increasing_id().alias("key"), df[id_col].alias("_id"), df[text_col].alias("text"))
    long_text, columns = F.octet_length("text") > chunk, [*(x.split()[0] for x in WHOLE.split(", ")), "pairs"]
    as_numbers = pairs_as(byte_side(a_path), piece_side(b_path))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # key and id travel as one struct beside the text
        for made in _whole(a_path, b_path, batches, ["own", *columns]):
            yield pa.RecordBatch.from_arrays([*made.column(0).flatten(), *made.columns[1:]], names=["key", "_id", *columns])

    # a long text is a row here that counts nothing, so that keys are drawn once
    short = numbered.select(F.struct("key", "_id").alias("own"), F.when(~long_text, F.col("text")).alias("text"))
    folder = new_folder(df.sparkSession, "links")
    put = short.mapInArrow(whole, f"key bigint, _id {column_type(df, id_col)}, {WHOLE}, pairs array<{as_numbers.sql}>").write.option("compression", "zstd").option("parquet.dictionary.page.size", 8 << 20)
    put.parquet(folder)
    sums, parts = _long_texts(numbered.where(long_text).select("key", "text"), a_path, b_path, chunk, as_numbers)
    sums = cut(sums.select("key", *(F.col(c).alias(f"_{c}") for c in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256"))))
    rows = df.sparkSession.read.parquet(folder).withColumn("part", F.lit(False)).unionByName(parts.withColumn("part", F.lit(True)), allowMissingColumns=True)
    counts = cut(pair_counts(rows.select("pairs"), as_numbers.bits))
    looked = cut(_looked_up(rows, counts))
    remove(df.sparkSession, folder)
    rare = looked.select("key", F.explode("rare").alias("pair")).groupBy("key", "pair").agg(F.count(F.lit(1)).alias("times")).join(counts, "pair")
    more = rare.select("key", F.when(F.col("best"), F.col("times")).otherwise(0).alias("_best"), (F.col("times") * F.col("n")).alias("_sum"))
    more = more.unionByName(looked.where("part").select("key", F.col("n_best").alias("_best"), F.col("count_sum").alias("_sum"))).groupBy("key").agg(F.sum("_best").alias("_best"), F.sum("_sum").alias("_sum"))
    found = looked.where("NOT part").join(sums, "key", "left").join(more, "key", "left")
    either = lambda c: F.coalesce(f"_{c}", c).alias(c)
    both = lambda c, more: (F.col(c) + F.coalesce(more, F.lit(0))).alias(c)
    return found.select(F.col("_id").alias(id_col), *(either(c) for c in ("n_a", "n_b", "n_groups", "n_links")), both("n_best", "_best"), both("count_sum", "_sum"), either("groups_sha256"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return align(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
