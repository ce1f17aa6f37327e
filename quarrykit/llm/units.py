"""Encoding of texts by way of their white-space units, each encoded once for as long as it is held.

Public byte-pair tokenizers hardly ever merge across white space, so a text's ids are those of its units in order; where a tokenizer's vocabulary has such
tokens, or a probe disagrees, a text is one unit. The units of a batch
become places in one flat array of ids by a dictionary, and the ids of all its texts are gathered at once. Texts whose only white space are
single blanks and line ends are cut and dictionary-encoded by Arrow, so that Python meets each unit once a batch; others go
through a pattern. A store that holds more than
`most` units, or MOST_IDS ids, lets go of those met least, so memory is bounded whatever the vocabulary of the texts."""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: White space as Unicode lists it. Fixed values.
WHITE = "\t-\r \x85\xa0  -     　"
#: Python's split() also splits at these.
OTHER_SPLITS = re.compile("[\x1c-\x1f]")
APART = re.compile(f"[^{WHITE}]+")
#: A unit with the one space before it, and white space that no unit takes.
SPACED = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
#: Texts that Arrow doesn't cut: other white space, runs of it, or the mark that it cuts at.
MARK = "\0"
UNPLAIN = rf"[{WHITE.replace(' ', '').replace(chr(10), '')}\x00\x0b\x0c\x1c-\x1f]|[ \n][ \n]".replace("\t-\r", "\t\r")
MOST_UNITS, MOST_IDS, AT_ONCE, JOINED = 400_000, 6_000_000, 4096, 200


@lru_cache(4)
def tokenizer(path: str) -> Tokenizer:
    """The file's tokenizer, on one thread: a task's core is all that Spark has given it."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def special_strings(path: str) -> re.Pattern | None:
    """The strings that the tokenizer takes out of a text before anything else."""
    words = sorted((t.content for t in tokenizer(path).get_added_tokens_decoder().values()), key=len, reverse=True)
    return re.compile("|".join(map(re.escape, words))) if words else None


def words_apart(text: str) -> list[str]:
    """For tokenizers that drop white space."""
    return APART.findall(text) if OTHER_SPLITS.search(text) else text.split()


def cut_apart(texts: pa.Array) -> pa.ListArray:
    """As words_apart, for plain texts; may give empty units."""
    return pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")


def cut_spaced(texts: pa.Array) -> pa.ListArray:
    """As words_spaced, for plain texts; may give empty units."""
    return pc.split_pattern(pc.replace_substring(pc.replace_substring(texts, " ", MARK + " "), "\n", f"{MARK}\n{MARK}"), MARK)


def words_spaced(text: str) -> list[str]:
    """For tokenizers that join one space to the word after it and keep all others."""
    return SPACED.findall(text)


def words_whole(text: str) -> list[str]:
    """For tokenizers whose tokens may hold white space after other characters: a text is one unit."""
    return [text] if text else []


def cut_whole(texts: pa.Array) -> pa.ListArray:
    return pa.LargeListArray.from_arrays(pa.array(range(len(texts) + 1), pa.int64()), texts)


#: Where a blank or a line end follows a character that isn't white space (to Python, which counts more as such than tokenizers do).
BEHIND = re.compile(r"(?<=\S)(?=[ \n])")


def words_behind(text: str) -> list[str]:
    """For both kinds of tokenizers, those that join one space to the word after it and those whose tokens have blanks only in front: cut only before the white space behind a word."""
    return BEHIND.split(text) if text else []


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself where it is printable, else the next from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = iter(range(256, 512))
    return [chr(b if b in set(shown) else next(hidden)) for b in range(256)]


PROBE = "One two  three\n\nfour\tfive, six.  \n seven-eight 9 10 é\u00a0ü 中文 字 don't STOP\n"


def fitting(split: Callable[[str], list[str]], encode: Callable[[str], list[int]], tok: Tokenizer) -> Callable[[str], list[str]]:
    """The split, if the tokenizer's ids of a text are those of its units: no token has white space after another character, and a probe of
    all kinds of white space agrees. Else whole texts."""
    byte, inner = {c: b for b, c in enumerate(byte_letters())}, re.compile(f"[^{WHITE}][{WHITE}]")
    plain = lambda token: bytes([byte[c] for c in token]).decode("utf-8", "replace") if all(c in byte for c in token) else token.replace("▁", " ")
    crossing = any(inner.search(plain(token)) for token in tok.get_vocab(with_added_tokens=False))
    return words_whole if crossing or encode(PROBE) != [i for u in split(PROBE) for i in encode(u)] else split


class _Places(dict):
    """Unit to place; a new unit gets the next one and is noted."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        self[unit] = n = len(self)
        self.new.append(unit)
        return n


def flattened(ids: list | tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of units one behind the other, and their numbers; ids that come as these two are left alone."""
    if isinstance(ids, tuple):
        return ids
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    total = int(sizes.sum())
    return np.concatenate(ids) if total and isinstance(ids[0], np.ndarray) else np.fromiter(chain.from_iterable(ids), np.uint32, total), sizes


class Units:
    def __init__(self, split: Callable[[str], list[str]], encode: Callable[[list[str]], list[list[int]] | tuple[np.ndarray, np.ndarray]], special: re.Pattern | None, most: int = MOST_UNITS) -> None:
        self.split, self.encode, self.special, self.most = split, encode, special, most
        self.cut = {words_apart: cut_apart, words_spaced: cut_spaced, words_behind: cut_spaced, words_whole: cut_whole}[split]
        self._empty()

    def _empty(self) -> None:
        self.places = _Places()
        self.flat, self.at, self.size, self.met = np.zeros(1 << 16, np.uint32), *(np.zeros(1 << 14, np.int64) for _ in range(3))
        self.units = self.used = 0

    def _let_go(self) -> None:
        """Keeps units met more than once, and of these at most half of what the store may hold."""
        met, least = self.met[: self.units], 2
        while (keep := np.flatnonzero(met >= least)).size > self.most // 2 or self.size[keep].sum() > MOST_IDS // 2:
            least *= 2
        names = list(self.places)
        size = self.size[keep]
        ends = np.cumsum(size)
        flat = self.flat[np.repeat(self.at[keep] - (ends - size), size) + np.arange(size.sum())]
        self._empty()
        for k in keep.tolist():
            self.places[names[k]] = len(self.places)
        self.units, self.used = len(keep), len(flat)
        for name, held in (("flat", flat), ("at", ends - size), ("size", size), ("met", np.ones(len(keep), np.int64))):
            self._room(name, len(held))
            getattr(self, name)[: len(held)] = held

    def _room(self, name: str, n: int) -> None:
        if n > len(old := getattr(self, name)):
            setattr(self, name, np.concatenate((old, np.zeros(max(n, 2 * len(old)) - len(old), old.dtype))))

    def _learn(self) -> None:
        new, self.places.new = self.places.new, []
        for k in range(0, len(new), AT_ONCE):
            flat, sizes = flattened(self.encode(new[k : k + AT_ONCE]))
            n, total = self.units + len(sizes), len(flat)
            for name, room in (("at", n), ("size", n), ("met", n), ("flat", self.used + total)):
                self._room(name, room)
            self.size[self.units : n] = sizes
            self.at[self.units : n] = self.used + np.cumsum(sizes) - sizes
            self.flat[self.used : self.used + total] = flat
            self.units, self.used = n, self.used + total

    def _placed(self, units: list[str] | np.ndarray) -> np.ndarray:
        return np.fromiter(map(self.places.__getitem__, units), np.int64, len(units))

    def _cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Places of all units in order, and the number of units of each text."""
        whole = pa.array(texts, pa.large_string())
        plain = pc.invert(pc.match_substring_regex(whole, UNPLAIN)).to_numpy(zero_copy_only=False)
        if self.special:
            plain &= ~np.fromiter((bool(self.special.search(t)) for t in texts), bool, len(texts))
        counts = np.zeros(len(texts), np.int64)
        cut = self.cut(whole.filter(pa.array(plain)))
        counts[plain] = cut.value_lengths().to_numpy(zero_copy_only=False)
        words = pc.dictionary_encode(cut.flatten())
        usual = self._placed(words.dictionary.to_numpy(zero_copy_only=False))[words.indices.to_numpy(zero_copy_only=False)] if len(words) else np.empty(0, np.int64)
        other = [[t] if self.special and self.special.search(t) else self.split(t) for t, p in zip(texts, plain.tolist(), strict=True) if not p]
        if not other:
            return usual, counts
        counts[~plain] = [len(x) for x in other]
        place, of_plain = np.empty(int(counts.sum()), np.int64), np.repeat(plain, counts)
        place[of_plain] = usual
        place[~of_plain] = self._placed([u for x in other for u in x])
        return place, counts

    def ids(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, and the place after each text's last one. A null is an empty text.

        A text with a special string is one unit: it goes to the encoder whole."""
        if self.units > self.most or self.used > MOST_IDS:
            self._let_go()
        place, counts = self._cut([t or "" for t in texts])
        if self.places.new:
            self._learn()
        self.met[: self.units] += np.bincount(place, minlength=self.units)
        n = self.size[place]
        ends = np.concatenate(([0], np.cumsum(n)))
        ids = self.flat[np.repeat(self.at[place] - ends[:-1], n) + np.arange(ends[-1])]
        return ids, ends[np.cumsum(counts)]


def library_units(path: str, split: Callable[[str], list[str]]) -> Units:
    """Units encoded by the tokenizers library: JOINED at a time, a special string between them, whose id cuts the ids again."""
    tok, special = tokenizer(path), special_strings(path)
    mark = next(iter(t.content for t in tok.get_added_tokens_decoder().values()), None)

    def encode(units: list[str]) -> list[np.ndarray]:
        whole = [k for k, u in enumerate(units) if mark is None or special.search(u)]
        alone = dict(zip(whole, tok.encode_batch_fast([units[k] for k in whole], add_special_tokens=False), strict=True))
        rest = [k for k in range(len(units)) if k not in alone] if alone else range(len(units))
        out: list = [None] * len(units)
        for k, e in alone.items():
            out[k] = np.array(e.ids, np.uint32)
        groups = [rest[k : k + JOINED] for k in range(0, len(rest), JOINED)]
        for group, e in zip(groups, tok.encode_batch_fast([mark.join([units[k] for k in g]) for g in groups], add_special_tokens=False) if groups else (), strict=True):
            ids = np.array(e.ids, np.uint32)
            cuts = np.flatnonzero(ids == tok.token_to_id(mark)).tolist()
            for k, a, b in zip(group, [-1, *cuts], [*cuts, len(ids)], strict=True):
                out[k] = ids[a + 1 : b]
        return out

    return Units(fitting(split, lambda t: tok.encode(t, add_special_tokens=False).ids, tok), encode, special)


@lru_cache(2)
def word_units(path: str) -> Units:
    return library_units(path, words_apart)


@lru_cache(2)
def byte_units(path: str) -> Units:
    return library_units(path, words_spaced)


@lru_cache(2)
def plain_byte_units(path: str) -> Units:
    """As byte_units, but special strings in a text are ordinary text: units that have one go to the same tokenizer while it is told so."""
    usual, special, tok = library_units(path, words_spaced), special_strings(path), tokenizer(path)

    def plainly(texts: list[str]) -> list[np.ndarray]:
        tok.encode_special_tokens = True
        try:
            return [np.array(e.ids, np.uint32) for e in tok.encode_batch_fast(texts, add_special_tokens=False)]
        finally:
            tok.encode_special_tokens = False

    def encode(units: list[str]) -> list:
        odd = {k for k, u in enumerate(units) if special and special.search(u)}
        if not odd:
            return usual.encode(units)
        out: list = [None] * len(units)
        rest = [k for k in range(len(units)) if k not in odd]
        for some, ids in ((rest, usual.encode([units[k] for k in rest])), (sorted(odd), plainly([units[k] for k in sorted(odd)]))):
            for k, i in zip(some, ids, strict=True):
                out[k] = i
        return out

    return Units(fitting(words_spaced, lambda t: plainly([t])[0].tolist(), tok), encode, None)
