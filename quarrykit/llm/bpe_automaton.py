"""Byte-pair encoding by a deterministic automaton compiled from the merges.

The automaton's labels are tokens; it accepts exactly the sequences that the merges, applied in order, leave behind
(Berglund, Martens and van der Merwe, "Constructing a BPE Tokenization DFA", 2024). It starts with one state and a loop for each
base symbol. Each merge u, v puts in one gadget: the state that u leads to gets a copy without the arc v, arcs u lead to the copy, and
wherever u leaves, a new arc uv leads where v led. All arcs of a token lead to one state and a state differs from the one it was copied from
by one arc, so the automaton is compiled to arrays: of a state the token that leads to it and the merge that made it, of a token where its arcs
lead, led at first and its left part, and the sorted list of lost arcs. (Arcs one by one would be some 2e9 for a vocabulary of 49,000.)

Encoding reads the symbols of pre-split words from left to right, without search or going back. A table of position in the spellings by symbol, built
once, gives the labels that end at a place, longest first. Every text has one path, and the path of a text's beginning is a
beginning's own path; so of the labels that end at a place exactly one is an arc of the state where it starts, and that gives the state and
the last label there. Words of a batch go through the tables side by side; labels are then read off from each word's end. Decoding emits the labels of arcs.

Defined results: a null or empty text has no ids and decodes to the empty text; bytes that aren't UTF-8 are read as U+FFFD; other rows are
independent of each other, so ties, repeated rows and empty tables need nothing special; other columns of a table are not read."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import documents, per_text
from .units import Units, byte_letters, fitting, special_strings, tokenizer, words_apart

#: A bound of tokens' numbers; places (a power of two) for arcs that were met, each kept until another one needs its place.
NUMBERS, HELD_ARCS = 1 << 24, 1 << 19
NEVER = 1 << 60
#: Words of more symbols are read one by one.
LONG = 64
#: Words of these letters alone are words of the pre-tokenizer as they stand; others go to it. Units below this character only.
LATIN = "ɐ"


class MergeAutomaton:
    """base: ids of the base symbols; merges: (u, v, uv) in order. Every merge's parts must be older than it."""

    def __init__(self, base: Iterable[int], merges: list[tuple[int, int, int]]) -> None:
        self.base = sorted(set(base))
        most = max([*self.base, *(uv for *_, uv in merges)]) + 1
        self.target, self.origin, self.left, self.left_time = [0] * most, [0] * most, list(range(most)), [-1] * most
        self.owner, self.made = [-1], [-1]  # of each state: the token whose arcs lead to it, the merge that made it
        self.lost: dict[int, int] = {}  # owner and token of an arc that the states behind the owner lost, and when
        spelling = {t: (t,) for t in self.base}
        self.is_base = np.zeros(most, bool)
        self.is_base[self.base] = True
        for time, (u, v, uv) in enumerate(merges):
            if u not in spelling or v not in spelling or uv in spelling:
                raise ValueError(f"merge {time} uses a token before it is made, or makes one again")
            spelling[uv] = spelling[u] + spelling[v]
            self._gadget(time, u, v, uv)
        self._compile(spelling, most)

    def _gadget(self, time: int, u: int, v: int, uv: int) -> None:
        self.origin[uv] = self.target[uv] = self.target[v]
        if self._follows(self.target[u], v):  # else no arc is made, and uv stays its own left part
            self.left[uv], self.left_time[uv] = u, time
            self.lost[u * NUMBERS + v] = time
            self.target[u] = len(self.owner)
            self.owner.append(u)
            self.made.append(time)

    def _follows(self, state: int, token: int) -> bool:
        """Whether the state has an arc of this token: none of its left parts was lost when the arc was made from it."""
        until = NEVER
        while True:
            s = state
            while s:
                own = self.owner[s]
                if self.lost.get(own * NUMBERS + token, NEVER) <= min(until, self.made[s]):
                    return False
                s = self.origin[own]
            if self.is_base[token]:
                return True
            if self.left[token] == token:
                return False
            token, until = self.left[token], self.left_time[token]

    def _compile(self, spelling: dict[int, tuple[int, ...]], most: int) -> None:
        """Arrays of the automaton, and the table of positions in spellings: row (of a position) by symbol gives the next position.

        A position is a beginning of spellings, the longest that the symbols so far end in. Positions at which nothing goes on share the row of
        the longest shorter ending that is a position."""
        self.code = {t: k for k, t in enumerate(self.base)}
        wide = len(self.code)
        below: list[dict[int, int]] = [{}]
        complete = [-1]
        for token, symbols in spelling.items():
            at = 0
            for s in symbols:
                at = below[at].setdefault(self.code[s], len(below))
                if at == len(below):
                    below.append({})
                    complete.append(-1)
            complete[at] = token
        n = len(below)
        self.row, ending = np.zeros(n, np.int32), np.zeros(n, np.int32)
        self.step = np.zeros((1 + sum(map(bool, below[1:])), wide), np.int32)
        self.out, self.shorter = np.zeros(n, np.int32), np.zeros(n, np.int32)  # position of the longest label that ends here, and of the next
        used, front = 0, [0]
        for at in front:  # in order of length
            if at:
                self.shorter[at] = self.out[ending[at]]
                self.out[at] = at if complete[at] >= 0 else self.shorter[at]
                self.row[at] = self.row[ending[at]]
            if below[at]:
                before = self.step[self.row[at]]
                for c, down in below[at].items():
                    ending[down] = before[c] if at else 0
                if at:
                    used += 1
                    self.step[used] = before
                    self.row[at] = used
                for c, down in below[at].items():
                    self.step[self.row[at], c] = down
                front.extend(below[at].values())
        self.label = np.array(complete, np.int32)
        self.length = np.zeros(most, np.int32)
        for token, symbols in spelling.items():
            self.length[token] = len(symbols)
        keys = np.fromiter(self.lost, np.int64, len(self.lost))
        self.lost_keys = np.sort(keys)
        self.lost_times = np.fromiter(self.lost.values(), np.int64, len(self.lost))[np.argsort(keys)]
        for name in ("target", "origin", "left", "left_time", "owner", "made"):
            setattr(self, name, np.array(getattr(self, name), np.int64))
        self.lost, self.tokens = {}, len(spelling)
        self.arc_keys, self.arc_to = np.full(HELD_ARCS, -1, np.int64), np.zeros(HELD_ARCS, np.int32)

    def _lost_at(self, owner: np.ndarray, token: np.ndarray) -> np.ndarray:
        """When states behind the owners lost their arcs of the tokens; NEVER where they didn't."""
        if not len(self.lost_keys):
            return np.full(len(owner), NEVER)
        keys = owner * NUMBERS + token
        at = np.minimum(np.searchsorted(self.lost_keys, keys), len(self.lost_keys) - 1)
        return np.where(self.lost_keys[at] == keys, self.lost_times[at], NEVER)

    def allows(self, state: np.ndarray, token: np.ndarray) -> np.ndarray:
        """As _follows, for pairs of state and token side by side."""
        ok, token = np.ones(len(state), bool), token.astype(np.int64)
        left, until = np.arange(len(state)), np.full(len(state), NEVER)
        while len(left):
            good, pair, s = np.ones(len(left), bool), np.flatnonzero(state[left]), state[left]
            s = s[pair]
            while len(pair):
                own = self.owner[s]
                bad = self._lost_at(own, token[left[pair]]) <= np.minimum(until[pair], self.made[s])
                good[pair[bad]] = False
                s = self.origin[own]
                on = ~bad & (s != 0)
                pair, s = pair[on], s[on]
            t = token[left]
            good &= self.is_base[t] | (self.left[t] != t)
            ok[left[~good]] = False
            on = good & ~self.is_base[t]
            left, until = left[on], self.left_time[t[on]]
            token[left] = self.left[t[on]]
        return ok

    def arcs(self, state: np.ndarray, token: np.ndarray) -> np.ndarray:
        """The states that arcs lead to, -1 where there is no such arc."""
        keys = state * NUMBERS + token
        place = (keys * 0x9E3779B1 >> 16) & (HELD_ARCS - 1)
        to = self.arc_to[place]
        new = np.flatnonzero(self.arc_keys[place] != keys)
        if len(new):
            made = np.where(self.allows(state[new], token[new]), self.target[token[new]], -1)
            to[new] = made
            self.arc_keys[place[new]], self.arc_to[place[new]] = keys[new], made
        return to

    def encode_words(self, codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after another, given as codes of base symbols one after another and sizes of 1 to LONG; and the number of ids of each."""
        if not len(sizes):
            return np.empty(0, np.int32), np.empty(0, np.int64)
        order = np.argsort(-sizes, kind="stable")  # long ones first, so that those with a next symbol are the first ones
        n, longest = len(sizes), int(sizes[order[0]])
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        grid = np.zeros((longest, n), np.int32)
        grid[np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes), np.repeat(rank, sizes)] = codes
        states, last = np.zeros((longest + 1, n), np.int64), np.zeros((longest + 1, n), np.int32)
        at = np.zeros(n, np.int32)
        for i, m in enumerate(np.searchsorted(-sizes[order], -np.arange(longest), "left").tolist(), 1):
            at = self.step[self.row[at[:m]], grid[i - 1, :m]]
            left, end = np.arange(m), self.out[at]
            while len(left):
                token = self.label[end].astype(np.int64)
                to = self.arcs(states[i - self.length[token], left], token)
                good = to >= 0
                states[i, left[good]], last[i, left[good]] = to[good], token[good]
                left, end = left[~good], self.shorter[end[~good]]
        word, place, found = order, sizes[order], []
        while len(word):
            token = last[place, rank[word]]
            found.append((word, token))
            place = place - self.length[token]
            word, place = word[place > 0], place[place > 0]
        of = np.concatenate([w for w, _ in found])
        back = np.repeat(-np.arange(len(found)), [len(w) for w, _ in found])
        return np.concatenate([t for _, t in found])[np.lexsort((back, of))], np.bincount(of, minlength=n)

    def encode(self, codes: Iterable[int]) -> list[int]:
        """Ids of one word of any length."""
        states, last, at = [0], [-1], 0
        arc, row, step, out, label, length = self._arc, self.row, self.step, self.out, self.label, self.length
        for i, c in enumerate(codes, 1):
            at = step[row[at], c]
            end = out[at]
            while (to := arc(states[i - length[label[end]]], int(label[end]))) < 0:
                end = self.shorter[end]
            states.append(to)
            last.append(int(label[end]))
        path, i = [], len(states) - 1
        while i:
            path.append(last[i])
            i -= int(length[last[i]])
        return path[::-1]

    def _arc(self, state: int, token: int) -> int:
        key = state * NUMBERS + token
        place = (key * 0x9E3779B1 >> 16) & (HELD_ARCS - 1)
        if self.arc_keys[place] != key:
            return int(self.arcs(np.array([state]), np.array([token]))[0])
        return int(self.arc_to[place])


class AutomatonTokenizer:
    """A tokenizer file's merges compiled; its own normalizer and pre-tokenizer split texts into words."""

    def __init__(self, path: str) -> None:
        model = json.load(open(path, encoding="utf-8"))["model"]
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        triples = [(vocab[a], vocab[b], vocab[a + b]) for a, b in merges]
        made = {t for *_, t in triples}
        self.automaton = MergeAutomaton((i for i in vocab.values() if i not in made), triples)
        self.tok = tokenizer(path)
        self.byte = {c: b for b, c in enumerate(byte_letters())}
        code = self.automaton.code
        self.inside = np.array([code[vocab[c]] for c in self.byte], np.int32)
        self.last = np.array([code[vocab[c + suffix]] for c in self.byte], np.int32)
        #: Whether the file lower-cases, composes, and takes letters as words, as checked on all letters in question at once.
        letters = "".join(c for c in map(chr, range(ord(LATIN))) if c.isalpha() and c.lower().isalpha())
        self.plain_latin = bool(self.tok.normalizer) and self.tok.normalizer.normalize_str(letters) == letters.lower() and len(self.tok.pre_tokenizer.pre_tokenize_str(letters.lower())) == 1
        self.special = special_strings(path)
        self.added = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items()}
        self.labels = [""] * (max([*vocab.values(), *self.added.values()]) + 1)
        for label, i in [*vocab.items(), *self.added.items()]:
            self.labels[i] = label

    def _words(self, text: str) -> list[bytes]:
        """The words of a text without special strings, as bytes."""
        if not text:
            return []
        low = text.lower()
        if self.plain_latin and low.isalpha() and max(low) < LATIN:
            return [low.encode()]
        tok = self.tok
        return [bytes([self.byte[c] for c in word]) for word, _ in tok.pre_tokenizer.pre_tokenize_str(tok.normalizer.normalize_str(text) if tok.normalizer else text)]

    def _parts(self, text: str) -> list[bytes | int]:
        """Words, and the ids of special strings."""
        out, at = [], 0
        for m in [*(self.special.finditer(text) if self.special else ())]:
            out += [*self._words(text[at : m.start()]), self.added[m[0]]]
            at = m.end()
        return out + self._words(text[at:]) if at else self._words(text)

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        each = [self._parts(t) for t in texts]
        short = [w for x in each for w in x if isinstance(w, bytes) and len(w) <= LONG]
        ids, counts = self.automaton.encode_words(*self._codes(short))
        ends, k, out = np.concatenate(([0], np.cumsum(counts))).tolist(), 0, []
        for x in each:
            if all(isinstance(w, bytes) and len(w) <= LONG for w in x):
                out.append(ids[ends[k] : ends[k + len(x)]])
                k += len(x)
                continue
            made = []
            for w in x:
                if isinstance(w, int):
                    made.append([w])
                elif len(w) > LONG:
                    made.append(self.automaton.encode(self._codes([w])[0].tolist()))
                else:
                    made.append(ids[ends[k] : ends[k + 1]])
                    k += 1
            out.append(np.concatenate(made).astype(np.int32))
        return out

    def _codes(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        codes, ends = self.inside[data], np.cumsum(sizes) - 1
        codes[ends] = self.last[data[ends]]
        return codes, sizes

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def decode(self, ids: Iterable[int]) -> str:
        """The labels of the arcs, joined as a file without a decoder says: by one space."""
        labels = self.labels
        return " ".join([labels[i] for i in ids])


@lru_cache(2)
def compiled(path: str) -> AutomatonTokenizer:
    return AutomatonTokenizer(path)


@lru_cache(2)
def _held(path: str) -> tuple[AutomatonTokenizer, Units, list[str]]:
    made = compiled(path)
    return made, Units(fitting(words_apart, made.encode, made.tok), made.encode_all, made.special), [str(i) for i in range(len(made.labels))]


def encode_texts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ids (array of int) of every text."""

    def work(texts: list) -> list:
        ids, ends = _held(path)[1].ids(texts)
        return [pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(ids.astype(np.int32)))]

    return per_text(df, [id_col], text_col, "ids array<int>", work)


def encode_digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256 of every text, decoded from its ids."""
    sha: Callable[[str], str] = lambda s: hashlib.sha256(s.encode()).hexdigest()

    def work(texts: list) -> list:
        made, units, digits = _held(path)
        ids, ends = units.ids(texts)
        starts, plain = np.concatenate(([0], ends[:-1])).tolist() if len(ends) else [], ids.tolist()
        each = [plain[a:b] for a, b in zip(starts, ends.tolist(), strict=True)]
        return [pa.array([len(x) for x in each], pa.int64()), [sha(" ".join([digits[i] for i in x])) for x in each], [sha(made.decode(x)) for x in each]]

    return per_text(df, [id_col], text_col, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", work)


def op4_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_digests(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
