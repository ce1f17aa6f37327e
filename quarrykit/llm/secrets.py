"""Secret scans: an Aho-Corasick prefilter, anchored expressions near its hits, embedded checksums.

One pass of an Aho-Corasick automaton over the text finds all keywords of all kinds at once; an expression runs only from
the place of a hit. Runs of hex digits have no keyword: their anchor is every 12th character, since a run
of 24 holds two such neighbours; only where both are hex digits the run is measured.

Kinds assign, access and hex are the base. On top come tokens that carry their own proof, which is checked: `checked` are
tokens whose last six characters are the base-62 CRC-32 of the body (the layout that several code and package
hosts publish for theirs), `card` are payment card numbers of known prefixes that pass the Luhn sum.

Spans are kind:start:end in code points, end exclusive, by start, then kind as listed in KINDS. Defined results: a
null text counts as empty: no spans, and the digest of the empty string; bytes that aren't UTF-8 are read as U+FFFD; rows are independent, so ties, repeated
rows and empty tables need nothing special; other columns pass through redact_secrets untouched."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from .common import documents, per_text, slices, texts_of

KINDS = ("assign", "access", "hex", "checked", "card")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
CHECKED = re.compile(r"(gh[pousr]_|npm_)([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
CARD = re.compile(r"(?:4[0-9]{3}|5[1-5][0-9]{2}|2[2-7][0-9]{2}|6011)(?:[ -]?[0-9]{4}){3}(?![0-9])")
LEAST = {"assign": 6, "access": 20, "hex": 24}
#: Keywords in lower case and the kind each one is tried for.
KEYWORDS = {"password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign", "api_key": "assign", "akia": "access", "ghp_": "checked", "gho_": "checked", "ghu_": "checked", "ghs_": "checked", "ghr_": "checked", "npm_": "checked"}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
STEP = 12
_HEX_DIGIT = np.zeros(256, bool)
_HEX_DIGIT[list(b"0123456789abcdef")] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[list(b"0123456789")] = True


@lru_cache(1)
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        found.add_word(word, (len(word), kind))
    found.make_automaton()
    return found


def base62_crc(body: str) -> str:
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, digit = divmod(n, 62)
        out = BASE62[digit] + out
    return out


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _runs(codes: np.ndarray, table: np.ndarray, step: int) -> Iterator[int]:
    """Places on the anchor grid, one for each stretch of two or more neighbours in the table."""
    on = table[codes[::step]]
    pair = np.flatnonzero(on[:-1] & on[1:])
    return (pair * step).tolist()


def scan(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all that is found, by start, then kind as listed."""
    if not text:
        return []
    plain = text.isascii()
    low = text.lower() if plain else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # only A-Z, so that places hold
    hits = sorted((end - n + 1, kind) for end, (n, kind) in _automaton().iter(low))
    out, free = [], dict.fromkeys(KINDS, 0)
    for at, kind in hits:
        if at < free[kind]:
            continue
        if kind == "assign" and (m := ASSIGN.match(text, at)):
            free[kind] = m.end()
            if m.end(2) - m.start(2) >= LEAST[kind]:
                out.append((at, m.end(), kind))
        elif kind == "access" and (m := ACCESS.match(text, at)):
            free[kind] = m.end()
            if m.end() - at >= LEAST[kind]:
                out.append((at, m.end(), kind))
        elif kind == "checked" and not (at and (text[at - 1].isalnum() and text[at - 1].isascii())) and (m := CHECKED.match(text, at)) and base62_crc(m[2]) == m[3]:
            free[kind] = m.end()
            out.append((at, m.end(), kind))
    if plain:
        codes = np.frombuffer(text.encode(), np.uint8)
    else:
        wide = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(wide < 128, wide, 0).astype(np.uint8)
    for at in _runs(codes, _HEX_DIGIT, STEP):
        if at >= free["hex"]:
            start = at
            while start and _HEX_DIGIT[codes[start - 1]]:
                start -= 1
            free["hex"] = HEX.match(text, at).end()
            if free["hex"] - start >= LEAST["hex"]:
                out.append((start, free["hex"], "hex"))
    digits = np.flatnonzero(_DIGIT[codes[:-3]] & _DIGIT[codes[1:-2]] & _DIGIT[codes[2:-1]] & _DIGIT[codes[3:]]) if len(codes) > 3 else ()
    for at in digits:
        if at >= free["card"] and not (at and _DIGIT[codes[at - 1]]) and (m := CARD.match(text, at)) and luhn(re.sub("[ -]", "", m[0])):
            free["card"] = m.end()
            out.append((int(at), m.end(), "card"))
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


def secret_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and n_<kind> of the base, base_sha256, spans: all as text, digest over the base only."""

    def work(texts: list) -> list:
        found = [scan(t) for t in texts]
        said = lambda spans: ",".join(f"{k}:{a}:{b}" for a, b, k in spans)
        counts = [pa.array([sum(k == kind for *_, k in x) for x in found], pa.int64()) for kind in KINDS[:3]]
        return [*counts, [hashlib.sha256(said([y for y in x if y[2] in KINDS[:3]]).encode()).hexdigest() for x in found], [said(x) for x in found]]

    return per_text(df, [id_col], text_col, "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string", work)


def redact(text: str | None, mark: str = "[secret]") -> str | None:
    """The text with each stretch that spans cover replaced by the mark; null stays null."""
    spans = scan(text)
    if not spans:
        return text
    out, end = [], 0
    for a, b, _ in spans:
        if a > end or not out:
            out += [text[end:a], mark]
        end = max(end, b)
    return "".join(out) + text[end:]


def redact_secrets(df: DataFrame, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """All rows and columns of df with secrets in the text replaced by the mark."""
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, field = texts_of(batch.column(at)), batch.schema.field(at)
            clean = [redact(t, mark) for t in texts]
            same = pa.array([a is b for a, b in zip(texts, clean, strict=True)], pa.bool_())
            clean = pc.if_else(same, batch.column(at), pa.array(clean, field.type))  # a text without secrets stays as it is, byte for byte
            yield pa.RecordBatch.from_arrays([clean if i == at else c for i, c in enumerate(batch.columns)], names=batch.schema.names)

    return df.mapInArrow(run, df.schema)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(documents(spark, sf_dir))
