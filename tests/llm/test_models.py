"""Language network and byte-pair automaton."""

import hashlib
import random
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from quarrykit.llm import bpe_automaton, language_id, units

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = [None, "", " ", "a\x1cb c", "x\x85y\xa0z w  \n\n q", "  lead", "trail  ", "\n\n\n", "a <|endoftext|> b<|endoftext|>", " 's don't  1234 é́ İΣ ΑΣ", "a　b​c", "tab\t\tx \n y", "中文 字", "don't STOP'LL", "a" * 3000, "ab" * 500, "<|startoftext|>"]


def texts():
    rng = random.Random(11)
    letters = "aeinorst'! 1é中Σ\n\t<|>B"
    return ODD + ["".join(rng.choices(letters, k=rng.randrange(80))) for _ in range(300)] + ["".join(rng.choices("the and ing", k=60)) for _ in range(60)]


def test_gradient_by_differences():
    net = language_id.ByteNetwork(["a", "b", "c"], seed=3, hidden=3)
    rng = np.random.default_rng(0)
    byte = rng.integers(0, 256, (7, 4)).astype(np.intp)
    byte[5:, 1] = language_id.PAD
    label = np.array([0, 1, 2, 1])
    for group in (net.table, net.again, net.bias):
        for d in (0, 1):
            group[d] = group[d].astype(np.float64)
    net.out, net.level = net.out.astype(np.float64), net.level.astype(np.float64)
    _, grads = net.gradient(byte, label)
    for w, g in zip(net.weights(), grads, strict=True):
        flat, steep = w.reshape(-1), np.argsort(-np.abs(g).reshape(-1))[:4]
        for k in steep:
            held = flat[k]
            flat[k] = held + 1e-2
            up = net.gradient(byte, label)[0]
            flat[k] = held - 1e-2
            down = net.gradient(byte, label)[0]
            flat[k] = held
            assert abs((up - down) / 2e-2 - g.reshape(-1)[k]) < 0.05 * abs(g.reshape(-1)[k]) + 2e-3


def test_pooling_reads_whole_texts():
    net = language_id.ByteNetwork(["a", "b"], seed=1)
    long = [b"abc " * 40_000, b"x", b"q" * 96, b"r" * 97]
    p = net.pooled(long)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4)
    assert np.allclose(net.pooled([long[3]])[0], p[3], atol=1e-5)
    assert not np.allclose(net.pooled([long[0] + b"z" * 160_000])[0], p[0], atol=1e-3)


def test_network_against_naive_recurrence():
    """Every window by itself, one position after another, one unit after another."""
    import math

    net = language_id.ByteNetwork(["a", "b", "c"], seed=5, hidden=3)
    rng = random.Random(12)
    net.level[:] = [0.3, -0.2, 0.1]
    clip = lambda x: min(1.0, max(0.0, x))

    def read(d, data):
        h, states = [0.0] * 3, {}
        for t in range(len(data)) if d == 0 else reversed(range(len(data))):
            x = net.table[d][data[t]]
            again = [sum(h[i] * float(net.again[d][i][k]) for i in range(3)) for k in range(9)]
            update, reset = [clip(float(x[k]) + again[k]) for k in range(3)], [clip(float(x[3 + k]) + again[3 + k]) for k in range(3)]
            candidate = [math.tanh(float(x[6 + k]) + reset[k] * (again[6 + k] + float(net.bias[d][k]))) for k in range(3)]
            h = states[t] = [update[k] * h[k] + (1 - update[k]) * candidate[k] for k in range(3)]
        return states

    def naive(text):
        total = [0.0] * 3
        for at in range(0, len(text), language_id.WINDOW):
            data = text[at : at + language_id.WINDOW]
            forth, back = read(0, data), read(1, data)
            for t in range(len(data)):
                both = forth[t] + back[t]
                e = [math.exp(sum(both[i] * float(net.out[i][k]) for i in range(6)) + float(net.level[k])) for k in range(3)]
                total = [a + x / sum(e) for a, x in zip(total, e, strict=True)]
        return [a / len(text) for a in total]

    texts = [bytes(rng.randrange(256) for _ in range(n)) for n in (1, 2, 95, 96, 97, 200, 300)]
    assert np.allclose(net.pooled(texts), [naive(t) for t in texts], atol=1e-4)


def test_language_accuracy_held_out(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    told = language_id.with_language(df, language_id.train_network(df)).where(language_id.held_out(F.col("doc_id"))).select("doc_id", "lang", "lang_pred", "score").collect()
    assert {r.doc_id for r in told} == {i for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang == r.lang_pred for r in told) >= 0.95 * len(told)
    assert all(0 <= r.score <= 1 for r in told)


def test_language_odd_rows(spark):
    df = spark.createDataFrame([(1, None, "en"), (2, "", "en"), (3, "12 34 ..", "en"), (4, "hello there", None), (None, "some words", "en")], "doc_id bigint, text string, lang string")
    assert language_id.train_network(df) is None
    got = language_id.with_language(df.withColumn("score2", F.lit(1)), None).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}
    empty = df.limit(0)
    assert language_id.train_network(empty) is None and language_id.with_language(empty, None).count() == 0
    net = language_id.ByteNetwork(["en", "fr"])
    assert [r.lang_pred == "und" for r in language_id.with_language(df, net).orderBy(F.col("doc_id").asc_nulls_last()).collect()] == [True, True, True, False, False]


def test_every_label_is_learned(spark):
    """Seventy labels, the last one rarest: each of its own pair of letters."""
    rng = random.Random(6)
    pairs = [a + b for a in "abcdefghij" for b in "qrstuvw"]
    rows = [(lang, " ".join("".join(rng.choices(pair, k=rng.randrange(2, 7))) for _ in range(20))) for k, (lang, pair) in enumerate((f"l{k:02d}", p) for k, p in enumerate(pairs)) for _ in range(20 if k < 69 else 14)]
    df = spark.createDataFrame([(k, t, lang) for k, (lang, t) in enumerate(rows)], "doc_id bigint, text string, lang string")
    net = language_id.train_network(df)
    assert net.languages == [f"l{k:02d}" for k in range(70)]
    told = language_id.predictions(net, [t for _, t in rows])[0]
    assert sum(a == b for (a, _), b in zip(rows, told, strict=True)) >= 0.9 * len(rows)
    assert sum(b == "l69" for b in told[-14:]) >= 12


@pytest.mark.parametrize("n", [1, 2, 3, 10])
def test_least_score_follows_number_of_languages(spark, monkeypatch, n):
    """A text at chance goes, one at twice chance stays, however many labels were learned."""
    df = spark.createDataFrame([(1, "some words", "a"), (2, "12 .", "a")], "doc_id bigint, text string, lang string")
    net = language_id.ByteNetwork([f"l{k}" for k in range(n)])
    net.out[:] = 0
    monkeypatch.setattr(corpus_pipeline, "train_network", lambda docs: net)
    kept = lambda: [r.doc_id for r in corpus_pipeline.language(spark, df, "").collect()]
    assert kept() == ([1] if n == 1 else [])
    net.level[0] = np.log(2 * (n - 1) / (n - 2)) if n > 2 else 5
    assert kept() == [1]
    assert corpus_pipeline.least_score(4) == pytest.approx(0.3)


def test_automaton_equals_merges():
    """Small automata against merging in order."""
    rng = random.Random(2)
    for _ in range(300):
        known, merges = list(range(rng.randrange(1, 4))), []
        base, spelled = list(known), {t: (t,) for t in known}
        for _ in range(rng.randrange(14)):
            u, v = rng.choice(known), rng.choice(known)
            if spelled[u] + spelled[v] in spelled.values():
                continue
            uv = len(known)
            known.append(uv)
            spelled[uv] = spelled[u] + spelled[v]
            merges.append((u, v, uv))
        made, words, wants = bpe_automaton.MergeAutomaton(base, merges), [], []
        for _ in range(30):
            word = rng.choices(base, k=rng.randrange(1, 14))
            want = list(word)
            for u, v, uv in merges:
                out, k = [], 0
                while k < len(want):
                    pair = want[k : k + 2] == [u, v]
                    out.append(uv if pair else want[k])
                    k += 1 + pair
                want = out
            words.append([made.code[t] for t in word])
            wants.append(want)
            assert made.encode(words[-1]) == want
        ids, counts = made.encode_words(np.concatenate(words), np.array([len(w) for w in words]))
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == wants


def test_automaton_equals_library():
    tok, made = units.tokenizer(WORD), bpe_automaton.compiled(WORD)
    for t in texts():
        want = tok.encode(t or "", add_special_tokens=False).ids
        assert made.encode(t or "") == want
        assert made.decode(want) == tok.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("path, split", [(WORD, units.words_apart), (BYTE, units.words_spaced)])
@pytest.mark.parametrize("most", [10**6, 300, 5])
def test_units_equal_library(path, split, most):
    store, tok = units.library_units(path, split), units.tokenizer(path)
    store.most = most
    every = texts()
    for k in range(0, len(every), 50):
        ids, ends = store.ids(every[k : k + 50])
        start = 0
        for t, end in zip(every[k : k + 50], ends.tolist(), strict=True):
            assert ids[start:end].tolist() == tok.encode(t or "", add_special_tokens=False).ids
            start = end
    assert store.ids([])[0].tolist() == []


def test_tokens_across_white_space(tmp_path):
    """A vocabulary with a token of two words: texts go to the encoder whole, and get the library's ids."""
    from tokenizers import Tokenizer, models

    vocab = {c: k for k, c in enumerate("ab ")} | {"a ": 3, "a b": 4}
    tok = Tokenizer(models.BPE(vocab=vocab, merges=[("a", " "), ("a ", "b")]))
    tok.save(path := str(tmp_path / "t.json"))
    every = ["a b a b", "", None, "b a", "a b"]
    for split in (units.words_apart, units.words_spaced):
        store = units.library_units(path, split)
        assert store.split is units.words_whole
        ids, ends = store.ids(every)
        assert [x.tolist() for x in np.split(ids, ends[:-1])] == [tok.encode(t or "").ids for t in every]
    assert units.word_units(WORD).split is units.words_apart and units.byte_units(BYTE).split is units.words_spaced and units.plain_byte_units(BYTE).split is units.words_spaced


def test_encode_digests(spark):
    every = texts()
    df = spark.createDataFrame(list(enumerate(every)), "doc_id bigint, text string").withColumn("ids", F.lit("x"))
    tok = units.tokenizer(WORD)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    plain = {r.doc_id: r.ids for r in bpe_automaton.encode_texts(df, WORD).collect()}
    for r in bpe_automaton.encode_digests(df, WORD).collect():
        ids = tok.encode(every[r.doc_id] or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(" ".join(map(str, ids))))
        assert r.decoded_sha256 == sha(tok.decode(ids, skip_special_tokens=False))
        assert plain[r.doc_id] == ids
    assert bpe_automaton.encode_digests(df.limit(0), WORD).count() == 0
