"""Operators 11 to 13: quality model, alignment of two tokenizers, hard negatives, each against a brute-force version."""

import hashlib
import random
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarrykit.llm import alignment, hard_negatives, quality_model
from quarrykit.llm.units import byte_letters

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from oracle import compare, connect  # noqa: E402

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def by_hand(rows):
    """The contract, token by token."""
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    model, byte = sentencepiece.SentencePieceProcessor(model_file=B), {c: b for b, c in enumerate(byte_letters())}
    out, links, held = {}, Counter(), {}
    for k, text in rows:
        out[k] = [0, 0, 0, 0, 0, 0, ""]
        if not text:
            continue
        a = [(i, bytes(byte[c] for c in tok.id_to_token(i))) for i in tok.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()) for i in model.encode(text)]
        if not b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode():
            continue
        spans = []
        for side in (a, b):
            at, made = 0, []
            for i, x in side:
                made.append((at, at + len(x), i))
                at += len(x)
            spans.append(made)
        pairs = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]] if len(text) < 500 else sweep(*spans)
        common, groups, at = sorted({x[1] for x in spans[0]} & {y[1] for y in spans[1]}), [], 0
        places = [0, 0]
        for c in common:
            part = []
            for n in (0, 1):
                own = []
                while places[n] < len(spans[n]) and spans[n][places[n]][1] <= c:
                    own.append(str(spans[n][places[n]][2]))
                    places[n] += 1
                part.append(",".join(own))
            groups.append("|".join(part))
        out[k] = [len(a), len(b), len(groups), len(pairs), 0, 0, hashlib.sha256(";".join(groups).encode()).hexdigest()]
        links.update(pairs)
        held[k] = pairs
    best = {}
    for (_, y), n in links.items():
        best[y] = max(best.get(y, 0), n)
    for k, pairs in held.items():
        out[k][4:6] = sum(links[p] == best[p[1]] for p in pairs), sum(links[p] for p in pairs)
    return {k: tuple(v) for k, v in out.items()}


def sweep(a, b):
    pairs, j = [], 0
    for x in a:
        while b[j][1] <= x[0]:
            j += 1
        k = j
        while k < len(b) and b[k][0] < x[1]:
            pairs.append((x[2], b[k][2]))
            k += 1
    return pairs


ODD = [None, "", " ", "  ", "a  b", "x ▁y", "foo\nbar\n\n baz", "\n\nx", "tab\t\ty", "<s> </s> <|endoftext|> <unk> <0x41>", "é ü ñ 中文字符测试", "中" * 900, "a" * 2000, "word " * 800, "ab c d　e \x00 z", "trail   ", "don't 12345 3.14", "\U0001f600 smile ‍ x", "日本語" * 500 + " x " + "ab" * 600, "one two", "one two"]


@pytest.mark.parametrize("chunk,fan,hot", [(64, 2, 1 << 18), (500, 32, 16), (64 << 10, 32, 1 << 18)])
def test_alignment_by_hand(spark, monkeypatch, chunk, fan, hot):
    monkeypatch.setattr(alignment, "FAN", fan)
    monkeypatch.setattr(alignment, "HOT", hot)
    rows = list(enumerate(ODD)) + [(3, "repeated id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"key": F.lit("x"), "n_a": F.lit(1), "pairs": F.lit(None)})
    got = Counter(tuple(r) for r in alignment.align(df, A, B, chunk=chunk).collect())
    want = by_hand([(n, t) for n, (_, t) in enumerate(rows)])
    assert got == Counter((rows[n][0], *w) for n, w in want.items())


def test_alignment_of_the_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    df = alignment.op12_alignment(spark, sf)
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert {r[0]: tuple(r)[1:] for r in df.collect()} == by_hand(rows)


def test_alignment_of_an_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []


def fold_of(parts):
    """One fragment, and the groups that the joins closed, left to right."""
    whole, closed = alignment.Fragment(alignment.NONE, False, alignment.NONE), []
    for f, own in parts:
        whole, bridge = alignment.join(whole, f)
        closed += [bridge] if bridge is not None and len(bridge.a) else []
        closed += [own] if len(own.a) else []
    return whole, closed


def test_fragments_are_associative_and_give_the_groups_of_any_cut():
    a, b, units = alignment.byte_side(A), alignment.piece_side(B), alignment.both_units(A, B)
    text = " " + "Über naïve tokenizers' don't-care 12345 中文字符 words " * 6
    run, *_ = alignment.tokens_of(units, a, b, [text])
    whole = alignment.Ends(a, b, run).written()[0].decode()
    for chunk in (1, 2, 3, 7, 20, 1000):
        parts = [(f, own) for _, f, own in alignment.fragments(a, b, run, chunk)]
        edge, closed = fold_of(parts)
        assert edge.closed and not len(edge.suffix.a) and not len(edge.suffix.b)
        text_of = lambda r: alignment.Ends(a, b, r).written()[0].decode()
        assert text_of(edge.prefix) + "".join(map(text_of, closed)) == whole
    same = lambda x, y: (x.closed, *(v.tolist() for r in (x.prefix, x.suffix) for v in (r.a, r.b))) == (y.closed, *(v.tolist() for r in (y.prefix, y.suffix) for v in (r.a, r.b)))
    frags = [f for _, f, _ in alignment.fragments(a, b, run, 3)]
    for x, y, z in zip(frags, frags[1:], frags[2:], strict=False):
        assert same(alignment.join(alignment.join(x, y)[0], z)[0], alignment.join(x, alignment.join(y, z)[0])[0])


def test_mining_against_sql(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.1"):
        assert compare(hard_negatives.op13_hard_negatives(spark, sf), connect(sf), hard_negatives.SQL) is None


KIND = "vec_id long, embedding array<double>, label int"


def mined(rows):
    """Plain loops over distinct rows."""
    held = []
    for i, v, lab in sorted({(i, tuple(v) if v is not None else None, lab) for i, v, lab in rows}, key=str):
        if i is not None and v is not None and lab is not None and all(x is not None and np.isfinite(x) for x in v):
            held.append((i, tuple(int(np.floor(256 * x)) for x in v), (lab + 1) % 10 if i % 7 == 0 else lab))
    held = sorted(set(held))
    score = lambda x, y: sum(p * q for p, q in zip(x, y, strict=False))
    out = []
    for i, v, lab in held:
        if i % 100:
            continue
        same = sorted(((-score(v, w), j) for j, w, o in held if o == lab and j != i))[:5]
        for s, p in same:
            fits = sorted((-score(v, w), j) for j, w, o in held if o != lab and 80 * -s <= 100 * score(v, w) <= 100 * -s)[:5]
            out += [(i, p, n + 1, j, -s, -t) for n, (t, j) in enumerate(fits)]
    return Counter(out)


@pytest.mark.parametrize("least,width,leaf", [(1024, 64, 48), (16, 3, 4)])
def test_mining_of_odd_rows(spark, monkeypatch, least, width, leaf):
    monkeypatch.setattr(hard_negatives, "LEAST", least)
    rng = random.Random(5)
    nan, inf = float("nan"), float("inf")
    rows = [(100, [1.0, 0.5], 1), (100, [1.0, 0.5], 1), (0, [0.0, 0.0], 2), (200, [-1.0, -1.0], 3), (300, [1.0], 1), (400, [], 1), (500, [nan, 1.0], 1), (600, None, 1), (700, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (800, [None, 1.0], 2), (900, [inf, 0.0], 2)]
    rows += [(k, [rng.choice([0.25, 0.5, 1.0]), rng.choice([0.25, 0.5])], rng.randrange(3)) for k in range(1, 90)]
    rows += [(1000 + k, [0.5, 0.25], 1 if k % 3 else 2) for k in range(120)]
    df = spark.createDataFrame(rows, KIND).withColumns({"id": F.lit("x"), "block": F.lit(1), "row": F.lit(2)})
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, label=label)
    assert Counter((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in got.collect()) == mined(rows)
    assert hard_negatives.hard_negatives(df.limit(0), F.lit(True)).collect() == []


def test_trees_cover_and_descents_are_exact():
    rng = np.random.default_rng(2)
    x = np.concatenate((rng.integers(-200, 200, (300, 6)), rng.integers(-3, 3, (200, 6)) + 90, np.tile([5, 5, 5, 5, 5, 5], (80, 1))))
    ids, labels = np.arange(len(x)), rng.integers(0, 3, len(x))
    tree = hard_negatives.build(ids, labels, x, width=5, leaf=6)
    assert sorted(tree.ids.tolist()) == ids.tolist()
    lifted = np.column_stack((tree.rows, np.sqrt(np.maximum(tree.norm**2 - (tree.rows.astype(float) ** 2).sum(axis=1), 0))))

    def covered(n):
        a, b = tree.child[n]
        return np.arange(*tree.member[n]) if b == 0 else np.concatenate([covered(k) for k in range(a, b)])

    for n in range(len(tree.centre)):
        some = covered(n)
        assert np.sqrt(((lifted[some] - lifted[tree.centre[n]]) ** 2).sum(axis=1)).max() <= tree.radius[n] + 1e-6
    search = hard_negatives.Search(tree, 1e4)
    for k in range(0, len(x), 37):
        scores = (tree.rows.astype(np.int64) @ x[k]).astype(float)
        for same, low, high in ((True, -np.inf, np.inf), (False, 0.0, 9000.0), (False, 500.0, 600.0)):
            fits = ((tree.labels == labels[k]) & (tree.ids != k) if same else tree.labels != labels[k]) & (scores >= low) & (scores <= high)
            want = sorted(((int(s), int(i)) for s, i in zip(scores[fits], tree.ids[fits], strict=True)), key=lambda r: (-r[0], r[1]))[:5]
            assert search.best(x[k], k, labels[k], same, np.array([low]), np.array([high]), 5)[0] == want


def test_products_beyond_floats_are_exact():
    big = np.array([[1 << 30, 1], [1 << 30, 0], [(1 << 30) - 1, 7]], np.int64)
    search = hard_negatives.Search(hard_negatives.build(np.arange(3), np.array([0, 0, 0]), big), float(1 << 31))
    assert search.rows.dtype == object
    assert search.best(big[0], 0, 0, True, np.array([-np.inf]), np.array([np.inf]), 5)[0] == [(1 << 60, 1), ((1 << 30) * ((1 << 30) - 1) + 7, 2)]


def test_risk_is_not_negative_and_gradients_fit():
    rng = np.random.default_rng(0)
    weights = [rng.normal(0, 0.1, (quality_model.INPUTS, 4)), rng.normal(0, 0.1, 4), rng.normal(0, 0.5, 4), np.zeros(1)]
    x, slope = rng.normal(0, 1, (9, quality_model.INPUTS)), rng.normal(0, 1, 9)
    odds = lambda w: np.maximum(x @ w[0] + w[1], 0) @ w[2] + w[3][0]
    for k, g in enumerate(quality_model._gradient(weights, x, slope)):
        at = np.unravel_index(int(np.abs(g).argmax()), g.shape)
        moved = [w.copy() for w in weights]
        moved[k][at] += 1e-5
        assert (slope @ odds(moved) - slope @ odds(weights)) / 1e-5 == pytest.approx(g[at], rel=1e-3)


def test_prior_and_scores_of_a_known_mixture():
    rng = np.random.default_rng(1)

    def draw(n, good):
        x = np.zeros((n, quality_model.INPUTS), np.float32)
        x[:, :4] = rng.normal(1.5 if good else -1.5, 1, (n, 4))
        return x

    good, web, share = draw(1500, True), np.concatenate((draw(1400, True), draw(600, False))), 0.7
    prior = quality_model.class_prior(good, web)
    assert share - 0.06 < prior < share + 0.12
    network = quality_model.train(good, web, prior)
    assert network.score(draw(500, True)).mean() > 0.9 and network.score(draw(500, False)).mean() < 0.35


def test_inputs_read_whole_texts():
    base = b"plain words of a text. " * 4000
    assert not np.array_equal(quality_model.inputs(base), quality_model.inputs(base + b"$$$ " * 3000))
    assert not quality_model.inputs(b"").any() and not quality_model.inputs(None).any()
    for odd in (b" ", b"\n\n", b"a", b"\xff\xfe", "中".encode() * 50):
        assert np.isfinite(quality_model.inputs(odd)).all()


def test_quality_on_held_out_folds(spark):
    sf = "/root/testdata/sf0.1"
    df = quality_model.op11_quality_classifier(spark, sf)
    assert df.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    rows = df.join(labels, "doc_id", "left").collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.quality is not None]
    good, bad = [r.score for r in held if r.quality == 1], [r.score for r in held if r.quality == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.98 and np.mean([s >= 0.3 for s in good]) > 0.99 and np.mean([s < 0.3 for s in bad]) > 0.85


def test_quality_of_odd_tables(spark):
    kind = "doc_id long, text string, source string, score string"
    docs = spark.createDataFrame([(1, None, "a", "x"), (1, "", "a", "x"), (2, "some words", None, "x"), (None, "no id", None, None)], kind)
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality_model.with_quality(docs, quality_model.learned(docs, none)).collect()
    assert len(rows) == 4 and all(r.score == 0.5 and r.predicted == 1 for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    assert quality_model.with_quality(docs.limit(0), quality_model.learned(docs.limit(0), none)).collect() == []
    many = spark.range(400).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 4 == 0, F.lit("$$$ ### $$$")).otherwise(F.lit("some plain words here.")).alias("text"))
    labels = many.select("doc_id", F.when(F.col("doc_id") % 4 == 0, 0).otherwise(1).alias("quality")).where("doc_id % 3 = 0")
    twice = labels.union(labels.where("doc_id % 5 = 0").withColumn("quality", 1 - F.col("quality"))).union(spark.createDataFrame([(7, None)], "doc_id long, quality int"))
    network = quality_model.learned(many, twice)
    scores = {r.doc_id: r.score for r in quality_model.with_quality(many, network).collect()}
    assert min(s for k, s in scores.items() if k % 4) > max(s for k, s in scores.items() if k % 4 == 0)


def test_a_score_comes_of_the_text_alone(spark):
    docs = spark.createDataFrame([(k, "same text here", str(k)) for k in range(20)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, 1) for k in range(10)], "doc_id long, quality int")
    assert len({r.score for r in quality_model.with_quality(docs, quality_model.learned(docs, labels)).collect()}) == 1
