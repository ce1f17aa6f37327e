"""Token files, separator scan, packing, page extraction and the pipeline."""

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quarrykit.llm import common, html_extract, language_id, packing, secrets, simhash, token_counts, token_files, units

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"start": F.lit("x"), "length": F.lit(1), "frame": F.lit(None).cast("int")})


def some_rows():
    rng = random.Random(4)
    words = ["alpha", "beta", "gamma", "é", "!!", "<|endoftext|>", "1234", "\n"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(60)))) for i in rng.sample(range(1000), 150)]
    return rows + [(2000, None), (2001, ""), (2002, "word " * 9000), (2003, "same"), (2003, "same"), (2003, "other one")]


@pytest.mark.parametrize("segment", [1 << 20, 300])
def test_token_files_round_trip(spark, segment, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT", segment)
    monkeypatch.setattr(token_files, "SHARD_ROWS", 16384 if segment > 300 else 20)
    rows, tok = some_rows() + [(None, "no id")], units.tokenizer(BYTE)
    folder = common.new_folder(spark, "t")
    token_files.write_token_files(table(spark, rows).repartition(5), folder, BYTE)
    got = token_files.read_token_files(spark, folder, with_ids=True).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, *sorted(i for i, _ in rows if i is not None)]
    want = {}
    for i, t in rows:
        want.setdefault(i, []).append([*tok.encode(t or "", add_special_tokens=False).ids, 2])
    start = 0
    for r in got:
        assert list(r.ids) in want[r.doc_id]
        assert (r.start, r.n_tokens) == (start, len(r.ids))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += r.n_tokens
    assert sorted(token_files.read_document(spark, folder, 2003)) == sorted(want[2003])
    assert token_files.read_document(spark, folder, 2002) == want[2002]
    assert token_files.read_document(spark, folder, 5000) == []


def test_token_files_empty(spark):
    folder = common.new_folder(spark, "t")
    token_files.write_token_files(table(spark, []), folder, BYTE)
    assert token_files.read_token_files(spark, folder).count() == 0


@pytest.mark.parametrize("kind", [">u2", "<u4"])
def test_separator_scan_of_written_files(spark, kind):
    rows, tok = some_rows(), units.Tokenizer.from_file(BYTE)
    tok.encode_special_tokens = True
    rows += [(3000 + k, "".join(tok.decode([256 * j + 80]) for j in range(k, 190, 3))) for k in range(3)] * 20  # ids with the end's last byte
    folder = common.new_folder(spark, "flat")
    token_counts.write_flat(table(spark, rows).coalesce(1), folder, BYTE, 50256, kind=kind, block=100)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).collect()
    size = np.dtype(kind).itemsize
    assert len(files) > 50 and sum(bytes(f.content)[-size:] != np.array([50256], kind).tobytes() for f in files) > 20  # documents run on
    assert all(len(f.content) < 100 * size + 10_000 * size for f in files)
    got = token_counts.token_counts(spark, folder, 50256, kind).orderBy("position").collect()
    assert [r.n_tokens for r in got] == [len(tok.encode(t or "", add_special_tokens=False).ids) for _, t in rows]
    assert [r.position for r in got] == list(range(len(rows)))
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens + 1 for r in got)])[:-1].tolist()
    assert all(r.ended for r in got)
    with pytest.raises(ValueError, match="no character"):
        token_counts.write_flat(table(spark, rows), folder, BYTE, 50256, kind="<u2")


@pytest.mark.parametrize("scan", [1 << 20, 3])
def test_separator_scan_over_cut_blocks(spark, tmp_path, scan, monkeypatch):
    monkeypatch.setattr(token_counts, "SCAN", scan)
    rng = random.Random(8)
    for case in range(4):
        ids = [rng.choice([7, 1, 2, 3, 7 << 8]) if case else 1 for _ in range(60)] + [1] * (case % 2)
        data, folder = np.array(ids, "<u4").tobytes(), tmp_path / f"{case}-{scan}"
        folder.mkdir()
        cuts = sorted(4 * rng.randrange(len(ids)) for _ in range(7))
        for k, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(data)], strict=True)):
            (folder / f"part-{k:05d}").write_bytes(data[a:b])
        want, start = [], 0
        for k, i in enumerate(ids):
            if i == 7:
                want.append((len(want), start, k - start, True))
                start = k + 1
        if start < len(ids):
            want.append((len(want), start, len(ids) - start, False))
        assert sorted(map(tuple, token_counts.token_counts(spark, str(folder), 7, "<u4").collect())) == want
    (tmp_path / "odd").mkdir(exist_ok=True)
    (tmp_path / "odd" / "part-0").write_bytes(b"abcde")
    with pytest.raises(Exception, match="whole number"):
        token_counts.token_counts(spark, str(tmp_path / "odd"), 7).count()


def test_pack(spark):
    rows, tok = some_rows(), units.tokenizer(WORD)
    for capacity, group in ((2048, 16384), (64, 40)):
        got = packing.pack(table(spark, rows), WORD, capacity=capacity, group=group).collect()
        texts = {i: {tuple([*tok.encode(t or "", add_special_tokens=False).ids, 0]) for j, t in rows if j == i} for i, _ in rows}
        held = {}
        for r in got:
            assert any(zlib.crc32(np.array(x[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32 and len(x) >= r.start + r.length for x in texts[r.doc_id])
            assert r.start == r.piece * capacity and 0 < r.length <= capacity
            held.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for x in held.values():
            ends = [0, *(a + n for a, n in sorted(x))]
            assert [a for a, _ in sorted(x)] == ends[:-1] and ends[-1] <= capacity
        total = sum(r.length for r in got)
        assert total == sum(len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
        assert len(held) <= 1.1 * total / capacity + 2 * max(1, len(got) // group + 1)
    assert packing.pack(table(spark, []), WORD).count() == 0


def test_sum_of_squares_chooses_the_smallest():
    rng = random.Random(9)
    lengths = sorted((rng.randrange(1, 30) for _ in range(200)), reverse=True)
    number, offset = packing.sum_of_squares(lengths, 30)
    fill = {}
    for n, k, at in zip(lengths, number, offset, strict=True):
        def total(change):
            gaps = {}
            for x in (fill | change).values():
                if x < 30:
                    gaps[30 - x] = gaps.get(30 - x, 0) + 1
            return sum(c * c for c in gaps.values())
        room = {b: x for b, x in fill.items() if x + n <= 30}
        assert at == fill.get(k, 0) and (k in room) == bool(room)
        if room:
            assert total({k: fill[k] + n}) == min(total({b: x + n}) for b, x in room.items())
        fill[k] = fill.get(k, 0) + n


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="</p>";</script></head><body class="has-sidebar">
<header class="site"><h2>Site</h2><nav><ul><li><a href="/">Home</a></li></ul></nav></header><div class="cookie-notice">We use cookies to track you all day long.</div>
<div class="ad">Buy this now and then buy it again and again and more.</div>
<article><h1>Big &eacute;vent</h1><p>First <b>bold</b>ly &lt;said&gt; things<br>and more text follows here.<p>Second&nbsp;paragraph has    several words in it.
<aside>Related reading list of things</aside><div class="comments"><p>I am a reader comment with many words in it.</p></div><form><input name="q">Search it</form>
<ul><li>item one</li><li>item two</li></ul><script>evil()</script><!-- hidden --><p>Last words of the text.</p></article>
<div id="sidebar">Popular posts of the week are listed here</div><footer>&copy; Site &middot; words</footer></body></html>"""
TEXT = "Big évent First boldly <said> things and more text follows here. Second paragraph has several words in it. item one item two Last words of the text."


def test_extract():
    assert html_extract.extract(PAGE, {}) == TEXT
    assert html_extract.extract(PAGE.replace("article>", "div>"), {}).startswith("Big évent First")
    assert html_extract.extract(PAGE[: PAGE.index("<aside")] + "<foo", {}) == TEXT[: TEXT.index(" item")]
    for odd in (None, "", "   ", "<", "<p", "<!-- x", "&am", "<b><i></b></i>", "</p></p>", "<div " * 50):
        html_extract.extract(odd, {})
    assert html_extract.extract("just text &amp; more", {}) == "just text & more"
    assert len(html_extract.extract("<p>" + "word " * 200_000 + "</p>", {}).split()) == 200_000


def words_of(paragraphs):
    return "".join("<p>" + " ".join(f"Word{i} is here and says something of note {j}." for i in range(8)) + "</p>" for j in range(paragraphs))


BEFORE, AFTER = '<html><body><nav><a href="x">Home</a></nav><div class="ad">Buy this now and here.</div>', '<div class="site-footer">Words at the end</div></body></html>'


@pytest.mark.parametrize(
    "page, paragraphs",
    [
        (f'<div class="notice-board story"><h2>T</h2>{words_of(6)}</div>', 6),
        (f'<article><h1>T</h1>{words_of(3)}<section id="related-work">{words_of(2)}</section></article>', 5),
        (f'<div class="content has-sidebar">{words_of(5)}</div><div class="sidebar">{words_of(1)}</div>', 5),
        (f'<div class="post no-comments">{words_of(5)}</div>', 5),
        (f'<div class="elementor-widget-text">{words_of(5)}</div>', 5),
        (f'<form><div class="x">{words_of(5)}</div></form><article><p>short</p></article>', 0),
        (f'<article><h1>T</h1>{words_of(2)}<div class="comments"><div class="comment-body">{words_of(1)}</div></div></article>', 2),
        (f'<div id="page"><h1>T</h1>{words_of(3)}</div><div id="post-comments">{words_of(1)}</div>', 3),
        (f'<div><h1>T</h1>{words_of(2)}<div class="ad-slot">Buy this</div>{words_of(2)}</div>', 4),
    ],
)
def test_pages_without_marks_and_names_of_wrappers(page, paragraphs):
    got = html_extract.extract(BEFORE + page + AFTER, {})
    assert got.count("something") == 8 * paragraphs
    assert "Buy" not in got and "Home" not in got and "Words at the end" not in got


def test_heads_of_names():
    found = {n: html_extract.head(n) for n in ("comment-list", "post-comments", "commentList", "related-work", "no-comments", "has-sidebar", "entry-content", "box", "ad-slot", "")}
    assert found == {"comment-list": "comment", "post-comments": "comments", "commentList": "comment", "related-work": "work", "no-comments": "", "has-sidebar": "", "entry-content": "entry", "box": "", "ad-slot": "ad", "": ""}


def test_parsing_is_linear():
    import time

    for odd in ("<p " + "a" * 1_000_000 + ">x", "<b>x " * 200_000, '<div class="ad">x ' * 100_000, "<header>x " * 100_000, "<article>x " * 100_000, '<a "' * 200_000, "<script " * 100_000, "<p><div>" * 100_000, "</b>" * 200_000):
        began = time.perf_counter()
        html_extract.extract(odd, {})
        assert time.perf_counter() - began < 30, odd[:20]


def test_best_region_against_all():
    rng = random.Random(6)
    for _ in range(200):
        s = [rng.choice([-3, -1, 0, 1, 2]) for _ in range(rng.randrange(12))]
        a, b = html_extract.best_region(s)
        assert sum(s[a:b]) == max([0, *(sum(s[i:j]) for i in range(len(s)) for j in range(i, len(s) + 1))])


def test_pages(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    learned = html_extract.learn(df)
    assert all((w > 0) == (f[0] == "#") for f, w in learned.items())
    from html import unescape

    pages = {r.page_id: r.html for r in df.collect()}
    for r in html_extract.main_text(df, learned, keep=("url",)).collect():
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r.page_id], re.S)[1]
        want = " ".join(unescape(re.sub(r"<[^>]*(?:>|\Z)", " ", re.sub("</?b>", "", inner))).split())
        assert (r.text, r.n_chars) == (want, len(want))
    odd = spark.createDataFrame([(None, None, None), (1, "u", ""), (1, "u", "")], "page_id bigint, url string, html string")
    assert html_extract.learn(odd) == {} and [r.text for r in html_extract.main_text(odd, {}).collect()] == [""] * 3
    assert html_extract.main_text(odd.limit(0), {}).count() == 0


def test_pipeline_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sorted(docs.collect(), key=lambda r: r.doc_id)
    network = language_id.train_network(docs)
    lang, score = language_id.predictions(network, [r.text for r in rows])
    least = corpus_pipeline.least_score(len(network.languages), network.usual)
    assert 0.3 <= least < 0.34
    rows = [r for r, g, s in zip(rows, lang, score, strict=True) if g != "und" and s >= least]
    assert len(rows) >= 195
    seen, left = set(), []
    for r in rows:
        key = re.sub(r"[\x20\x09-\x0D]+", " ", r.text)
        if key not in seen:
            seen.add(key)
            left.append(r)
    fps, root = [int.from_bytes(simhash.sketch(r.text.encode()), "little") for r in left], list(range(len(left)))
    for i in range(len(left)):
        for j in range(i):
            x = fps[i] ^ fps[j]
            if x.bit_count() <= 44:
                a, b = sorted((root[i], root[j]))
                root = [a if x == b else x for x in root]
    left = [r for i, r in enumerate(left) if root[i] == i]
    tok = units.tokenizer(WORD)
    want = set()
    for r in left:
        ids = [*tok.encode(secrets.redact(r.text), add_special_tokens=False).ids, 0]
        want |= {(r.doc_id, k // 2048, k, len(ids[k : k + 2048]), zlib.crc32(np.array(ids[k : k + 2048], "<u4").tobytes())) for k in range(0, len(ids), 2048)}
    got = corpus_pipeline.run(spark, sf).collect()
    assert {tuple(r)[:5] for r in got} == want and len(got) == len(want)


def test_language_stage_drops_and_labels(spark):
    """A text of all languages in equal parts goes, as one without letters does; the others stay, with the language that was found."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    parts = {r.lang: r.text for r in docs.where("length(text) > 1000").groupBy("lang").agg(F.max("text").alias("text")).collect()}
    mixed = " ".join(parts[lang][:800] for lang in sorted(parts))
    more = spark.createDataFrame([(9001, mixed, "en", "x", 1), (9002, "12 34 !", "en", "x", 1), (9003, parts["de"], None, "x", 1)], docs.schema)
    got = {r.doc_id: r.lang for r in corpus_pipeline.language(spark, docs.unionByName(more), "").collect()}
    assert {9001, 9002, 9003} & set(got) == {9003} and got[9003] == "de"
    assert len(got) == docs.where("text rlike '[A-Za-z]'").count() + 1


def test_stages_keep_columns_and_odd_rows(spark):
    rows = [(1, "hello there my friend of the land", "en", "s", 33), (1, "hello there my friend of the land", "en", "s", 33), (2, None, None, None, None), (None, "the token = abcdef123456 is here", "en", None, 1), (4, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").withColumns({"predicted": F.lit(1), "_digest": F.lit("x")})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for df in (docs, docs.limit(0)):
            got = stage(spark, df, "/root/testdata/sf0.001")
            assert got.columns == docs.columns, name
            got.collect()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == 5
    assert sorted((r.doc_id or 0) for r in corpus_pipeline.exact(spark, docs, "").collect()) == [0, 1, 2]
    assert {r.text for r in corpus_pipeline.secrets(spark, docs, "").where("doc_id IS NULL").collect()} == {"the [secret] is here"}
