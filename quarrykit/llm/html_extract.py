"""Main text of web pages by a maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive and tags negative; one linear scan finds the contiguous region of the
greatest sum (Pasternack and Roth, "Extracting Article Text from the Web with Maximum Subsequence Segmentation", 2009). The weights come from
labelled pages: those that mark their article themselves, by one <article> or <main>. Of such among about SAMPLE pages (at most twice
that, picked by a hash) it is counted how often a tag, an element whose class or id has a word as its head, and a word below a tag, lie inside; the
counts are added to prior ones. Where a marked element holds nearly all of the best region, or is a page's only <article> and what is outside it is no prose, a second scan weighs words and tags by whether they
lie in it; so the mark moves the ends, and the scan decides.

Kinds of elements that are no article wherever they stand (menus, forms, scripts, asides, hidden ones, by element or role) are left out, and so are
elements named for what they hold: the head of a name of class or id counts, its last word but for words like list or content, so
comment-list and post-comments are comments, while related-work, notice-board and no-comments are none. Names are words of authors: an element that
is also named as text, or holds the page's heading or mark, stays, and where almost nothing is left without the named elements they all count by their weights alone.

Character references are decoded, white space becomes one space, blocks are joined by one space. Parsing and scan are linear in the page. Defined
results: null or empty html gives an empty text; markup that is cut off or not closed is read as far as it goes; bytes that aren't UTF-8 are
read as U+FFFD; pages are independent, so repeated rows and ties need nothing special (of equal regions the first is taken); an empty table gives no
rows; a kept column with the name of a made one gives way to it, other columns are not read."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import per_text, sampled

SAMPLE = 1000
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*|[^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|(?P<text>[^<]+|<)",
    re.S | re.I,
)
#: Elements whose content is no text of the page; those that hold all up to the page's end where they aren't closed, as browsers read them, and the others, whose tag alone goes then.
RAW, LOOSE = frozenset("iframe script style textarea title".split()), frozenset("noscript svg template".split())
END_OF = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in RAW | LOOSE}
ATTRIBUTE = re.compile(r"(?<![a-z-])(?:([a-z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|(hidden)(?![a-z-]))", re.I)
WORDS_OF_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Kinds of elements, and words of class and id.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
HOLDS_P = ("p", "td", "li", "article", "div")
MARKED = frozenset(("article", "main"))
NEVER = frozenset("aside button dialog footer form head input menu nav option select".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
NO_TEXT = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adv banner breadcrumb breadcrumbs comment comments commenting consent cookie cookies copyright disclaimer disqus dfp footer footers gdpr"
    " login masthead menu menus modal nav navbar navigation newsletter notice notices notification outbrain overlay pager pagination popup promo promos promotion recommended related replies"
    " respond share sharing sidebar sidebars signup social sponsor sponsored sponsors subscribe subscription taboola teaser toolbar widget widgets".split()
)
IS_TEXT = frozenset("article body content entry main post prose story text".split())
NO_HEAD = IS_TEXT | frozenset(
    "area articles aside bar block bottom box button buttons card col column container footer group header holder info inner item items layout left link links list media module outer page panel pane posts region"
    " right row section site slot stories thread title top unit wrap wrapper zone".split()
)
#: Words that tell wherever they stand in a name.
ANYWHERE = frozenset("disqus outbrain taboola".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NEGATING = frozenset("has have hide is no non not with without".split())
#: Prior share of a tag, or of a name, outside articles, by kind, and its count.
PRIOR, WEIGHT = {"inline": 0.02, "text": 0.03, "frame": 0.6, "no text": 0.9}, 4.0
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table thead tbody tr td th br hr figure figcaption caption".split())
#: A tag costs LEAST, and up to MOST more if it is always outside. A mark counts if it holds INSIDE of the region's words.
LEAST, MOST, INSIDE = 0.1, 12.0, 0.85
#: Where the region isn't the mark's: a mark of less than SHARE of the words yields to blocks of PROSE words, in the median.
SHARE, PROSE = 0.05, 20
#: A form with more than this share of the page's words, and blocks of text among them, is a frame around the page, if that marks no article.
AROUND = 0.5
#: Named elements are given another chance if fewer words than FEW, and less than this share, are left without them.
FEW, LEFT = 20, 0.1


class Node:
    """A tag or a stretch of text in page order; an element's end is the place after its last node.

    out: 2 if it is no article wherever it stands, 1 if its names say so; heads: of its names; frame: name of the nearest element around it that
    isn't inline; marked: whether it lies in a marked element."""

    __slots__ = ("end", "frame", "heads", "kind", "marked", "name", "out", "parent", "text")

    def __init__(self, kind: str, name: str, parent: int, nodes: list[Node], text: str = "") -> None:
        self.kind, self.name, self.parent, self.text, self.end, self.out, self.heads = kind, name, parent, text, -1, 0, ()
        above = nodes[parent] if parent >= 0 else None
        self.frame = "" if above is None else above.frame if above.name in INLINE else above.name
        self.marked = above is not None and (above.marked or above.name in MARKED)


def head(name: str) -> str:
    """The word that says what a name of class or id is of; none where it is negated or has only words like list."""
    words = [w.lower() for w in WORDS_OF_NAME.findall(name)]
    if not words or words[0] in NEGATING:
        return ""
    if any(w in ANYWHERE for w in words):
        return next(w for w in words if w in ANYWHERE)
    return next((w for w in reversed(words) if w not in NO_HEAD or w in NO_TEXT), next((w for w in words if w in IS_TEXT), ""))


def _judge(node: Node, attrs: str) -> None:
    """Sets out and heads of an element by its kind and attributes."""
    heads: list[str] = []
    node.out = 2 if node.name in NEVER else 0
    for key, *values, hidden in ATTRIBUTE.findall(attrs):
        key, value = key.lower(), "".join(values)
        if hidden or key == "role" and value.lower() in ROLES or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
            node.out = 2
        if key in ("class", "id"):
            heads += [h for n in value.split() if (h := head(n))]
    node.heads = tuple(dict.fromkeys(heads))
    if not node.out and any(h in NO_TEXT for h in heads) and not any(h in IS_TEXT for h in heads):
        node.out = 1


def parse(html: str) -> list[Node]:
    nodes: list[Node] = []
    stack: list[int] = []
    depths: dict[str, list[int]] = {}  # of each name the places in the stack

    def close_to(depth: int) -> None:
        while len(stack) > depth:
            node = nodes[stack.pop()]
            node.end = len(nodes)
            depths[node.name].pop()

    at, unclosed = 0, set()  # names of which no end is left
    while at < len(html):
        m = TOKEN.match(html, at)
        at = m.end()
        if m["text"]:
            nodes.append(Node("text", "", stack[-1] if stack else -1, nodes, unescape(m["text"])))
        elif m["name"]:
            name, attrs = m["name"].lower(), m["attrs"] or ""
            if name in END_OF:
                if m["close"] or name == "svg" and attrs.endswith("/"):
                    continue
                end = None if name in unclosed else END_OF[name].search(html, at)
                if end:
                    at = end.end()
                else:
                    unclosed.add(name)
                    at = len(html) if name in RAW else at
                continue
            if m["close"]:
                if depths.get(name):
                    close_to(depths[name][-1])
                nodes.append(Node("close", name, stack[-1] if stack else -1, nodes))
                continue
            if name in CLOSES_P and depths.get("p") and depths["p"][-1] == max(depths[n][-1] for n in HOLDS_P if depths.get(n)):
                close_to(depths["p"][-1])
            node = Node("open", name, stack[-1] if stack else -1, nodes)
            if name not in MARKED and name not in ("html", "body"):
                _judge(node, attrs)
            nodes.append(node)
            if name not in VOID and not attrs.endswith("/"):
                depths.setdefault(name, []).append(len(stack))
                stack.append(len(nodes) - 1)
            else:
                node.end = len(nodes)
    close_to(0)
    return nodes


def wanted(nodes: list[Node], named: bool = True) -> list[int]:
    """Places of nodes outside elements that are left out; without `named`, names leave none out.

    A named element or a form around a mark is kept, a named one around a heading of first rank too, and so are a header with a heading in the article and, where the page has no mark, a form that is a frame
    around most of its words."""
    marks, firsts, heads, blocks = ([0, *accumulate(n.kind == "open" and is_it(n.name) for n in nodes)] for is_it in (MARKED.__contains__, "h1".__eq__, HEADINGS.__contains__, TEXT_TAGS.__contains__))
    out, k = [], 0
    upto: list[int] = []

    def around(k: int, end: int) -> bool:
        """Whether so many of the page's words, and blocks of text, are between these places."""
        if not upto:
            upto.extend((0, *accumulate(len(n.text.split()) for n in nodes)))
        return upto[end] - upto[k] > AROUND * upto[-1] and blocks[end] > blocks[k]

    while k < len(nodes):
        node = nodes[k]
        if node.kind == "open" and (node.out or node.name == "header"):
            mark, first = marks[node.end] > marks[k + 1], firsts[node.end] > firsts[k + 1]
            kept = node.name == "form" and (mark or not marks[-1] and around(k, node.end))
            if node.out == 2 and node.name not in NEVER:
                kept = mark or first
            elif node.out == 1:
                kept = not named or mark or first
            elif not node.out:
                kept = mark or node.marked and heads[node.end] > heads[k + 1]
            if not kept:
                k = max(k + 1, node.end)
                continue
        out.append(k)
        k += 1
    return out


def _features(node: Node) -> list[str]:
    """A tag's name with a slash at ends, and the heads of an element's names; for a text the name of the element that it is in."""
    if node.kind == "text":
        return ["#" + node.frame]
    return ["/" * (node.kind == "close") + node.name, *("@" + h for h in node.heads)]


def count_features(html: str) -> Counter:
    """(feature, inside) counts of a page that marks exactly one article; else none. The marked element's own tags are outside."""
    nodes = parse(html)
    if sum(n.kind == "open" and n.name in MARKED for n in nodes) != 1:
        return Counter()
    out: Counter = Counter()
    for k in wanted(nodes):
        node = nodes[k]
        n = len(node.text.split()) if node.kind == "text" else 1
        for f in _features(node):
            out[f, node.marked] += n
    return out


def weights(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Score of a word below a tag (#name), positive, and of a tag (name, /name) or of an element by the head of a name (@head), negative."""
    out = {}
    for f in {f for f, _ in counts}:
        inside, outside = counts.get((f, True), 0), counts.get((f, False), 0)
        share = (outside + WEIGHT * _prior(f)) / (inside + outside + WEIGHT)
        out[f] = _score(f, share)
    return out


def _prior(feature: str) -> float:
    name = feature.strip("/#@")
    if feature[:1] == "@":
        return PRIOR["no text" if name in NO_TEXT else "text"]
    return PRIOR["inline" if name in INLINE else "text" if name in TEXT_TAGS else "frame"]


def _score(feature: str, outside: float) -> float:
    return max(0.05, 1 - outside) if feature[0] == "#" else -LEAST - MOST * outside


def _weight(feature: str, learned: dict[str, float]) -> float:
    w = learned.get(feature)
    return _score(feature, _prior(feature)) if w is None else w


def best_region(scores: list[float]) -> tuple[int, int]:
    """Begin and end of the contiguous stretch of the greatest sum; the first and shortest among equals."""
    best, begin, end, total, start = 0.0, 0, 0, 0.0, 0
    for k, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, k
        total += s
        if total > best:
            best, begin, end = total, start, k + 1
    return begin, end


def _region(nodes: list[Node], kept: list[int], learned: dict[str, float]) -> list[int]:
    """Places of the best region's nodes."""
    words = [len(nodes[k].text.split()) if nodes[k].kind == "text" else 0 for k in kept]
    score = []
    for k, n in zip(kept, words, strict=True):
        if nodes[k].kind == "text":
            score.append(n * _weight("#" + nodes[k].frame, learned))
        else:
            score.append(min(_weight(f, learned) for f in _features(nodes[k])))
    begin, end = best_region(score)
    marked = [n if nodes[k].marked else 0 for k, n in zip(kept, words, strict=True)]
    if sum(marked[begin:end]) >= INSIDE * max(1, sum(words[begin:end])) or _mark_counts(nodes, kept, words, sum(marked), begin, end):
        score = [(n if nodes[k].marked else -n) if nodes[k].kind == "text" else -LEAST if nodes[k].marked else min(s, -1.0) for k, n, s in zip(kept, words, score, strict=True)]
        begin, end = best_region(score)
    return kept[begin:end]


def _mark_counts(nodes: list[Node], kept: list[int], words: list[int], marked: int, begin: int, end: int) -> bool:
    """Whether the page's only mark is to be believed though the region between these places isn't its: it holds SHARE of the words, or what is outside is no prose but teasers."""
    if not marked or sum(n.kind == "open" and n.name == "article" for n in nodes) != 1:
        return False
    if marked >= SHARE * sum(words):
        return True
    blocks, size = [], 0
    for k, n in zip(kept[begin:end], words[begin:end], strict=True):
        if nodes[k].kind == "text":
            size += 0 if nodes[k].marked else n
        elif nodes[k].name not in INLINE and size:
            blocks.append(size)
            size = 0
    blocks = sorted([*blocks, size] if size else blocks)
    return not blocks or blocks[len(blocks) // 2] < PROSE


def extract(html: str | None, learned: dict[str, float]) -> str:
    if not html:
        return ""
    nodes = parse(html)

    def text(named: bool) -> str:
        parts = [nodes[k].text if nodes[k].kind == "text" else "" if nodes[k].name in INLINE else " " for k in _region(nodes, wanted(nodes, named), learned)]
        return " ".join("".join(parts).split())

    found = text(True)
    if len(found.split()) < FEW and any(n.out == 1 for n in nodes):
        other = text(False)
        if len(found.split()) < LEFT * len(other.split()):
            return other
    return found


def learn(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE) -> dict[str, float]:
    """Weights from those of about `sample` pages that mark their article; one row per feature comes back."""
    some = sampled(pages.select(id_col, html_col), id_col, html_col, sample)

    def work(texts: list) -> list:
        return [pa.array([[{"f": f, "inside": i, "n": n} for (f, i), n in count_features(t or "").items()] for t in texts], pa.list_(pa.struct([("f", pa.string()), ("inside", pa.bool_()), ("n", pa.int64())])))]

    rows = per_text(some, [], html_col, "c array<struct<f:string,inside:boolean,n:bigint>>", work).select(F.inline("c")).groupBy("f", "inside").agg(F.sum("n").alias("n")).collect()
    return weights({(r["f"], r["inside"]): r["n"] for r in rows})


def main_text(pages: DataFrame, learned: dict[str, float], id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, the columns of keep, text and n_chars (code points) of every page."""

    def work(texts: list) -> list:
        found = [extract(t, learned) for t in texts]
        return [pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())]

    return per_text(pages, [id_col, *keep], html_col, "text string, n_chars bigint", work)


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return main_text(pages, learn(pages), keep=("url",))
