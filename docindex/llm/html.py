"""Main-text extraction with a tree-structured graphical model.

The DOM is a tree of binary variables: an element is content or it isn't.
Potentials between parent and child say how labels pass down, by the child's
tag; evidence at each element comes from its tag, the words of its class, id and
role, its text, and how much of its subtree is link text.  Sum-product
messages go up from the leaves and down from the root and give each element's
marginal; text whose element is more likely content than not is kept.

All parameters are counts over labelled pages: a set of layouts built here
(content marked), and a bounded sample of given pages whose own markup marks
one article.  The messages of all pages of a batch are computed together,
depth by depth.
"""

from __future__ import annotations

import html as _html
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zlib
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, lean

#: Pages of the given table that may join the labelled layouts, at most.
SAMPLE = 400
FEATURE_BITS = 14
#: Weights of the evidence of tag, own text and links: an element's neighbours
#: and its tag's place in the tree say much of the same again.
TEMPER = (0.5, 0.5, 0.5)

# Element names of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = set("script style noscript template head title svg iframe object canvas audio video select option textarea button datalist".split())
# Without svg (a drawing's labels), noscript (said to readers without scripts only: a
# notice) and object, audio, video, canvas, iframe (said where the thing itself can't
# be shown): none of these is text that a reader of the article sees.
RAW = set("script style textarea title noscript iframe".split())
INLINE = set("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split())
# A formula is text of the element around it; its parts are no elements of their own.
FORMULA = set("math semantics annotation annotation-xml maction menclose merror mfenced mfrac mi mlabeledtr mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt"
              " mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none".split())
CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
# An opening tag ends an open one of these, up to the nearest barrier.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"},
        "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}}
BARRIER = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}}

# An attribute: its name, and a value that is quoted only if a quote comes straight
# after "="; any other quote, and one that nothing closes, is an ordinary character.
_ATTRIBUTE = r"[^\s/>][^\s/>=]*(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]*))?"
_TAG = re.compile(rf"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]+|{_ATTRIBUTE})*+)(?:>|(\Z))|<[!?][^>]*(?:>|$)|<[/a-zA-Z][^>]*$", re.S)
_ATTR = re.compile(r"([^\s/>][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_SPLIT = re.compile(r"[^a-z]+")
# What follows the name in a closing tag is ignored.
_END_OF = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in RAW}
MARK = "data-content"


@dataclass
class Page:
    """Elements in document order (parents first), and text pieces."""

    tags: list[str] = field(default_factory=lambda: ["#root"])
    parents: list[int] = field(default_factory=lambda: [-1])
    words: list[list[str]] = field(default_factory=lambda: [[]])
    marks: list[str | None] = field(default_factory=lambda: [None])
    pieces: list[tuple[int, str]] = field(default_factory=list)  # element, decoded text; -1: a block edge


def parse(source: str) -> Page:
    """Elements and texts of a page; broken markup closes as browsers do, but
    for a quoted value without end, which would swallow the rest of the page:
    there the tag ends at the next ``>``.  A tag cut off by the end of the page
    is dropped."""
    page, stack, pos, n = Page(), [0], 0, len(source)
    tags, pieces = page.tags, page.pieces

    def text(a, b):
        if a < b:
            t = source[a:b]
            pieces.append((stack[-1], _html.unescape(t) if "&" in t else t))

    def pop_to(k):
        for e in stack[k:]:
            if tags[e] not in INLINE:
                pieces.append((-1, ""))
        del stack[k:]

    while pos < n:
        m = _TAG.search(source, pos)
        if m is None:
            text(pos, n)
            break
        text(pos, m.start())
        pos = m.end()
        name = m.group(2)
        if not name or m.group(4) is not None:
            continue
        name = name.lower()
        if name in FORMULA:
            continue
        if m.group(1):
            for k in range(len(stack) - 1, 0, -1):
                if tags[stack[k]] == name:
                    pop_to(k)
                    break
            else:
                if name == "p":
                    pieces.append((-1, ""))
            continue
        ends = {"p"} if name in CLOSES_P else ENDS.get(name)
        if ends:
            stop = BARRIER.get(name, {"table"} if name in ("td", "th", "tr") else {"button", "td", "th", "table", "object"})
            for k in range(len(stack) - 1, 0, -1):
                t = tags[stack[k]]
                if t in ends:
                    pop_to(k)
                    if name == "p" or name in CLOSES_P:
                        break
                elif t in stop:
                    break
        if name == "br":
            pieces.append((stack[-1], " "))
            continue
        words, mark = [], None
        if m.group(3) and not m.group(3).isspace():
            for key, a, b, c in _ATTR.findall(m.group(3)):
                key = key.lower()
                if key in ("class", "id", "role"):
                    words += [w for w in _SPLIT.split((a or b or c).lower()) if w]
                elif key == "hidden" or (key == "style" and "display:none" in (a or b or c).replace(" ", "").lower()) or (key == "aria-hidden" and (a or b or c) == "true"):
                    words.append("#hidden")
                elif key == MARK:
                    mark = a or b or c
        if name not in INLINE:
            pieces.append((-1, ""))
        me = len(tags)
        tags.append(name)
        page.parents.append(stack[-1])
        page.words.append(words)
        page.marks.append(mark)
        if name in VOID:
            continue
        if name in RAW:
            end = _END_OF[name].search(source, pos)
            pos = end.end() if end else n
            continue
        if m.group(3).rstrip().endswith("/") and name in ("svg", "path"):
            continue
        stack.append(me)
    return page


def _id(kind: str, value) -> int:
    return zlib.crc32(f"{kind}:{value}".encode()) & ((1 << FEATURE_BITS) - 1)


_ids: dict = {}


def feature(kind: str, value) -> int:
    got = _ids.get((kind, value))
    if got is None:
        got = _id(kind, value)
        if len(_ids) < 100_000:
            _ids[(kind, value)] = got
    return got


def _bucket(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, np.floor(np.log2(np.maximum(x, 1)) / 1.5) + 1, 0).astype(int)


@dataclass
class Forest:
    """Several pages as one set of arrays; roots have parent -1."""

    pages: list[Page]

    def __post_init__(self):
        sizes = [len(p.tags) for p in self.pages]
        self.base = np.append(0, np.cumsum(sizes)).astype(int)
        parent = np.array([q + b if q >= 0 else -1 for p, b in zip(self.pages, self.base.tolist()) for q in p.parents], int)
        self.parent, self.n = parent, len(parent)
        self.tags = [t for p in self.pages for t in p.tags]
        depth = np.zeros(self.n, int)
        level, self.levels = np.flatnonzero(parent < 0), []
        order = np.argsort(parent, kind="stable")
        first = np.searchsorted(parent[order], np.arange(self.n))
        last = np.searchsorted(parent[order], np.arange(self.n), side="right")
        while len(level):
            self.levels.append(level)
            depth[level] = len(self.levels) - 1
            k = last[level] - first[level]
            at = np.arange(int(k.sum())) + np.repeat(first[level] - (np.cumsum(k) - k), k)
            level = order[at]
        own, link = np.zeros(self.n), np.zeros(self.n)
        for p, b in zip(self.pages, self.base.tolist()):
            for e, t in p.pieces:
                if e >= 0:
                    own[b + e] += len(t.strip())
        is_a = np.array([t == "a" for t in self.tags])
        whole = own.copy()
        for level in reversed(self.levels[1:]):
            np.add.at(whole, parent[level], whole[level])
        link[is_a] = whole[is_a]
        for level in reversed(self.levels[1:]):
            lv = level[~is_a[level]] if len(level) else level
            la = level[is_a[level]]
            np.add.at(link, parent[lv], link[lv])
            np.add.at(link, parent[la], whole[la])
        share = np.round(np.minimum(link / np.maximum(whole, 1), 1) * 5).astype(int)
        ob, wb = _bucket(own), _bucket(whole)
        rows, cols, vals = [], [], []
        i = 0
        for p in self.pages:
            for t, words in zip(p.tags, p.words):
                f = [feature("tag", t), feature("own", int(ob[i])), feature("link", (int(share[i]), int(wb[i]) > 3)), *(feature("word", w) for w in set(words))]
                rows += [i] * len(f)
                cols += f
                vals += [*TEMPER, *[1.0] * (len(f) - 3)]
                i += 1
        self.vals, self.rows, self.cols = np.array(vals, float), np.array(rows, int), np.array(cols, int)
        self.kind = np.array([feature("pair", t) for t in self.tags], int)


@dataclass(frozen=True)
class Model:
    evidence: np.ndarray  # log odds of each feature
    stay: np.ndarray  # P(child content | parent content), by the child's kind
    begin: np.ndarray  # P(child content | parent not), by the child's kind


def fit(pages: list[tuple[Page, np.ndarray]]) -> Model:
    """Counts over labelled pages, smoothed."""
    forest = Forest([p for p, _ in pages])
    y = np.concatenate([x for _, x in pages]).astype(bool)
    size = 1 << FEATURE_BITS
    seen = [np.bincount(forest.cols[y[forest.rows] == v], minlength=size) + 0.5 for v in (False, True)]
    total = [max((y == v).sum(), 1) + 1.0 for v in (False, True)]
    evidence = np.log(seen[1] / total[1]) - np.log(seen[0] / total[0])
    evidence[seen[0] + seen[1] == 1] = 0
    child = np.flatnonzero(forest.parent >= 0)
    up = y[forest.parent[child]]

    def part(mask, prior):
        k = forest.kind[child[mask]]
        hit = np.bincount(k[y[child[mask]]], minlength=size)
        every = np.bincount(k, minlength=size)
        return np.clip((hit + prior * 4) / (every + 4), 0.005, 0.995)
    stay = part(up, 0.95)
    begin = part(~up, 0.05)
    return Model(np.clip(evidence, -6, 6), stay, begin)


def marginals(forest: Forest, model: Model) -> np.ndarray:
    """Each element's probability of being content."""
    log = np.log
    odds = np.bincount(forest.rows, model.evidence[forest.cols] * forest.vals, minlength=forest.n)
    odds = np.clip(odds, -25, 25)
    stay, begin = model.stay[forest.kind], model.begin[forest.kind]
    up = np.zeros(forest.n)
    for level in reversed(forest.levels[1:]):  # to the parents
        e = np.exp(np.clip(odds[level], -30, 30))
        s, b = stay[level], begin[level]
        up[level] = log((s * e + 1 - s) / (b * e + 1 - b))
        np.add.at(odds, forest.parent[level], up[level])
    if forest.levels:
        odds[forest.levels[0]] -= 3.0  # a page as a whole is rarely content
    for level in forest.levels[1:]:  # to the children
        x = np.clip(odds[forest.parent[level]] - up[level], -30, 30)
        p = 1 / (1 + np.exp(-x))
        s, b = stay[level], begin[level]
        one = s * p + b * (1 - p)
        odds[level] += log(one / (1 - one))
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def text_of(page: Page, keep: np.ndarray) -> str:
    """Kept text: one line a block, white space inside it as one space.

    Hidden text (hidden, aria-hidden, display:none) is evidence for the model
    and no more: that of the article is its text, as formulas are, in each
    form that the page holds."""
    unseen = np.zeros(len(page.tags), bool)
    for i, t in enumerate(page.tags):
        q = page.parents[i]
        unseen[i] = t in UNSEEN or (q >= 0 and unseen[q])
    blocks, now = [], []
    for e, t in [*page.pieces, (-1, "")]:
        if e >= 0:
            if keep[e] and not unseen[e]:
                now.append(t)
            elif now:
                now.append(" ")
        elif now:
            line = " ".join("".join(now).split())
            if line:
                blocks.append(line)
            now = []
    return "\n".join(blocks)


def labels_of(page: Page) -> np.ndarray | None:
    """Labels from marks: an element has its nearest marked ancestor's."""
    if not any(page.marks):
        return None
    y = np.zeros(len(page.tags), bool)
    for i in range(1, len(y)):
        m = page.marks[i]
        y[i] = m == "1" if m is not None else y[page.parents[i]]
    return y


def own_labels(page: Page) -> np.ndarray | None:
    """Labels from a page's own markup, if it has just one article or main."""
    tops = [i for i, t in enumerate(page.tags) if t == "article"] or [i for i, t in enumerate(page.tags) if t == "main"]
    if len(tops) != 1:
        return None
    out = set("nav aside footer form".split()) | UNSEEN
    y = np.zeros(len(page.tags), bool)
    for i in range(tops[0], len(y)):
        t = page.tags[i]
        y[i] = i == tops[0] or (y[page.parents[i]] and t not in out)
    return y


def layouts(seed: int = 11, count: int = 120, families: list[int] | None = None) -> list[str]:
    """Labelled pages of common layouts: ``data-content`` marks content (1)
    and what isn't content inside it (0).  A layout family is a way to hold the
    article; ``families`` restricts the pages to some of them."""
    rng = np.random.default_rng(seed)

    def words(n):
        return " ".join("".join(rng.choice(list("abdeghiklmnoprstu"), rng.integers(2, 9))) for _ in range(max(int(n), 1)))

    def prose(n):
        return " ".join(words(rng.integers(6, 18)).capitalize() + "." for _ in range(max(int(n), 1)))

    def links(n, sep=""):
        return sep.join(f'<li><a href="/x">{words(rng.integers(1, 4))}</a></li>' for _ in range(n))

    def body():
        out = [f"<h1>{words(6)}</h1>"]
        for _ in range(rng.integers(1, 9)):
            k = rng.integers(0, 12)
            out.append(f"<h2>{words(3)}</h2>" if k == 0 else f"<ul>{''.join(f'<li>{prose(1)}</li>' for _ in range(3))}</ul>" if k == 1 else f"<blockquote><p>{prose(2)}</p></blockquote>" if k == 2
                       else f"<table><tr><td>{words(3)}</td><td>{words(2)}</td></tr></table>" if k == 3 else f"<pre><code>{words(8)}</code></pre>" if k == 4
                       else f"<figure><img src='a'><figcaption>{words(6)}</figcaption></figure>" if k == 5 else f"<p>{prose(2)} <a href='/y'>{words(2)}</a> <em>{words(2)}</em> {prose(1)}</p>" if k == 6
                       else f"<p><b>{prose(rng.integers(1, 3))}</b></p>" if k == 7 else f"<p>{prose(rng.integers(1, 6))}")
        return out

    def extra():
        k = rng.integers(0, 10)
        c = ["ad", "advert", "advertisement", "promo", "sponsored", "banner", "ads"][rng.integers(0, 7)]
        return [f'<div class="{c}">{prose(1)}</div>', f'<aside class="related"><h3>{words(2)}</h3><ul>{links(4)}</ul></aside>', f'<div class="share social"><a href="/s">{words(1)}</a> <a href="/t">{words(1)}</a></div>',
                f'<form class="newsletter subscribe"><label>{words(4)}</label><input name="q"><button>{words(1)}</button></form>', f'<nav class="breadcrumb toc"><a href="/">{words(1)}</a> <a href="/b">{words(2)}</a></nav>',
                f'<div class="notice cookie"><p>{prose(1)}</p></div>', f'<p class="byline meta author">{words(4)}</p>', f'<div class="tags">{links(3)}</div>', f'<figure class="ad"><p>{words(5)}</p></figure>', f'<div class="popup modal"><p>{prose(1)}</p></div>'][k]

    def comments():
        one = lambda: f'<div class="comment reply"><p class="author">{words(2)}</p><p>{prose(rng.integers(1, 4))}</p></div>'
        tag = ["section", "div", "ol"][rng.integers(0, 3)]
        return f'<{tag} id="comments" class="comments discussion responses"><h3>{words(1)}</h3>{one()}{one()}{one()}</{tag}>'

    holders = ['<article {m}>|</article>', '<main {m}>|</main>', '<main><article class="post" {m}>|</article></main>', '<div id="content" class="content" {m}>|</div>', '<div class="post entry"><div class="entry content body" {m}>|</div></div>',
               '<div class="article" id="article" {m}>|</div>', '<div id="main"><div class="text story" {m}>|</div></div>', '<section class="article body" {m}>|</section>', '<div role="main" {m}>|</div>', '<table><tr><td class="menu"><ul>{l}</ul></td><td class="content main" {m}>|</td></tr></table>']
    if families is not None:
        holders = [holders[k] for k in families]
    pages = []
    for _ in range(count):
        inner = body()
        for _ in range(rng.integers(0, 3)):
            inner.insert(rng.integers(1, len(inner) + 1), re.sub(r"^<(\w+)", rf'<\1 {MARK}="0"', extra()))
        if rng.random() < 0.25:
            inner.append(re.sub(r"^<(\w+)", rf'<\1 {MARK}="0"', comments()))
        hold = holders[rng.integers(0, len(holders))].replace("{m}", f'{MARK}="1"').replace("{l}", links(5))
        top = [f'<nav><ul>{links(6)}</ul></nav>', f'<header class="site header"><a href="/">{words(2)}</a><p>{words(5)}</p><nav>{links(4)}</nav></header>', f'<div id="header" class="masthead"><h1><a href="/">{words(2)}</a></h1><ul class="menu nav">{links(5)}</ul></div>', f'<ul class="menu navigation">{links(7)}</ul>']
        end = [f"<footer><p>&copy; {words(3)}</p></footer>", f"<footer>&copy; {words(2)} &middot; {prose(1)}</footer>", f'<div id="footer" class="footer copyright"><p>{prose(1)}</p>{links(3)}</div>']
        side = [f'<aside class="sidebar"><h3>{words(2)}</h3><ul>{links(6)}</ul><p>{prose(2)}</p></aside>', f'<div class="sidebar widget" id="sidebar"><h4>{words(1)}</h4><p>{prose(2)}</p></div>', f'<div class="related recommended"><ul>{links(4)}</ul></div>', ""]
        before = [side[rng.integers(0, 4)], *(extra() for _ in range(rng.integers(0, 3)))]
        after = [side[rng.integers(0, 4)], comments() if rng.random() < 0.4 else "", *(extra() for _ in range(rng.integers(0, 2)))]
        pages.append(f"<html><head><title>{words(4)}</title></head><body {MARK}='0'>{top[rng.integers(0, 4)]}{''.join(before)}{hold.replace('|', ''.join(inner))}{''.join(after)}{end[rng.integers(0, 3)]}</body></html>")
    return pages


def train(pages: DataFrame | None = None) -> Model:
    """A model from the labelled layouts and, if given, at most SAMPLE of
    ``pages`` (page_id, html) that mark one article themselves."""
    labelled = [(p, labels_of(p)) for p in map(parse, layouts())]
    if pages is not None:
        # a hash of the id draws about half of SAMPLE, so few pages travel
        dice = F.pmod(F.xxhash64(F.lit("pages"), "page_id"), F.lit(1 << 20))
        drawn = pages.where("html is not null").where(dice < min(1.0, SAMPLE / 2 / max(pages.count(), 1)) * (1 << 20))
        some = drawn.select("html", F.xxhash64("page_id").alias("h")).orderBy("h", F.length("html")).limit(SAMPLE).select("html")
        labelled += [(p, y) for p in map(parse, sorted(r.html for r in some.collect())) if (y := own_labels(p)) is not None]
    return fit(labelled)


def _extract(shared, columns):
    def run(batches):
        model = Model(*shared.value)
        for batch in batches:
            sources = batch.column("html")
            i = 0
            while i < batch.num_rows:
                j, size, pages = i, 0, []
                while j < batch.num_rows and (j == i or size < 1 << 20):
                    source = sources[j].as_py()
                    size += len(source)
                    pages.append(parse(source))
                    j += 1
                forest = Forest(pages)
                keep = marginals(forest, model) > 0.5
                out = [text_of(p, keep[a:b]) for p, a, b in zip(pages, forest.base[:-1].tolist(), forest.base[1:].tolist())]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in columns), pa.array(out, pa.string())], names=[*columns, "text"])
                i = j
    return run


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """``row`` (a struct of the columns of ``pages`` but html) and text, for
    every row.  Null, empty and tag-free pages without content give ''.

    An element whose marginal is exactly one half is no content; repeated pages
    give repeated rows; very long pages are read whole, in memory of some
    hundred bytes an element; columns of any name travel in ``row``."""
    spark = pages.sparkSession
    bounded_batches(spark)
    rest = [F.col(f"`{c}`") for c in pages.columns if c != "html"]
    df = pages.select(F.struct(*rest).alias("row"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    kind = df.schema["row"].dataType.simpleString()
    return df.mapInArrow(lean(_extract(spark.sparkContext.broadcast((model.evidence, model.stay, model.begin)), ["row"])), f"row {kind}, text string")
