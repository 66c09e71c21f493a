"""HTML extraction with a tree-structured graphical model over the DOM.

Every element and text run is a node with one of three labels: boilerplate, content, or mixed (holds both). The model:
a prior at the root, parent-child potentials P(label of child | label of parent, kind of child), and node potentials from
the tag, words of class and id, text length, link density and punctuation. All are smoothed log-odds counted on labelled
pages. Inference is exact: messages are summed upward to the root and downward again, all pages of a batch level by level;
text runs whose content marginal exceeds one half are kept.

The labelled pages are drawn by `labelled_pages`, a seeded generator of site layouts (TRAINING_PAGES of them, a bound on
what the driver fits). Parsing is forgiving: unclosed and misnested tags, comments, raw-text elements. A bracket that
begins no tag is text; a tag with an unclosed quote ends at the next bracket; of elements whose content is no text an
unclosed script or style takes the rest of the page, any other unclosed one only its tag.

Edge cases: null or empty html gives the empty text; a page without content gives the empty text; an empty table gives no
rows; repeated rows and ids repeat, null ids stay null; a marginal of exactly one half counts as no content; other columns
are ignored, whatever their names; very deep and very long pages are read in linear time and handled level by level
without recursion (a page and its tree must fit a worker's memory).
"""

from __future__ import annotations

import functools
import html as html_lib
import random
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, slices

BOILER, CONTENT, MIXED = 0, 1, 2
TRAINING_PAGES = 1500
SMOOTH = 0.5
#: Damps features that say the same thing twice.
WEIGHT = 0.6

# Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg math title".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
CLOSES_SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"), "td": ("tr",), "th": ("tr",), "option": ("select",)}

_NAME = re.compile(r"/?[a-zA-Z][^\s/<>]*+")
#: Attributes up to the tag's end. The strict form, in which quotes hold no tags either, costs the tag's own length only.
_ATTRIBUTES = re.compile(r"(?:[^<>\"']|\"[^\"]*+\"|'[^']*+')*+")
_STRICT = re.compile(r"(?:[^<>\"']|\"[^\"<>]*+\"|'[^'<>]*+')*+")
_NAMES = re.compile(r"(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"\bhidden\b|display\s*:\s*none", re.I)
_RAW_END = {t: re.compile(rf"</{t}(?:\s[^>]*+)?>", re.I) for t in RAW}
#: Elements that may end in "/>" themselves, and those whose content is never text, ended or not.
EMPTY_FORM = frozenset(("svg", "math"))
NEVER_TEXT = frozenset(("script", "style"))


class Tree:
    """Parallel lists in page order: parent, depth, tag (#text for runs), attribute words, text, inline."""

    __slots__ = ("depth", "links", "names", "parent", "sizes", "tag", "text")

    def __init__(self) -> None:
        self.parent, self.depth, self.tag, self.names, self.text = [-1], [0], ["#root"], [()], [""]

    def add(self, parent: int, tag: str, names: tuple = (), text: str = "") -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.tag.append(tag)
        self.names.append(names)
        self.text.append(text)
        return len(self.tag) - 1


def _attribute_words(attributes: str) -> tuple[str, ...]:
    words = [w for m in _NAMES.findall(attributes) for part in m if part for w in _WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", part).lower())]
    return tuple(dict.fromkeys(words + (["hidden"] if _HIDDEN.search(attributes) else [])))


_kept_words = functools.lru_cache(maxsize=20_000)(_attribute_words)


def attribute_words(attributes: str) -> tuple[str, ...]:
    return _kept_words(attributes) if len(attributes) < 500 else _attribute_words(attributes)


def markup(page: str, skip: list[int]) -> Iterator[tuple[int, int, str, str]]:
    """(begin, end, name, attributes) of every piece of markup in order, `/name` for end tags and "" for comments and the
    like. What follows an unclosed quote is read again without quotes; a `<` that begins no tag is text. The reader may set
    skip[0]: nothing before that place is looked at."""
    n, at, read = len(page), 0, 0
    while (begin := page.find("<", max(at, skip[0]))) >= 0:
        at = begin + 1
        if page.startswith("<!--", begin) or page.startswith("<![CDATA[", begin):
            mark = "-->" if page[begin + 2] == "-" else "]]>"
            close = page.find(mark, begin + 4)
            at = n if close < 0 else close + 3
            yield begin, at, "", ""
        elif page[at : at + 1] in ("!", "?"):
            close = page.find(">", at)
            if close >= 0:
                at = close + 1
                yield begin, at, "", ""
        elif name := _NAME.match(page, at):
            rest = None
            if begin >= read:
                rest = _ATTRIBUTES.match(page, name.end())
                if page[rest.end() : rest.end() + 1] != ">":
                    rest, read = None, rest.end()  # up to here only the strict form is tried: each character is read twice at most
            if rest is None:
                rest = _STRICT.match(page, name.end())
                if page[rest.end() : rest.end() + 1] in ('"', "'"):  # an unclosed quote: the tag ends at the first bracket
                    stop = re.compile("[<>]").search(page, rest.end())
                    if stop and stop[0] == ">":
                        at = stop.end()
                        yield begin, at, name[0].lower(), page[name.end() : stop.start()]
                    continue
                if page[rest.end() : rest.end() + 1] != ">":
                    continue
            at = rest.end() + 1
            yield begin, at, name[0].lower(), rest[0]


def parse(page: str) -> Tree:
    tree = Tree()
    stack = [0]
    at = 0
    n = len(page)
    opened: dict[str, int] = defaultdict(int)
    endless: set[str] = set()

    def text(end: int) -> None:
        if end > at and not (run := page[at:end]).isspace():
            tree.add(stack[-1], "#text", (), html_lib.unescape(run) if "&" in run else run)
        elif end > at:
            tree.add(stack[-1], "#space", (), " ")

    def close(depth: int) -> None:
        for node in stack[depth:]:
            opened[tree.tag[node]] -= 1
        del stack[depth:]

    skip = [0]
    for begin, end, tag, attributes in markup(page, skip):
        text(begin)
        at = end
        if not tag:
            continue
        if tag[0] == "/":
            if opened[tag[1:]]:
                close(next(i for i in range(len(stack) - 1, 0, -1) if tree.tag[stack[i]] == tag[1:]))
            continue
        if tag in RAW and not (tag in EMPTY_FORM and attributes.rstrip().endswith("/")):
            last = None if tag in endless else _RAW_END[tag].search(page, at)
            if last:
                at = skip[0] = last.end()
            elif tag in NEVER_TEXT:
                at = skip[0] = n
            else:
                endless.add(tag)
            continue
        if tag in EMPTY_FORM:
            continue
        if tag in CLOSES_P and opened["p"]:
            for i in range(len(stack) - 1, 0, -1):
                if (t := tree.tag[stack[i]]) == "p":
                    close(i)
                    break
                if t not in INLINE:
                    break
        if tag in CLOSES_SAME:
            alike = ("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,)
            if any(opened[t] for t in alike):
                for i in range(len(stack) - 1, 0, -1):
                    if (t := tree.tag[stack[i]]) in alike:
                        close(i)
                        break
                    if t in CLOSES_SAME[tag]:
                        break
        node = tree.add(stack[-1], tag, attribute_words(attributes) if attributes and not attributes.isspace() else ())
        if tag not in VOID and not attributes.rstrip().endswith("/"):
            stack.append(node)
            opened[tag] += 1
    if at < n:
        text(n)
    return tree


def measure(tree: Tree) -> None:
    """Text length and linked text length of every subtree."""
    n = len(tree.tag)
    sizes, links = [0] * n, [0] * n
    for i in range(n - 1, 0, -1):
        if tree.tag[i] == "#text":
            sizes[i] = len(tree.text[i])
        elif tree.tag[i] == "a":
            links[i] = sizes[i]
        sizes[tree.parent[i]] += sizes[i]
        links[tree.parent[i]] += links[i]
    tree.sizes, tree.links = sizes, links


def features(tree: Tree) -> list[tuple]:
    """For each node the features that its potential is the sum of."""
    out = []
    tag, parent, text = tree.tag, tree.parent, tree.text
    for i in range(len(tag)):
        size, link = tree.sizes[i], tree.links[i]
        if tag[i] == "#text":
            up = tag[parent[i]]
            marks = text[i].count(".") + text[i].count(",")
            out.append((("size", min(size.bit_length(), 9)), ("marks", min(marks, 3)), ("in", up if up in KNOWN_TAGS else "other")))
        else:
            share = 0 if not size else 1 + min(3, 4 * link // size)
            under = tag[parent[i]]
            out.append((("tag", tag[i]), ("under", under if under in KNOWN_TAGS else "other", GROUP.get(tag[i], 5)), ("volume", min(size.bit_length(), 12) // 2), ("linked", share), *[("name", w) for w in tree.names[i]]))
    return out


#: Kinds of child in the parent-child potentials; other elements are kind 5.
GROUP = {"#text": 0, "#space": 0} | dict.fromkeys("p blockquote pre figure figcaption table tbody tr td th br".split(), 1) | dict.fromkeys("h1 h2 h3 h4 h5 h6".split(), 2) | dict.fromkeys("ul ol li dl dt dd".split(), 3) | dict.fromkeys(INLINE, 4) | {"article": 6, "main": 6}
KNOWN_TAGS = frozenset("article main body aside nav footer header form blockquote figure ul ol p a li h1 h2 h3 h4 div span td b i em strong article section blockquote pre label button figcaption dd dt".split())


class Model:
    """Log potentials. kind of an edge: the kind of its child."""

    def __init__(self) -> None:
        self.edge = np.full((7, 3, 3), SMOOTH)
        self.seen: dict[object, list[float]] = defaultdict(lambda: [SMOOTH] * 3)
        self.totals = [3 * SMOOTH] * 3
        self.cache: dict[tuple, tuple[float, float, float]] = {}

    def fit(self, pages: list[tuple[Tree, list[int]]]) -> Model:
        for tree, labels in pages:
            for i, own in enumerate(features(tree)):
                self.totals[labels[i]] += 1
                for f in own:
                    self.seen[f][labels[i]] += 1
                if i:
                    self.edge[GROUP.get(tree.tag[i], 5), labels[tree.parent[i]], labels[i]] += 1
        self.log_edge = np.log(self.edge / self.edge.sum(axis=2, keepdims=True))
        self.prior = np.log(np.array([0.05, 0.05, 0.9]))
        self.seen = dict(self.seen)
        return self

    def potential(self, own: tuple) -> tuple[float, float, float]:
        if own not in self.cache:
            if len(self.cache) > 50_000:
                self.cache.clear()
            rows = [np.log(np.array(self.seen[f]) / np.array(self.totals)) for f in own if f in self.seen]
            self.cache[own] = tuple(WEIGHT * sum(rows)) if rows else (0.0, 0.0, 0.0)
        return self.cache[own]

    def marginals(self, trees: list[Tree]) -> list[np.ndarray]:
        """For each tree the content marginal of every node: sum-product upward, then downward."""
        starts = np.cumsum([0, *[len(t.tag) for t in trees]])
        unary = np.array([self.potential(own) for t in trees for own in features(t)]).reshape(-1, 3)
        parent = np.concatenate([np.array(t.parent) + s for t, s in zip(trees, starts, strict=False)])
        depth = np.concatenate([np.array(t.depth) for t in trees])
        edge = self.log_edge[np.array([GROUP.get(x, 5) for t in trees for x in t.tag])]  # node, parent's label, own label
        up, message = unary.copy(), np.zeros_like(unary)
        order = np.argsort(depth, kind="stable")
        levels = np.split(order, np.searchsorted(depth[order], np.arange(1, depth.max(initial=0) + 1)))
        for level in reversed(levels[1:]):
            message[level] = _logsum(edge[level] + up[level][:, None, :], 2)
            np.add.at(up, parent[level], message[level])
        down = np.zeros_like(unary)
        down[levels[0]] = self.prior
        for level in levels[1:]:
            outside = up[parent[level]] + down[parent[level]] - message[level]
            down[level] = _logsum(edge[level] + outside[:, :, None], 1)
            down[level] -= down[level].max(axis=1, keepdims=True)
        belief = up + down
        belief = np.exp(belief - belief.max(axis=1, keepdims=True))
        belief = belief[:, CONTENT] / belief.sum(axis=1)
        return [belief[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)]


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def content_text(tree: Tree, content: np.ndarray) -> str:
    """Blocks in page order: runs between block elements, white space turned into single spaces."""
    blocks, run = [], []
    last_block = -1
    block_of = [0] * len(tree.tag)
    for i in range(1, len(tree.tag)):
        p = tree.parent[i]
        block_of[i] = block_of[p] if tree.tag[i] in INLINE or tree.tag[i][0] == "#" else i
        if tree.tag[i] == "br":
            run.append(" ")
        if tree.tag[i] == "#text" and content[i] > 0.5 or tree.tag[i] == "#space":
            if block_of[i] != last_block:
                blocks.append("".join(run))
                run, last_block = [], block_of[i]
            run.append(tree.text[i])
        elif tree.tag[i][0] != "#" and tree.tag[i] not in INLINE and tree.tag[i] != "br":
            last_block = -1
    blocks.append("".join(run))
    return " ".join(w for b in blocks for w in b.split())


MARK = ""


def labels_of(tree: Tree) -> list[int]:
    """Labels of a generated page: text runs by their mark, which is removed; elements by what they hold."""
    n = len(tree.tag)
    holds = [0] * n
    for i in range(n - 1, 0, -1):
        if tree.tag[i] == "#text":
            holds[i] = 2 if MARK in tree.text[i] else 1
            tree.text[i] = tree.text[i].replace(MARK, "")
        holds[tree.parent[i]] |= holds[i]
    return [MIXED if h == 3 else CONTENT if h == 2 else BOILER for h in holds]


def labelled_pages(n: int = TRAINING_PAGES, seed: int = 11) -> list[str]:
    """Generated pages of varied layout; content runs carry the mark."""
    r = random.Random(seed)
    syllables = "ka lo mi ren tas vo du pel sor ni ba gra tel um es ora ti con pre la de".split()

    def word() -> str:
        return "".join(r.choice(syllables) for _ in range(r.randint(1, 3)))

    def words(a: int, b: int) -> str:
        return " ".join(word() for _ in range(r.randint(a, b)))

    def sentence() -> str:
        return words(4, 14).capitalize().replace(" ", ", ", r.randint(0, 1)) + r.choice("...!?")

    def pick(*names: str) -> str:
        return f' {r.choice(("class", "class", "id"))}="{r.choice(names)}"'

    def body(mark: str, lo: int, hi: int) -> str:
        return mark + " ".join(sentence() for _ in range(r.randint(lo, hi)))

    def paragraph(mark: str = MARK) -> str:
        s = body(mark, 1, 8)
        if r.random() < 0.3:
            s += f" <{(t := r.choice(('b', 'em', 'i', 'strong', 'code', 'span')))}>{mark}{words(1, 3)}</{t}> {mark}{sentence()}"
        if r.random() < 0.25:
            s += f' <a href="/{word()}">{mark}{words(1, 4)}</a>{mark}, {words(2, 6)}.'
        return s

    def article() -> str:
        out = [f"<h1>{MARK}{words(2, 9).capitalize()}</h1>"] if r.random() < 0.85 else []
        for _ in range(r.randint(1, 12)):
            x = r.random()
            if x < 0.72:
                out.append(f"<p>{paragraph()}" + ("</p>" if r.random() < 0.85 else ""))
            elif x < 0.8:
                out.append(f"<h{(k := r.randint(2, 4))}>{MARK}{words(1, 6).capitalize()}</h{k}>")
            elif x < 0.87:
                out.append(f"<ul>{''.join(f'<li>{MARK}{sentence()}</li>' for _ in range(r.randint(2, 6)))}</ul>")
            elif x < 0.91:
                out.append(f"<blockquote><p>{paragraph()}</p></blockquote>")
            elif x < 0.94:
                out.append(f"<figure><img src='x.png'><figcaption>{MARK}{sentence()}</figcaption></figure>")
            elif x < 0.97:
                out.append(f"<table><tr><th>{MARK}{words(1, 2)}</th><th>{MARK}{words(1, 2)}</th></tr><tr><td>{MARK}{words(1, 4)}</td><td>{MARK}{r.randint(1, 999)}</td></tr></table>")
            else:
                out.append(f"<div>{MARK}{sentence()}</div>")
            if r.random() < 0.06:
                out.append(advert())
            if r.random() < 0.04:
                out.append(share())
        return "".join(out)

    def items(a: int, b: int) -> str:
        return "".join(f'<li><a href="/{word()}">{words(1, 3)}</a></li>' for _ in range(r.randint(a, b)))

    def menu() -> str:
        x = r.random()
        inner = f"<ul>{items(2, 9)}</ul>" if x < 0.7 else " ".join(f'<a href="/{word()}">{words(1, 2)}</a>' for _ in range(r.randint(2, 8)))
        return f"<nav>{inner}</nav>" if r.random() < 0.6 else f"<div{pick('nav', 'menu', 'navbar', 'breadcrumb', 'breadcrumbs', 'main-menu', 'topbar')}>{inner}</div>"

    def header() -> str:
        inner = f"<a href='/'>{words(1, 2)}</a><p>{words(2, 7)}</p>" + (menu() if r.random() < 0.5 else "")
        return f"<header>{inner}</header>" if r.random() < 0.6 else f"<div{pick('header', 'site-header', 'masthead', 'banner', 'logo')}>{inner}</div>"

    def footer() -> str:
        inner = r.choice((f"&copy; {word()}.example &middot; {sentence()}", f"<p>&copy; {r.randint(1999, 2026)} {words(1, 3)}. {sentence()}</p>", f"<ul>{items(2, 6)}</ul><p>{sentence()}</p>", f"{sentence()} {sentence()}"))
        return f"<footer>{inner}</footer>" if r.random() < 0.7 else f"<div{pick('footer', 'site-footer', 'copyright', 'colophon', 'legal')}>{inner}</div>"

    def sidebar() -> str:
        inner = r.choice((f"<h3>{words(1, 3)}</h3><ul>{items(2, 8)}</ul>", f"<h4>{words(1, 3)}</h4><p>{body('', 1, 4)}</p>", f"<p>{body('', 1, 6)}</p><p>{body('', 1, 3)}</p>"))
        return f"<aside>{inner}</aside>" if r.random() < 0.5 else f"<div{pick('sidebar', 'side', 'widget', 'related', 'related-posts', 'recommended', 'popular', 'trending', 'teaser', 'more-stories', 'author-bio', 'tags')}>{inner}</div>"

    def advert() -> str:
        inner = r.choice((sentence(), f"{sentence()} {sentence()}", f'<a href="http://{word()}.example">{words(2, 8)}</a>', f"<p>{body('', 1, 5)}</p>"))
        return f"<div{pick('ad', 'ads', 'advert', 'advertisement', 'sponsored', 'promo', 'banner-ad', 'ad-slot', 'sponsor')}>{inner}</div>"

    def notice() -> str:
        inner = r.choice((f"<p>{body('', 1, 4)}</p><button>{word()}</button>", f"{sentence()} <a href='/p'>{words(1, 2)}</a>", body("", 1, 4)))
        return f"<div{pick('cookie', 'cookie-banner', 'consent', 'gdpr', 'notice', 'alert', 'popup', 'modal', 'overlay', 'paywall', 'newsletter', 'subscribe', 'warning')}>{inner}</div>"

    def form() -> str:
        return f"<form{r.choice(('', pick('search', 'signup', 'subscribe', 'login', 'contact')))}><label>{words(1, 4)}</label><input name='q'><p>{body('', 1, 3)}</p><select><option>{word()}<option>{word()}</select><button>{word()}</button></form>"

    def comments() -> str:
        one = lambda: f"<{(t := r.choice(('div', 'li', 'article')))}{pick('comment', 'comment-body', 'reply', 'response', 'user-comment')}><b>{word()}</b> <span>{r.randint(1, 28)}.{r.randint(1, 12)}.</span><p>{body('', 1, 6)}</p></{t}>"
        inner = f"<h3>{words(1, 2)}</h3>" + "".join(one() for _ in range(r.randint(1, 6)))
        return f"<{(t := r.choice(('section', 'div', 'div')))}{pick('comments', 'comment-list', 'discussion', 'disqus-thread', 'responses', 'reader-comments', 'replies')}>{inner}</{t}>"

    def share() -> str:
        return f"<div{pick('share', 'social', 'sharing', 'toolbar', 'byline', 'meta', 'buttons')}>" + r.choice((f"<ul>{items(2, 5)}</ul>", words(2, 6), f"<span>{words(1, 3)}</span> <a href='/s'>{word()}</a>")) + "</div>"

    def page() -> str:
        a = article()
        x = r.random()
        if x < 0.45:
            a = f"<article{r.choice(('', pick('post', 'article', 'entry', 'story')))}>{a}</article>"
        elif x < 0.6:
            a = f"<main>{a}</main>"
        elif x < 0.9:
            a = f"<{(t := r.choice(('div', 'section', 'div')))}{pick('content', 'post', 'article', 'entry-content', 'post-content', 'story-body', 'text', 'article-body', 'main-content', 'body-copy')}>{a}</{t}>"
        else:
            a = f"<div>{a}</div>"
        extra = [f() for f, p in ((advert, 0.5), (notice, 0.3), (form, 0.25), (share, 0.3), (sidebar, 0.35), (advert, 0.3)) if r.random() < p]
        parts = [*([header()] if r.random() < 0.5 else []), *([menu()] if r.random() < 0.75 else [])]
        r.shuffle(extra)
        cut = r.randint(0, len(extra))
        middle = "".join(extra[:cut]) + a + "".join(extra[cut:]) + (comments() if r.random() < 0.4 else "")
        if r.random() < 0.5:
            middle = f"<div{r.choice(('', pick('wrapper', 'container', 'page', 'layout', 'row')))}>{middle}</div>"
        parts += [middle, *([sidebar()] if r.random() < 0.3 else []), footer() if r.random() < 0.9 else ""]
        return f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{words(2, 8)}</title><style>p{{}}</style></head><body>{''.join(parts)}</body></html>"

    return [page() for _ in range(n)]


@functools.lru_cache(maxsize=1)
def trained() -> Model:
    pages = []
    for page in labelled_pages():
        tree = parse(page)
        labels = labels_of(tree)
        measure(tree)
        pages.append((tree, labels))
    return Model().fit(pages)


def extract(pages: list[str], model: Model) -> list[str]:
    trees = [parse(p) for p in pages]
    for t in trees:
        measure(t)
    return [content_text(t, m) for t, m in zip(trees, model.marginals(trees), strict=True)] if trees else []


def main_text(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """(page_id, url, text, n_chars). The model is fitted here, on the driver, and sent along."""
    model = trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 128):
            texts = extract(batch.column(2).to_pylist(), model)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    return map_arrow(rows, run, "id long, url string, text string, n_chars long").withColumnRenamed("id", id_col)


