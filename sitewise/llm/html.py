"""Main text of web pages: gradient-boosted trees over a page's nodes, decoded along the tree.

A page is read into block nodes and, below them, runs of text. Each node has features of its tag, attribute tokens, depth, siblings
and the density of text, links and forms in its subtree. Boosted trees, trained here in numpy on a bounded sample of
pages, say how likely a node belongs to the main text or holds some of it. Nodes are not cut off one by one: of
all choices in which a node that goes takes its descendants with it, the likeliest is taken, by one pass up and one
down. So no kept node stands under a dropped one.

Pages come without labels. The sample's nodes get theirs from what the page's own markup says (an article or main element
against navigation, advert, footer and the like), in copies whose tags and tokens are partly wiped, so that density and
place are learnt as well, and in copies with notices, forms, side bars and reader comments put in, whose places are known.

A null or empty page has an empty text; so has one in which nothing is kept. Markup errors never fail: what isn't a tag is
text, and missing end tags are supplied. Repeated rows have equal texts; null ids and urls are kept. An empty table gives an
empty result. Columns other than those named are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Generator, Iterator
from dataclasses import dataclass, field, replace
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewise.llm.boosting import Boosted, boost
from sitewise.llm.common import clean_columns, distinct_sample

#: Characters of an element's name that are looked at; none that means anything here is longer.
MOST_NAME = 64
#: At most so many distinct pages are learnt from: those with the least hashes of their text.
SAMPLE_PAGES = 150

#: Element names by what they mean for reading a page.
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp noscript template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
UNSEEN = frozenset("svg math canvas audio video object select datalist button head applet map".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul li dd dt tr td th body".split()
)
#: A start tag closes an open element of these names, looking no further than the stopping names.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "option": (("option",), ("select",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "body": (("head",), ()),
    "tbody": (("tbody", "thead", "tr"), ("table",)), "tfoot": (("tbody", "thead", "tr"), ("table",)),
}
#: Tokens of class, id and role that say what a node is for.
TOKENS = {
    "main": "article main content post entry story body text page document maincontent",
    "menu": "nav navigation menu navbar breadcrumb breadcrumbs toc pagination pager topbar skip",
    "frame": "header masthead footer foot bottom contentinfo copyright colophon legal banner",
    "side": "sidebar side aside rail related recommended widget widgets trending popular more tags complementary",
    "advert": "ad ads adv advert advertisement sponsor sponsored promo promotion dfp",
    "notice": "cookie cookies consent notice alert gdpr popup modal overlay newsletter subscribe signup toast",
    "reader": "comment comments reply replies respond discussion disqus reviews review",
    "form": "form login search share social sharing buttons register",
    "hidden": "hidden invisible sr-only collapse",
}
_KIND = {t: k for k, (_, names) in enumerate(TOKENS.items()) for t in names.split()}
_MAIN = list(TOKENS).index("main")
_TAGS = (
    ("article", "main"), ("section",), ("div", "center", "td", "th", "dd", "body", "html"), ("p", "blockquote", "pre", "dd", "dt"), ("h1", "h2", "h3", "h4", "h5", "h6"), ("ul", "ol", "menu", "dl"), ("li",),
    ("nav",), ("header",), ("footer",), ("aside",), ("form", "fieldset"), ("table", "tr", "tbody", "thead"), ("figure", "figcaption"), ("#text",),
)
_TAG = {t: k for k, names in enumerate(_TAGS) for t in names}

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_COMMENT_END = re.compile("--!?>")
_QUOTES = re.compile(r"[>\"']")
_ATTR = re.compile(r"""(?:^|[\s"'/])(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORDS = re.compile(r"[a-z][a-z\-]*[a-z]|[a-z]", re.I)
_SPACES = re.compile(r"[\x20\x09-\x0D\xA0]+")


@dataclass
class Nodes:
    """A page's nodes in page order: a node's subtree is the nodes up to its end."""

    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    tokens: list[frozenset] = field(default_factory=list)
    text: list[list[str]] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)
    inputs: list[int] = field(default_factory=list)

    def add(self, tag: str, parent: int, tokens: frozenset = frozenset()) -> int:
        for column, value in ((self.tag, tag), (self.parent, parent), (self.tokens, tokens), (self.text, []), (self.linked, 0), (self.inputs, 0)):
            column.append(value)
        return len(self.tag) - 1


def attribute_tokens(attributes: str) -> frozenset:
    found = set()
    for name, value in _ATTR.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "style":
            if "display:none" in value.replace(" ", "") or "visibility:hidden" in value.replace(" ", ""):
                found.add("hidden")
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            found.add("hidden")
        elif name != "aria-hidden":
            for word in _WORDS.findall(value):
                found.add(word)
                found.update(word.split("-"))
    return frozenset(found)


def tags(page: str) -> Generator[tuple[int, int, str | None, str | None], int | None, None]:
    """(start, stop, name, attributes) of each piece of markup: attributes are null for end tags, and so is the name for comments and declarations.

    A tag ends at the first > outside quotes. Where quotes don't close, tags up to there end at the first > of any kind. Where no > follows, what is left is
    text. The scan only goes forward: its time grows with the page's length, whatever is in it. The receiver may send a place to go on from.
    """
    at, loose, size = 0, 0, len(page)
    while True:
        start = page.find("<", at)
        if start < 0 or start + 1 >= size:
            return
        at, first = start + 1, page[start + 1]
        name = attributes = None
        if first in "!?":
            if page.startswith("!--", at):
                if page.startswith((">", "->"), at + 3):
                    stop = page.index(">", at) + 1
                else:
                    m = _COMMENT_END.search(page, at + 3)
                    stop = m.end() if m else size
            else:
                stop = page.find(">", at) + 1 or size
        elif first == "/":
            m = _NAME.match(page, at + 1, min(size, at + 1 + MOST_NAME))
            if not m:
                continue
            name, stop = m[0].lower(), page.find(">", m.end()) + 1 or size
        else:
            m = _NAME.match(page, at, min(size, at + MOST_NAME))
            if not m:
                continue
            stop = page.find(">", m.end()) + 1
            if not stop:
                return
            k = m.end()
            while k >= loose:
                q = _QUOTES.search(page, k)
                if q is None or q[0] == ">":
                    stop = q.end() if q else stop
                    break
                k = page.find(q[0], q.end()) + 1
                if not k:
                    loose = q.end()  # no tag before this quote is scanned past its first > again
                    break
            name, attributes = m[0].lower(), page[m.end() : stop - 1]
        further = yield start, stop, name, attributes
        at = max(stop, further or 0)


def parse(page: str) -> Nodes:
    """The block nodes and text runs of a page; scripts, styles, controls and drawings are left out."""
    nodes = Nodes()
    # open elements: name, its block node, whether it is a link, whether nothing in it is seen
    stack: list[tuple[str, int, bool, bool]] = [("#root", nodes.add("html", -1), False, False)]
    run, at, size = -1, 0, len(page)
    # where each name is open in the stack, and where elements that aren't inline are, so that no look at the open elements goes through them
    places: dict[str, list[int]] = defaultdict(list)
    blocks = [0]

    def last(names: tuple[str, ...]) -> int:
        return max((places[n][-1] for n in names if places[n]), default=0)

    def close_to(depth: int) -> None:
        nonlocal run
        for name, _, _, _ in stack[depth:]:
            places[name].pop()
        while blocks[-1] >= depth:
            blocks.pop()
        if any(block != stack[depth - 1][1] for _, block, _, _ in stack[depth:]):
            run = -1
        del stack[depth:]

    def text(data: str) -> None:
        nonlocal run
        _, block, link, unseen = stack[-1]
        if unseen or not data:
            return
        if "&" in data:
            data = entities.unescape(data)
        if run < 0:
            if not data.strip("\x20\t\n\x0b\f\r\xa0"):
                return
            run = nodes.add("#text", block)
        nodes.text[run].append(data)
        if link:
            nodes.linked[run] += len(data.strip())

    scan, further = tags(page), None
    while True:
        try:
            start, stop, name, attributes = scan.send(further)
        except StopIteration:
            break
        further = None
        text(page[at:start])
        at = stop
        if name is None:
            continue
        if attributes is None:
            depth = last((name,))
            # the end of an inline element closes no block
            if depth and (name not in INLINE or depth > blocks[-1]):
                close_to(depth)
            continue
        if name in RAW:
            end = _raw_end(name).search(page, at)
            at = further = end.end() if end else size
            if name == "textarea":
                nodes.inputs[stack[-1][1]] += 1
            continue
        if name == "br":
            text(" ")
            continue
        if name in VOID:
            if name == "input":
                nodes.inputs[stack[-1][1]] += 1
            if name == "hr":
                run = -1
            continue
        if name == "html":
            continue
        if name in CLOSES_P and blocks[-1] and blocks[-1] == last(("p",)):
            close_to(blocks[-1])
        if name in ENDS:
            names, stops = ENDS[name]
            while last(names) > last(stops):
                close_to(last(names))
                if name not in ("tr", "tbody", "tfoot"):
                    break
        if attributes.endswith("/") and name in ("svg", "math"):
            continue
        _, block, link, unseen = stack[-1]
        places[name].append(len(stack))
        if name in INLINE:
            stack.append((name, block, link or name == "a", unseen))
        else:
            run = -1
            blocks.append(len(stack))
            inside = unseen or name in UNSEEN
            if name in ("button", "select"):
                nodes.inputs[block] += 1
            stack.append((name, block if inside else nodes.add(name, block, attribute_tokens(attributes) if attributes else frozenset()), link, inside))
    text(page[at:])
    return nodes


@cache
def _raw_end(name: str) -> re.Pattern:
    return re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I)


def features(nodes: Nodes) -> np.ndarray:
    """A row for each node; every column is a share, a logarithm or a flag, so that pages of any length compare."""
    n = len(nodes.tag)
    parent = np.array(nodes.parent)
    chars = np.array([sum(map(len, t)) for t in nodes.text], dtype=float)
    joined = ["".join(t) for t in nodes.text]
    own = np.zeros((n, 8))
    own[:, 0] = chars
    own[:, 1] = nodes.linked
    own[:, 2] = [t.count(" ") + 1 if t else 0 for t in joined]
    own[:, 3] = [t.count(". ") + t.count(", ") + t.endswith((".", "!", "?")) for t in joined]
    own[:, 4] = nodes.inputs
    own[:, 5] = [1.0] * n
    own[:, 6] = [t.count("©") + t.count("|") + t.count("·") for t in joined]
    own[:, 7] = [tag == "p" for tag in nodes.tag]
    below = own.copy()
    for i in range(n - 1, 0, -1):
        below[parent[i]] += below[i]
    kinds = np.zeros((n, len(TOKENS)))
    tags = np.zeros((n, len(_TAGS)))
    depth, place, children = np.zeros(n), np.zeros(n), np.zeros(n)
    for i, tag in enumerate(nodes.tag):
        if tag in _TAG:
            tags[i, _TAG[tag]] = 1
        for t in nodes.tokens[i]:
            if t in _KIND:
                kinds[i, _KIND[t]] = 1
        if i:
            depth[i] = depth[parent[i]] + 1
            place[i] = children[parent[i]]
            children[parent[i]] += 1
    above_kinds, above_tags = kinds.copy(), tags.copy()
    for i in range(1, n):
        above_kinds[i] = np.maximum(kinds[i], above_kinds[parent[i]])
        above_tags[i] = np.maximum(tags[i], above_tags[parent[i]])
    up = np.maximum(parent, 0)
    share = lambda a, b: a / np.maximum(b, 1.0)
    numbers = np.stack([
        np.log1p(below[:, 0]), share(below[:, 1], below[:, 0]), share(below[:, 0], below[:, 5]), share(below[:, 3], below[:, 2]), np.log1p(below[:, 2]), share(below[:, 0], below[up, 0]),
        share(below[:, 0], below[0, 0]), np.minimum(below[:, 4], 9), np.minimum(below[:, 6], 9), np.log1p(below[:, 7]), depth, share(place, np.maximum(children[up] - 1, 1)), np.log1p(children),
        np.log1p(children[up]), np.log1p(below[up, 7]), share(below[up, 1], below[up, 0]), share(np.cumsum(chars) - chars, below[0, 0]), share(below[:, 2], below[:, 5]),
    ], 1)
    return np.hstack([numbers, tags, tags[up], above_tags, kinds, above_kinds])


def decode(parent: list[int], keep: np.ndarray) -> np.ndarray:
    """The likeliest choice in which every descendant of a dropped node is dropped. keep: each node's probability."""
    p = np.clip(keep, 1e-6, 1 - 1e-6)
    stay, drop = np.log(p), np.log(1 - p)
    n = len(parent)
    best = stay.copy()
    for i in range(n - 1, 0, -1):
        best_i = max(best[i], drop[i])
        best[parent[i]] += best_i
        drop[parent[i]] += drop[i]
    kept = np.zeros(n, dtype=bool)
    kept[0] = best[0] >= drop[0]
    for i in range(1, n):
        kept[i] = kept[parent[i]] and best[i] >= drop[i]
    return kept


def text_of(nodes: Nodes, kept: np.ndarray) -> str:
    """The kept runs of text in page order: white space as one space, trimmed, one line each."""
    runs = (_SPACES.sub(" ", "".join(nodes.text[i])).strip(" ") for i in np.flatnonzero(kept) if nodes.tag[i] == "#text")
    return "\n".join(r for r in runs if r)


def weak_labels(nodes: Nodes) -> np.ndarray | None:
    """1 for nodes of the main element and those that hold it, 0 for others; null for pages without text outside what is named otherwise.

    A page that names no main element has it where most of its unlinked text is: in the deepest node that holds DENSE of it.
    """
    n = len(nodes.tag)
    bad = {k for k, name in enumerate(TOKENS) if name != "main"}
    main, out = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    for i in range(n):
        kinds = {_KIND[t] for t in nodes.tokens[i] if t in _KIND}
        up = nodes.parent[i]
        gone = nodes.tag[i] in ("nav", "aside", "footer", "form", "fieldset", "menu") or (nodes.tag[i] == "header" and not (up >= 0 and main[up])) or bool(kinds & bad)
        out[i] = gone or (up >= 0 and out[up])
        main[i] = not out[i] and (nodes.tag[i] in ("article", "main") or (up >= 0 and main[up]))
    if not main.any():
        chars = np.array([0 if out[i] else sum(map(len, nodes.text[i])) - nodes.linked[i] for i in range(n)], dtype=float)
        for i in range(n - 1, 0, -1):
            chars[nodes.parent[i]] += chars[i]
        if chars[0] <= 0:
            return None
        top = max(i for i in range(n) if chars[i] >= DENSE * chars[0] and nodes.tag[i] != "#text" and nodes.tag[i] not in ("p", "li", "td"))
        for i in range(top, n):
            main[i] = not out[i] and (i == top or main[nodes.parent[i]])
    for i in range(n - 1, 0, -1):
        if main[i]:
            main[nodes.parent[i]] = True
    return main.astype(float)


#: The share of a page's unlinked text that its main part holds where none is named.
DENSE = 0.6
#: What augmented copies get put in: (place, markup around the words). Places are known, so labels are.
_PUT_IN = (
    ("top", '<div class="{c}"><p>{t}</p><a href="/x">{s}</a></div>', "cookie consent notice alert newsletter popup"), ("top", '<header class="{c}"><div>{s}</div><ul><li><a href="/">{s}</a></li></ul></header>', "header masthead topbar"),
    ("end", '<aside class="{c}"><h3>{s}</h3><ul><li><a href="/">{t}</a></li><li><a href="/">{t}</a></li></ul></aside>', "sidebar related widget"),
    ("end", '<div class="{c}"><h3>{s}</h3><p>{t}</p><p>{t}</p></div>', "sidebar related recommended trending"),
    ("end", '<section class="{c}"><h2>{s}</h2><div class="comment"><b>{s}</b><p>{t}</p></div><div class="comment"><b>{s}</b><p>{t}</p></div></section>', "comments discussion responses"),
    ("end", '<div class="{c}"><p>{t}</p></div>', "comments reviews replies discussion"), ("end", '<aside><p>{t}</p></aside>', "aside"), ("end", '<aside><h3>{s}</h3><p>{t}</p></aside>', "aside"),
    ("end", '<form><label>{s}</label><input name="q"><button>{s}</button><p>{s}</p></form>', "form"), ("end", '<div class="{c}">{t}</div>', "ad advert sponsored promo"),
    ("end", '<div class="{c}"><a href="/">{s}</a> <a href="/">{s}</a> <a href="/">{s}</a></div>', "share social breadcrumb pagination"),
)
_MAIN_TAGS = ('<div class="content">', '<main>', '<div id="main-content">', '<section class="post">', '<div class="entry-body">', *["<div>"] * 5)


def _words(page: str) -> list[str]:
    """The words outside of tags, scripts and styles; each search of what isn't there is made once."""
    out, at, missing = [], 0, set()

    def after(what: str, start: int) -> int:
        found = -1 if what in missing else page.find(what, start)
        if found < 0:
            missing.add(what)
        return found + len(what) if found >= 0 else 0

    while (start := page.find("<", at)) >= 0:
        out.append(page[at:start])
        name = next((n for n in ("script", "style") if page.startswith(n, start + 1)), None)
        at = (after(f"</{name}>", start) if name else 0) or after(">", start) or start + 1
    out.append(page[at:])
    return " ".join(out).split()


def _shortened(page: str, paragraphs: int) -> str:
    """The page with no more than so many paragraphs of its first article, where the article has an end; otherwise the page itself."""
    start = page.find("<article")
    at = page.find(">", start) + 1 if start >= 0 else 0
    ends = []
    while at and len(ends) < paragraphs and (at := page.find("</p>", at) + 4) > 3:
        ends.append(at)
    for end in reversed(ends):
        if (stop := page.find("</article>", end)) >= 0:
            return page[:end] + page[stop:]
    return page


def _augmented(page: str, r: np.random.Generator) -> Iterator[tuple[Nodes, np.ndarray]]:
    """The page, and copies of it with things put in, its main element renamed, and tags and tokens wiped, with labels."""
    # running words of the page itself, punctuation included, so that how a text reads doesn't tell what was put in
    words = _words(page) or ["x"]

    def some(n: int) -> str:
        at = int(r.integers(max(1, len(words) - n)))
        return " ".join(words[at : at + n])

    copies = [page]
    for _ in range(3):
        # short articles too, so that how large a part of the page a node is doesn't decide by itself
        put = page if r.random() < 0.3 else _shortened(page, int(r.integers(1, 5)))
        for where, markup, names in _PUT_IN:
            if r.random() < 0.4:
                names = names.split()
                piece = markup.format(c=names[int(r.integers(len(names)))], t=some(int(r.integers(8, 150))), s=some(int(r.integers(1, 4))))
                if where == "top":
                    body = put.find("<body")
                    inside = put.find(">", body) + 1 if body >= 0 else 0
                    put = put[:inside] + piece + put[inside:] if inside else put
                else:
                    put = put.replace("</article>", "</article>" + piece, 1)
        copies.append(put)
    for copy in copies:
        nodes = parse(copy)
        y = weak_labels(nodes)
        if y is None:
            return
        yield nodes, y
        # the same nodes under other names: what was the main element, and some of all tags and tokens
        for _ in range(2):
            other = replace(nodes, tag=list(nodes.tag), tokens=list(nodes.tokens))
            start = _MAIN_TAGS[int(r.integers(len(_MAIN_TAGS)))]
            for i in range(len(other.tag)):
                if other.tag[i] in ("article", "main"):
                    other.tag[i] = re.match(r"<(\w+)", start)[1]
                    other.tokens[i] = attribute_tokens(start[start.index(" ") : -1]) if " " in start else frozenset()
                elif r.random() < 0.2 and other.tag[i] in ("nav", "header", "footer", "aside", "section", "form"):
                    other.tag[i] = "div"
                elif r.random() < 0.1:
                    other.tokens[i] = frozenset()
            yield other, y


def fit(pages: list[str], seed: int = 1) -> Boosted:
    """Trees from the pages' own markup."""
    r = np.random.default_rng(seed)
    rows = [(features(nodes), y) for page in pages for nodes, y in _augmented(page, r)]
    if not rows:
        return boost(np.zeros((2, features(parse("")).shape[1])), np.array([0.0, 1.0]))
    return boost(np.concatenate([x for x, _ in rows]), np.concatenate([y for _, y in rows]))


def extract_batch(pages: list[str | None], model: Boosted) -> list[str]:
    parsed = [parse(p) if p else None for p in pages]
    full = [n for n in parsed if n is not None]
    if not full:
        return ["" for _ in pages]
    keep = model.predict(np.concatenate([features(n) for n in full]))
    ends = np.cumsum([len(n.tag) for n in full])
    parts = iter(np.split(keep, ends[:-1]))
    return ["" if n is None else text_of(n, decode(n.parent, next(parts))) for n in parsed]


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", sample: int = SAMPLE_PAGES, batch: int = 64) -> DataFrame:
    """page_id, url, text and n_chars for each row."""
    named = clean_columns(pages, page_id=id_col, url=url_col, html=html_col)
    model = fit(distinct_sample(named.where("html <> ''"), "html", sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, batch):
                part = b.slice(k, batch)
                texts = extract_batch(part.column("html").to_pylist(), model)
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in named.schema}
    return named.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
