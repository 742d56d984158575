"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the DOM.

A page is cut into leaf blocks: runs of text between the borders of block-level elements. Features
of a block are its ancestors' tags and the words of their class, id and role, and its own text
(length, share of links, punctuation, place). The field labels each block as main text or not, with
weights for neighbouring labels; it is fitted on labelled pages and decoded by Viterbi.

Labelled pages: a sample of the pages themselves, where an ``article`` element marks the main text
but for comments, forms, asides and notices in it, and the same texts set in layouts of other kinds
and as bare pages, where each block's role is known. If no page of the sample has an article, its long blocks
without links are set in layouts.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.llm.common import table

#: The model is fitted on about this many pages of at most so many bytes, whatever the corpus, each as it is and in a layout.
TRAIN_PAGES, TRAIN_BYTES = 400, 1 << 18
#: Blocks of a chain in fitting.
CHAIN = 256
#: The share of training pages that are seen without the names of classes and without what these say.
NAMELESS = 0.35
STEPS, RATE, PENALTY = 250, 0.2, 1e-3

# Element names of HTML.
TEXT_ONLY = {"script", "style", "iframe", "title", "textarea", "xmp", "noembed", "noframes"}  # without an end tag, to the page's end
DROPPED = {"noscript", "template", "svg", "object", "canvas", "select"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "button", "caption", "center", "colgroup", "dd", "details", "dialog", "dir", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "frameset", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend",
    "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
_ENDS_P = re.compile(r"p|h[1-6]|div|ul|ol|dl|table|blockquote|pre|section|article|aside|nav|header|footer|main|form|figure|hr|address|fieldset")
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HELD = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "td", "th", "dt", "dd", "blockquote", "pre"}
#: Parts of an article that are not its text, by element and by words of class, id and role.
NOT_MAIN = {"aside", "nav", "form", "footer", "dialog"}
NOT_MAIN_MARKS = {
    "ad", "ads", "adsbygoogle", "advert", "advertisement", "comment", "commentlist", "comments", "consent", "cookie", "discussion", "gdpr", "modal", "newsletter", "notice",
    "paywall", "popular", "popup", "promo", "recommended", "related", "replies", "reply", "respond", "responses", "share", "sidebar", "signup", "social", "sponsored", "subscribe", "trending",
}
# In a tag, a quote opens a value only after an equals sign; elsewhere it is a character like others.
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>=\s*"[^"]*"|=\s*'[^']*'|[^>])*+)>""", re.S)
_MARKS = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_LABEL = re.compile(r'\bdata-main\s*=\s*"1"')
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")


@dataclass
class Block:
    text: str
    own: str  # the innermost block-level element
    tags: frozenset[str]  # of the ancestors
    marks: frozenset[str]  # words of class, id and role of the ancestors
    linked: int  # characters inside links
    main: bool  # marked as main text, in labelled pages
    aside: bool  # in an element that is no part of an article's text
    holder: int  # number of the element that holds it and its like: that around a paragraph, heading, item or cell


class _Stack:
    """The open block-level elements, with counts of what they hold, so that a block costs no walk through them."""

    def __init__(self, known: set[str] | None):
        self.known, self.open, self.tags, self.marks, self.main, self.aside = known, [], Counter(), Counter(), 0, 0
        self.seen: tuple | None = None
        self.n = 0  # elements so far

    def push(self, tag: str, attributes: str) -> None:
        marks = {w.lower() for x in _MARKS.finditer(attributes) for w in _PARTS.findall(x[2] or x[3] or x[4] or "")}
        aside = tag in NOT_MAIN or not NOT_MAIN_MARKS.isdisjoint(marks)
        marks = marks if self.known is None else marks & self.known
        self.n += 1
        item = tag, marks, bool(_LABEL.search(attributes)), aside, self.n
        self.open.append(item)
        self.tags[tag] += 1
        self.marks.update(marks)
        self.main, self.aside, self.seen = self.main + item[2], self.aside + aside, None

    def pop(self) -> str:
        tag, marks, main, aside, _ = self.open.pop()
        for counts, names in ((self.tags, (tag,)), (self.marks, marks)):
            for name in names:
                counts[name] -= 1
                if not counts[name]:
                    del counts[name]
        self.main, self.aside, self.seen = self.main - main, self.aside - aside, None
        return tag

    def holder(self) -> int:
        up = 2 if self.open and self.open[-1][0] in HELD else 1
        return self.open[-up][4] if len(self.open) >= up else 0

    def names(self) -> tuple[str, frozenset[str], frozenset[str]]:
        if self.seen is None:
            self.seen = self.open[-1][0] if self.open else "", frozenset(self.tags), frozenset(self.marks)
        return self.seen


def blocks_of(page: str | None, known: set[str] | None = None) -> list[Block]:
    """The page's leaf blocks in order, character references decoded, white space made one space, trimmed.

    known: the marks that matter (None: all). Elements that are not block-level, unknown ones too, stand in
    their block's text.
    """
    found: list[Block] = []
    stack, text = _Stack(known), []
    links = linked = 0
    page = page or ""

    def flush() -> None:
        nonlocal linked
        joined = _SPACE.sub(" ", entities.unescape("".join(text))).strip()
        if joined:
            found.append(Block(joined, *stack.names(), linked, stack.main > 0, stack.aside > 0, stack.holder()))
        text.clear()
        linked = 0

    def add(part: str) -> None:
        nonlocal linked
        text.append(part)
        if links:
            linked += len(part)

    at, no_end = 0, set()  # elements that have no further end tag
    while at < len(page):
        m = _TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue  # a comment or declaration
        tag, closing = m[2].lower(), bool(m[1])
        if tag in TEXT_ONLY or tag in DROPPED:
            if not closing and tag not in no_end and not m[3].rstrip().endswith("/"):
                end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                if end:
                    at = end.end()
                elif tag in TEXT_ONLY:
                    break
                else:
                    no_end.add(tag)
            continue
        if tag == "br" or (tag in VOID and tag != "hr"):
            text.append(" ")
            continue
        if tag not in BLOCKS:
            if tag == "a":
                links = max(0, links - 1) if closing else 1
            continue
        flush()
        links = 0
        if closing:
            if stack.tags[tag]:
                while stack.pop() != tag:
                    pass
            continue
        closes = {"p"} if _ENDS_P.fullmatch(tag) else set()
        closes |= _CLOSES.get(tag, set())
        while stack.open and stack.open[-1][0] in closes:
            stack.pop()
        if tag not in VOID:
            stack.push(tag, m[3])
    flush()
    return found


def features_of(blocks: list[Block]) -> list[list[str]]:
    """The names of each block's features."""
    out, n, held = [], len(blocks), Counter()
    for b in blocks:
        held[b.holder] += len(b.text)
    most = max(held.values(), default=1)
    for i, b in enumerate(blocks):
        words = b.text.split()
        share = b.linked / max(1, len(b.text))
        f = ["bias", f"own:{b.own}", f"words:{min(6, len(words).bit_length())}"]
        f += [f"in:{t}" for t in b.tags] + [f"mark:{m}" for m in b.marks]
        f.append(f"links:{0 if share == 0 else 1 if share < 0.3 else 2 if share < 0.8 else 3}")
        f.append(f"ends:{b.text[-1] if b.text[-1] in '.!?:,;' else 'w' if b.text[-1].isalnum() else 'x'}")
        f.append(f"commas:{min(3, b.text.count(','))}")
        if "©" in b.text or "®" in b.text:
            f.append("rights")
        if any(c.isdigit() for c in b.text):
            f.append("digits")
        if i == 0:
            f.append("first")
        if i == n - 1:
            f.append("last")
        f.append(f"place:{4 * i // n}")
        f.append(f"held:{'most' if held[b.holder] == most else min(3, int(8 * held[b.holder] / most))}")
        if "article" not in b.tags and "main" not in b.tags:
            f.append("no_landmark")
        if b.aside:
            f.append("aside")
        out.append(f)
    return out


class Field:
    """A linear-chain CRF with labels 0 and 1 (main text)."""

    def __init__(self, names: dict[str, int], node: np.ndarray, pair: np.ndarray):
        self.names, self.node, self.pair = names, node, pair

    def scores(self, features: list[list[str]]) -> np.ndarray:
        get = self.names.get
        return np.array([self.node[[j for j in map(get, f) if j is not None]].sum(axis=0) for f in features]).reshape(-1, 2)

    def decode(self, features: list[list[str]]) -> list[int]:
        """The most probable labels, by Viterbi."""
        (aa, ab), (ba, bb) = self.pair.tolist()
        back, x, y = [], 0.0, 0.0
        for i, (s, t) in enumerate(self.scores(features).tolist()):
            if i:
                from_x, from_y = x + aa >= y + ba, x + ab >= y + bb
                back.append((0 if from_x else 1, 0 if from_y else 1))
                x, y = max(x + aa, y + ba), max(x + ab, y + bb)
            x, y = x + s, y + t
        labels = [0 if x >= y else 1] if features else []
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]


def fit(pages: list[tuple[list[list[str]], list[int]]], steps: int = STEPS) -> Field:
    """Fits (features, labels) of pages: gradient ascent on the conditional log-likelihood, all pages at once.

    A page of more than CHAIN blocks is several chains. Chains lie behind each other by place, the longest
    first, so that place t is one stretch of those that go so far: arrays are as long as there are
    blocks, and no pass has more than CHAIN steps.
    """
    chains = [(f[k : k + CHAIN], y[k : k + CHAIN]) for f, y in pages for k in range(0, len(f), CHAIN)]
    chains.sort(key=lambda c: -len(c[0]))
    seen = Counter(x for f, _ in pages for x in {x for b in f for x in b})
    names = {f: i for i, f in enumerate(sorted(f for f, k in seen.items() if k >= 3))}
    n, lengths = len(pages), np.array([len(f) for f, _ in chains], np.int64)
    places = int(lengths.max(initial=0))
    going = (lengths[None, :] > np.arange(places)[:, None]).sum(axis=1)  # chains that have a place t
    starts = np.r_[0, np.cumsum(going)].tolist()
    n_blocks = starts[-1]
    gold, sizes, cols = np.zeros(n_blocks, np.int64), np.zeros(n_blocks, np.int64), [[] for _ in range(n_blocks)]
    for i, (features, labels) in enumerate(chains):
        for t, (f, y) in enumerate(zip(features, labels)):
            at = starts[t] + i
            gold[at], cols[at] = y, [names[x] for x in f if x in names]
            sizes[at] = len(cols[at])
    rows, cols = np.repeat(np.arange(n_blocks), sizes), np.array([j for x in cols for j in x], np.int64)
    weights = np.zeros(2 * len(names) + 4)
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    last = np.array([starts[k - 1] + i for i, k in enumerate(lengths.tolist())], np.int64)
    follows = np.arange(starts[1] if places else 0, n_blocks)  # blocks after another one, and that one
    before = np.concatenate([starts[t - 1] + np.arange(going[t]) for t in range(1, places)]) if places > 1 else follows[:0]
    chain = np.concatenate([np.arange(k) for k in going]) if places else follows[:0]
    for step in range(1, steps + 1 if n_blocks else 0):
        node, pair = weights[:-4].reshape(-1, 2), weights[-4:].reshape(2, 2)
        s = np.stack([np.bincount(rows, node[cols, k], n_blocks) for k in (0, 1)], 1)
        alpha, beta = s.copy(), np.zeros_like(s)
        for t in range(1, places):
            x, here = alpha[starts[t - 1] : starts[t - 1] + going[t]], slice(starts[t], starts[t + 1])
            alpha[here] += np.logaddexp(x[:, 0, None] + pair[0], x[:, 1, None] + pair[1])
        for t in range(places - 2, -1, -1):
            after = slice(starts[t + 1], starts[t + 2])
            x = beta[after] + s[after]
            beta[starts[t] : starts[t] + going[t + 1]] = np.logaddexp(x[:, 0, None] + pair[:, 0], x[:, 1, None] + pair[:, 1])
        z = np.logaddexp(alpha[last, 0], alpha[last, 1])
        gap = np.eye(2)[gold] - np.exp(alpha + beta - z[chain, None])
        g_node = np.stack([np.bincount(cols, gap[rows, k], len(names)) for k in (0, 1)], 1)
        g_pair, z_follows = np.zeros((2, 2)), z[chain[follows]]
        for a in (0, 1):
            for b in (0, 1):
                q = np.exp(alpha[before, a] + pair[a, b] + s[follows, b] + beta[follows, b] - z_follows)
                g_pair[a, b] = ((gold[before] == a) & (gold[follows] == b)).sum() - q.sum()
        g = np.concatenate([g_node.ravel(), g_pair.ravel()]) / n - PENALTY * weights
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        weights = weights + RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8) * (1 - step / (steps + 1))
    return Field(names, weights[:-4].reshape(-1, 2), weights[-4:].reshape(2, 2))


# Wordings of class names by role, for layouts. None stands for an element without marks.
MAIN_WRAPS = [("article", None), ("article", "post"), ("main", None), ("main", "content"), ("div", "content"), ("div", "post-body"), ("div", "entry-content"),
              ("div", "article-text"), ("div", "story"), ("section", "main-content"), ("div", None), ("div", "page-body"), ("td", "text"), ("article", "entry")]
ASIDES = [("aside", None), ("aside", "sidebar"), ("div", "sidebar"), ("div", "widget related"), ("div", "right-column side"), ("section", "related-posts"), ("ul", "popular trending"), ("div", "recommended")]
COMMENTS = [("section", "comments"), ("div", "comments"), ("div", "comment-list"), ("ol", "commentlist"), ("div", "responses replies"), ("section", "discussion comments-area"), ("div", "reader-comments"), ("div", "user-comment thread")]
NOTICES = [("div", "cookie-notice"), ("div", "cookie-banner consent"), ("div", "notice"), ("div", "gdpr popup modal"), ("section", "alert banner"), ("div", "newsletter-signup subscribe"), ("div", "disclaimer"), ("div", "paywall message")]
ADVERTS = [("div", "ad"), ("div", "ads"), ("div", "advert"), ("aside", "advertisement"), ("div", "sponsored promo"), ("div", "banner-ad"), ("ins", "adsbygoogle")]
HEADERS = [("header", None), ("div", "header"), ("header", "site-header"), ("div", "masthead top-bar"), ("div", "branding logo")]
FOOTERS = [("footer", None), ("div", "footer"), ("footer", "site-footer"), ("div", "copyright bottom legal")]
NAVS = [("nav", None), ("ul", "menu"), ("div", "nav navbar"), ("div", "breadcrumb breadcrumbs"), ("nav", "pagination pager"), ("div", "toolbar tabs links"), ("div", "share social tags")]


def set_in_layout(texts: list[str], spare: list[str], seed: int) -> str:
    """A page with the texts as main text, marked by data-main, and the spare ones in every other role."""
    rng = random.Random(seed)
    safe = lambda s: entities.escape(s, quote=False)
    some = lambda a, b, longest=40: [" ".join(x.split()[: rng.randint(2, longest)]) for x in rng.choices(spare or ["Text."], k=rng.randint(a, b))]

    def box(kind: tuple[str, str | None], inner: str, mark: str = "") -> str:
        tag, name = kind
        name = f' {rng.choice(["class", "class", "id"])}="{name}"' if name else ""
        return f"<{tag}{name}{mark}>{inner}</{tag}>"

    items = lambda xs, link: "".join(f"<li><a href='/x'>{safe(x)}</a></li>" if link else f"<li>{safe(x)}</li>" for x in xs)
    nav = lambda: box(rng.choice(NAVS), "<ul>" + items(some(3, 7, 3), True) + "</ul>")
    ad = lambda: box(rng.choice(ADVERTS), rng.choice(["<p>%s</p>", "%s", "<a href='/y'>%s</a>"]) % safe(some(1, 1)[0]))
    notice = lambda: box(rng.choice(NOTICES), f"<p>{safe(some(1, 1, 25)[0])}</p><button>{safe(some(1, 1, 3)[0])}</button>")
    form = lambda: f"<form><label>{safe(some(1, 1, 4)[0])}</label><p>{safe(some(1, 1, 12)[0])}</p><input name='q'></form>"
    aside = lambda: box(rng.choice(ASIDES), f"<h3>{safe(some(1, 1, 4)[0])}</h3>" + rng.choice([f"<ul>{items(some(2, 5, 8), True)}</ul>", "".join(f"<p>{safe(x)}</p>" for x in some(1, 3))]))
    remarks = lambda: box(rng.choice(COMMENTS), f"<h3>{safe(some(1, 1, 3)[0])}</h3>" + "".join(rng.choice([f"<div><p>{safe(x)}</p></div>", f"<li><b>{safe(x.split()[0])}</b><p>{safe(x)}</p></li>", f"<article><p>{safe(x)}</p></article>"]) for x in some(1, 5, 60)))

    body, head = "", f"<h1>{safe(' '.join(texts[0].split()[:10]))}</h1>" if texts else ""
    for text in texts:
        kind = rng.random()
        if kind < 0.72:
            body += f"<p>{safe(text)}" + ("</p>" if rng.random() < 0.9 else "")
        elif kind < 0.8:
            body += f"<h2>{safe(' '.join(text.split()[:6]))}</h2><p>{safe(text)}</p>"
        elif kind < 0.87:
            cut = text.split(". ")
            body += "<ul>" + "".join(f"<li>{safe(x)}</li>" for x in cut) + "</ul>"
        elif kind < 0.92:
            body += f"<blockquote>{safe(text)}</blockquote>"
        elif kind < 0.96:
            body += f"<div>{safe(text)}</div>"
        else:
            body += f"<p>{safe(text[: len(text) // 2])}<a href='/z'>{safe(text[len(text) // 2 :])}</a></p>"
        if rng.random() < 0.06:
            body += "</div>" + rng.choice([ad, aside, notice])() + '<div data-main="1">'
    main = head.replace("<h1", '<h1 data-main="1"') + f'<div data-main="1">{body}</div>'
    inside = rng.random() < 0.5
    after = "".join(x() for x in rng.sample([ad, aside, remarks, remarks, form, notice, nav], rng.randint(int(inside), 4)))
    wraps = [x for x in MAIN_WRAPS if x[0] == "article"] if inside and rng.random() < 0.5 else MAIN_WRAPS
    wrapped = box(rng.choice(wraps), main + (after if inside else ""))
    before = "".join(x() for x in rng.sample([nav, ad, aside, notice, form], rng.randint(1, 4)))
    top = box(rng.choice(HEADERS), f"<p>{safe(some(1, 1, 5)[0])}</p>" + (nav() if rng.random() < 0.5 else ""))
    end = box(rng.choice(FOOTERS), rng.choice(["&copy; ", ""]) + safe(some(1, 1, 20)[0]))
    parts = [top if rng.random() < 0.7 else "", before, wrapped, "" if inside else after, end]
    inner = "".join(parts)
    return f"<html><head><title>x</title></head><body>{box(('div', rng.choice(['wrapper', 'page', 'container', 'site'])), inner) if rng.random() < 0.4 else inner}</body></html>"


def bare_page(texts: list[str], seed: int) -> str:
    """A page of the texts alone, all main text, in elements of any kind."""
    rng = random.Random(seed)
    inner = ""
    for text in texts:
        text = entities.escape(text, quote=False)
        inner += rng.choice(["<p>{}</p>", "<p>{}", "<div>{}</div>", "<table><tr><td>{}</td></tr></table>", "<section>{}</section>", "{}<hr>", "<blockquote><p>{}</p></blockquote>", "<font>{}<br><br></font><p>"]).format(text)
    inner = f"<h1>{entities.escape(' '.join(texts[0].split()[:8]), quote=False)}</h1>" * (rng.random() < 0.5) + inner
    return f'<div data-main="1">{inner}</div>' if rng.random() < 0.5 else f'<body data-main="1">{inner}</body>'


def labelled(pages: list[str], seed: int = 1) -> Iterator[tuple[list[list[str]], list[int]]]:
    """Features and labels of the pages with an article element, and of their texts in layouts and bare.

    If no page has an article, blocks of 80 characters or more without links are set in layouts. Of some pages the
    features that the labels of pages with an article come from are left out, as they are from pages with names in other languages.
    """
    def page_of(blocks: list[Block], labels: list[bool], rng: random.Random) -> tuple[list[list[str]], list[int]]:
        features = features_of(blocks)
        if rng.random() < NAMELESS:
            features = [[x for x in f if x != "aside" and not x.startswith("mark:")] for f in features]
        return features, [int(y) for y in labels]

    cut = [blocks_of(p) for p in pages]
    spare = [b.text for blocks in cut for b in blocks][:4000]
    marked = [[("article" in b.tags) and not b.aside for b in blocks] for blocks in cut]
    some = any(map(any, marked))
    for i, (blocks, labels) in enumerate(zip(cut, marked)):
        main = [b.text for b, y in zip(blocks, labels) if y or (not some and len(b.text) >= 80 and not b.linked)]
        if not main:
            continue
        rng = random.Random(seed * 7919 + i)
        if some:
            yield page_of(blocks, labels, rng)
        pages_made = [set_in_layout(main, spare, seed * 1_000_003 + i)]
        if i % 3 == 0:
            long = [x for x in main if len(x) >= 80] or main
            pages_made.append(bare_page(rng.sample(long, min(len(long), rng.randint(1, 4))), seed * 1_000_003 + i))
        for page in pages_made:
            made = blocks_of(page)
            yield page_of(made, [b.main for b in made], rng)


def sample_pages(pages: DataFrame, about: int = TRAIN_PAGES) -> list[str]:
    """The html of about so many pages of at most TRAIN_BYTES, chosen by hash."""
    rows = pages.select("html").filter(F.octet_length("html") <= TRAIN_BYTES)
    n = max(1, rows.count())
    h = F.pmod(F.xxhash64("html"), F.lit(1_000_000))
    chosen = rows.filter(h <= int(1e6 * min(1.0, about / n))).dropDuplicates()
    return sorted(r["html"] for r in chosen.collect())


def extract(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """The input's rows and columns with text: the page's main text, blocks joined by two line feeds.

    Null and empty html, and pages without main text, give an empty text. Unclosed elements end
    where HTML says or with what holds them; a line break is white space inside a block. Without a
    field one is fitted on a sample of the pages (see ``labelled``); if these have no text, on
    nothing, and then every text is empty. Rows that repeat are treated alike. Pages of any length and
    depth are taken whole. An input column named text is replaced; an empty table gives an empty result.
    """
    field = field or fit(list(labelled(sample_pages(pages))))
    model = pages.sparkSession.sparkContext.broadcast((field.names, field.node, field.pair))

    @F.pandas_udf("string")
    def main_text(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = Field(*model.value)
        marks = {name[5:] for name in known.names if name.startswith("mark:")}
        for htmls in series:
            out = []
            for page in htmls:
                blocks = blocks_of(page, marks)
                labels = known.decode(features_of(blocks))
                out.append("\n\n".join(b.text for b, y in zip(blocks, labels) if y))
            yield pd.Series(out, dtype=object)

    return pages.drop("text").withColumn("text", main_text("html"))


def op9_html_extract(spark, sf_dir: str) -> DataFrame:
    found = extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
