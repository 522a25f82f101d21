"""Main text of web pages: gradient-boosted trees over DOM nodes.

A page becomes a tree of its elements (formatting elements without attributes
are part of their block; text between block children is a leaf of its own).
Each node gets features of itself, its subtree, its siblings and its
ancestors: text and tag density, share of linked text, depth, place among
siblings, and learned log-odds of its tag and attribute tokens.  Boosted trees
give the probability that a node holds main text.  Decoding is hierarchical:
the most likely labelling of the whole tree in which no node is kept below a
dropped one.

Training takes at most ``TRAIN_PAGES`` pages, the first by a hash of page_id.
Where a page marks its article, that text and the page's other texts are laid
out again in many page shapes (containers, menus, headers, sidebars, notices,
adverts, forms, comments, footers, with or without telling tags and classes),
so the trees learn shapes and not one template; nodes are labelled by which
text they came from.  Training runs in one task on that bounded sample.

Defined cases: null or empty html, and pages without main text, give an empty
text; scripts, styles, comments, head and other unseen elements never count, and
only raw text (scripts, styles, text areas, titles) may run to the end of the
page where its end tag is missing; formulas and the inner text of objects, audio
and video are text like any other; unclosed and stray tags are repaired as browsers do in the common cases; a cut
last tag or reference is text as it stands; null page_ids and urls stay null;
repeated rows come out alike; without a page that marks its article the fixed
texts of ``FALLBACK`` train the trees; an empty table gives no rows.
"""

from __future__ import annotations

import html
import io
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_PAGES = 400
SHAPES_PER_PAGE = 4
TREES, DEPTH, BINS, RATE = 40, 4, 32, 0.25
SEED = 11
BATCH_PAGES = 128

# Element groups of HTML (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head template svg select datalist annotation annotation-xml".split())
RAW = frozenset("script style textarea title noscript iframe".split())
# Raw text that runs to the end of the page where its end tag is missing.
RAW_TO_END = frozenset("script style textarea title".split())
FORMAT = frozenset("a abbr acronym audio b bdi bdo big canvas cite code data del dfn em font i ins kbd map mark object q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var video label math mi mn mo ms mtext mrow msub msup msubsup "
                   "mfrac msqrt mroot mstyle mspace munder mover munderover mpadded mphantom semantics".split())
CLOSES_P = frozenset("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
                     "h6 header hr main menu nav ol p pre section table ul".split())
SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
                "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"}}
# Elements that cannot stand in an unseen one: they end it (a template holds anything).
ENDS_UNSEEN = (CLOSES_P | {"body", "li", "td", "tr"}) - {"hr"}
BARRIER = frozenset("table ul ol dl body html article section div main nav aside header footer form td th blockquote".split())

# Names that page authors give to parts of a page (fixed values).
CONTENT_NAMES = ("content", "main-content", "article", "article-body", "post", "post-content", "entry", "entry-content", "story",
                 "story-body", "body-text", "text", "main", "page-content", "blog-post")
PART_NAMES = {
    "menu": ("nav", "navbar", "menu", "main-menu", "breadcrumb", "breadcrumbs", "navigation", "topnav", "pagination", "tabs", "toc"),
    "header": ("header", "site-header", "masthead", "top-bar", "logo", "branding", "page-header", "hero"),
    "footer": ("footer", "site-footer", "copyright", "legal", "bottom", "colophon", "foot"),
    "sidebar": ("sidebar", "side", "widget", "related", "related-posts", "recommended", "popular", "trending", "tags", "rail",
                "archive", "more", "links"),
    "notice": ("cookie", "cookie-notice", "cookie-banner", "consent", "gdpr", "notice", "alert", "banner", "popup", "modal",
               "overlay", "message", "disclaimer", "warning", "toast", "paywall"),
    "advert": ("ad", "ads", "advert", "advertisement", "sponsored", "sponsor", "promo", "promotion", "ad-slot", "adbox", "affiliate",
               "banner-ad"),
    "form": ("newsletter", "subscribe", "signup", "search", "login", "search-form", "contact-form", "feedback", "share", "social",
             "sharing", "buttons"),
    "comments": ("comments", "comment", "comment-list", "responses", "discussion", "replies", "reply", "disqus", "user-comments",
                 "reader-comments"),
}
PART_TAGS = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "notice": "div", "advert": "aside",
             "form": "form", "comments": "section"}
FALLBACK = ("The main text of a page tells one thing at some length. It runs over several sentences, with commas and stops.",
            "More of it follows in another paragraph, which is also made of whole sentences.", "Short notes and links stand around it.")

# A private-use character that marks main text in training pages.
MARK = "\ue000"

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
                  r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_STOPS = re.compile(r"[.!?;:,](?=\s|$)")


# -------------------------------------------------------------------- the tree

class Page:
    """Element tree of a page.  ``pieces`` holds its texts in page order as
    (node, text); node -1 marks white space between blocks."""

    def __init__(self, source: str):
        self.tag, self.parent, self.names, self.depth = ["#page"], [-1], [()], [0]
        self.pieces: list[tuple[int, str]] = []
        self.linked: list[bool] = []
        self._stack: list[tuple[str, int]] = []         # open elements and their nodes
        self._places: dict[str, list[int]] = {}         # where each open tag stands in the stack
        self._links = self._hidden = 0
        self._read(source)
        self._split_mixed()

    def _node(self) -> int:
        return self._stack[-1][1] if self._stack else 0

    def _break(self) -> None:
        if self.pieces and self.pieces[-1][0] != -1:
            self.pieces.append((-1, " "))

    def _text(self, raw: str) -> None:
        if raw and not self._hidden:
            text = html.unescape(raw) if "&" in raw else raw
            self.pieces.append((self._node(), text))
            if self._links:
                self.linked.append(len(self.pieces) - 1)

    def _push(self, tag: str, node: int) -> None:
        self._places.setdefault(tag, []).append(len(self._stack))
        self._stack.append((tag, node))
        self._links += tag == "a"
        self._hidden += tag in UNSEEN

    def _pop_to(self, at: int) -> None:
        for tag, _ in self._stack[at:]:
            self._places[tag].pop()
            self._links -= tag == "a"
            self._hidden -= tag in UNSEEN
            if tag not in FORMAT and tag != "svg":
                self._break()
        del self._stack[at:]

    def _top(self, tags) -> int:
        """The innermost place of any of the tags; -1 if none is open."""
        return max((held[-1] for t in tags if (held := self._places.get(t))), default=-1)

    def _find(self, tags, barrier) -> int:
        """The innermost place of any of the tags above the innermost barrier."""
        at = self._top(tags)
        return at if at >= 0 and at >= self._top(barrier) else -1

    def _open(self, tag: str, attributes: str) -> None:
        if self._hidden:
            if tag not in ENDS_UNSEEN or self._places.get("template"):
                if tag not in VOID and not attributes.endswith("/"):
                    self._push(tag, self._node())
                return
            self._pop_to(min(held[0] for t in UNSEEN if (held := self._places.get(t))))
        if tag in CLOSES_P and (at := self._find(("p",), BARRIER)) >= 0:
            self._pop_to(at)
        if tag in SELF_CLOSING and (at := self._find(SELF_CLOSING[tag], ("table", "ul", "ol", "dl"))) >= 0:
            self._pop_to(at)
        if tag in VOID:
            if tag in ("br", "hr"):
                self._break()
            return
        node = self._node()
        found = (n for m in _ATTRIBUTE.finditer(attributes) for n in name_parts(m[2] or m[3] or m[4] or "")) if "=" in attributes else ()
        names = tuple(dict.fromkeys(found))
        if tag not in FORMAT:
            self._break()
        if tag not in FORMAT or names:
            self.tag.append(tag)
            self.parent.append(node)
            self.names.append(names)
            self.depth.append(self.depth[node] + 1)
            node = len(self.tag) - 1
        self._push(tag, node)

    def _read(self, source: str) -> None:
        at, unended = 0, set()                          # raw and template tags with no end tag from here on
        for m in iter(lambda: _TAG.search(source, at), None):
            self._text(source[at:m.start()])
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            if m[1] or m[4]:
                if (k := self._find((tag,), ())) >= 0:
                    self._pop_to(k)
                elif tag == "p":
                    self._break()
                continue
            attributes = m[3] or m[6] or ""
            if (tag in RAW and not attributes.endswith("/")) or tag == "template":
                close = None if tag in unended else re.compile(rf"</{tag}[\s/>]", re.I).search(source, at)
                if close is None:
                    unended.add(tag)
                if tag in RAW_TO_END and close is None:
                    at = len(source)
                elif tag in RAW and close is not None:
                    gt = source.find(">", close.start())
                    at = gt + 1 if gt >= 0 else len(source)
                elif tag == "template" and close is not None:
                    self._push(tag, self._node())
            elif tag in UNSEEN:
                if not attributes.endswith("/"):
                    self._push(tag, self._node())
            elif not (tag == "math" and attributes.endswith("/")):
                self._open(tag, attributes)
        self._text(source[at:])
        self._pop_to(0)

    def _split_mixed(self) -> None:
        """Texts of nodes that also have block children become leaves."""
        blocks = {p for p, t in zip(self.parent, self.tag, strict=True) if t not in FORMAT}
        run = None
        for i, (node, text) in enumerate(self.pieces):
            if node in blocks and not text.isspace():
                if run is None or self.parent[run] != node:
                    self.tag.append("#text")
                    self.parent.append(node)
                    self.names.append(())
                    self.depth.append(self.depth[node] + 1)
                    run = len(self.tag) - 1
                self.pieces[i] = (run, text)
            elif node == -1:
                run = None

    def text_of(self, keep: np.ndarray) -> str:
        return " ".join("".join(t for node, t in self.pieces if node == -1 or keep[node]).split())


def name_parts(value: str) -> list[str]:
    """Lower-case word parts of an attribute value, plurals cut."""
    parts = [p.lower() for p in _NAME.findall(value)]
    return [p[:-1] if len(p) > 3 and p.endswith("s") else p for p in parts if not p.isdigit()]


# -------------------------------------------------------------------- features

NUMBERS = ("depth", "chars", "own_chars", "words_mean", "stops", "linked", "subtree_tags", "density", "share", "start", "children",
           "place", "siblings", "same_tag", "before_density", "after_density", "parent_linked", "parent_share", "parent_density",
           "paragraphs", "paragraph_share", "items", "leaf", "up_paragraph_share", "own_share")
LEARNED = ("tag", "names", "names_least", "up_tag", "up_names", "up_least")


class Odds:
    """Smoothed log-odds of main text for tags and attribute names."""

    def __init__(self, table: dict[str, float] | None = None):
        self.table = table or {}

    @staticmethod
    def learn(pages: list[Page], labels: list[np.ndarray], smooth: float = 4.0) -> Odds:
        seen: dict[str, list[int]] = {}
        for page, y in zip(pages, labels, strict=True):
            for tag, names, label in zip(page.tag, page.names, y.tolist(), strict=True):
                for key in {"<" + tag, *names}:
                    seen.setdefault(key, [0, 0])[label] += 1
        return Odds({k: float(np.log((b + smooth / 2) / (a + smooth / 2))) for k, (a, b) in seen.items()})


def page_features(page: Page, odds: Odds) -> np.ndarray:
    n = len(page.tag)
    parent = np.array(page.parent)
    chars, words, stops, linked = (np.zeros(n) for _ in range(4))
    start = np.full(n, -1.0)
    links, at = set(page.linked), 0
    for i, (node, text) in enumerate(page.pieces):
        size = len(text.strip())
        if node < 0 or not size:
            continue
        chars[node] += size
        words[node] += text.count(" ") + 1
        stops[node] += len(_STOPS.findall(text))
        if i in links:
            linked[node] += size
        if start[node] < 0:
            start[node] = at
        at += size
    own = chars.copy()
    tags, paragraphs, paragraph_chars, items = np.ones(n), np.zeros(n), np.zeros(n), np.zeros(n)
    for i, t in enumerate(page.tag):
        if t == "p":
            paragraphs[i], paragraph_chars[i] = 1, own[i]
        elif t == "li":
            items[i] = 1
    first = start.copy()
    # Parents come before their children, but for text leaves, whose parents do too.
    for i in range(n - 1, 0, -1):
        p = parent[i]
        for v in (chars, words, stops, linked, tags, paragraphs, items):
            v[p] += v[i]
        paragraph_chars[p] += paragraph_chars[i]
        if first[i] >= 0 and (first[p] < 0 or first[i] < first[p]):
            first[p] = first[i]
    total = max(chars[0], 1.0)
    density = chars / tags
    kids = np.bincount(parent[1:], minlength=n)
    order: dict[int, list[int]] = {}
    for i in range(1, n):
        order.setdefault(page.parent[i], []).append(i)
    place, same, before, after = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    for members in order.values():
        tally: dict[str, int] = {}
        for i in members:
            tally[page.tag[i]] = tally.get(page.tag[i], 0) + 1
        for k, i in enumerate(members):
            place[i], same[i] = k / len(members), tally[page.tag[i]] / len(members)
            before[i] = density[members[k - 1]] if k else 0
            after[i] = density[members[k + 1]] if k + 1 < len(members) else 0
    get = odds.table.get
    learned = np.zeros((n, len(LEARNED)))
    for i in range(n):
        mine = [get(x, 0.0) for x in page.names[i]]
        up = learned[page.parent[i]] if i else np.zeros(len(LEARNED))
        tag = get("<" + page.tag[i], 0.0)
        lowest = min(mine, default=0.0)
        learned[i] = (tag, sum(mine), lowest, min(up[0], up[3]), up[1] + up[4], min(up[2], up[5]))
    up = np.maximum(parent, 0)
    link_share = linked / np.maximum(chars, 1)
    numbers = np.stack([
        np.array(page.depth, float), np.log1p(chars), np.log1p(own), chars / np.maximum(words, 1), stops / np.maximum(words, 1),
        link_share, np.log1p(tags), np.log1p(density), chars / total, np.maximum(first, 0) / total, kids, place,
        np.log1p(kids[up]), same, np.log1p(before), np.log1p(after), link_share[up], chars[up] / total, np.log1p(density[up]),
        np.log1p(paragraphs), paragraph_chars / np.maximum(chars, 1), np.log1p(items), (kids == 0).astype(float),
        (paragraph_chars / np.maximum(chars, 1))[up], own / np.maximum(chars, 1)], 1)
    return np.concatenate([numbers, learned], 1)


# --------------------------------------------------------------- boosted trees

class Boosted:
    """Binary log-loss trees of fixed depth, grown by histograms."""

    def __init__(self):
        self.base, self.feature, self.cut, self.value = 0.0, np.zeros((0, 0), np.int64), np.zeros((0, 0)), np.zeros((0, 0))

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE) -> Boosted:
        model = Boosted()
        share = min(max(float(y.mean()), 1e-3), 1 - 1e-3) if len(y) else 0.5
        model.base = float(np.log(share / (1 - share)))
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
        score = np.full(len(y), model.base)
        features, cuts, values = [], [], []
        n_features = x.shape[1]
        offset = np.arange(n_features) * bins
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            g, h = p - y, np.maximum(p * (1 - p), 1e-6)
            feature, cut = np.zeros(2 ** depth - 1, np.int64), np.full(2 ** depth - 1, np.inf)
            node = np.zeros(len(y), np.int64)                  # place within the level
            for level in range(depth):
                size = 2 ** level
                key = (node[:, None] * (n_features * bins) + offset + binned).ravel()
                gs = np.bincount(key, np.repeat(g, n_features), size * n_features * bins).reshape(size, n_features, bins).cumsum(2)
                hs = np.bincount(key, np.repeat(h, n_features), size * n_features * bins).reshape(size, n_features, bins).cumsum(2)
                g_all, h_all = gs[:, :, -1:], hs[:, :, -1:]
                gain = gs ** 2 / (hs + 1) + (g_all - gs) ** 2 / (h_all - hs + 1) - g_all ** 2 / (h_all + 1)
                right = np.zeros(len(y), bool)
                for k in range(size):
                    f, b = divmod(int(gain[k].argmax()), bins)
                    if gain[k, f, b] > 1e-6 and b < len(edges[f]):
                        feature[size - 1 + k], cut[size - 1 + k] = f, edges[f][b]
                        right |= (node == k) & (binned[:, f] > b)
                node = 2 * node + right
            value = -np.bincount(node, g, 2 ** depth) / (np.bincount(node, h, 2 ** depth) + 1) * rate
            score += value[node]
            features.append(feature)
            cuts.append(cut)
            values.append(value)
        model.feature, model.cut, model.value = np.stack(features), np.stack(cuts), np.stack(values)
        return model

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            while len(x) and node[0] < len(feature):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            score += value[node - len(feature)] if len(x) else 0.0
        return score


# ------------------------------------------------------------------- decoding

def decode(page: Page, log_odds: np.ndarray) -> np.ndarray:
    """The likeliest labels in which a kept node's parents are all kept."""
    gain = np.clip(log_odds, -8, 8)                          # log P(keep) - log P(drop)
    best = gain.copy()
    n = len(best)
    for i in range(n - 1, 0, -1):
        if best[i] > 0:
            best[page.parent[i]] += best[i]
    keep = np.zeros(n, bool)
    keep[0] = best[0] > 0
    for i in range(1, n):
        keep[i] = keep[page.parent[i]] and best[i] > 0
    return keep


class Extractor:
    def __init__(self, odds: Odds, trees: Boosted):
        self.odds, self.trees = odds, trees

    def texts(self, sources: list[str]) -> list[str]:
        pages = [Page(s) for s in sources]
        x = [page_features(p, self.odds) for p in pages]
        scores = self.trees.log_odds(np.concatenate(x)) if x else np.zeros(0)
        ends = np.cumsum([len(v) for v in x])
        return [p.text_of(decode(p, s)) for p, s in zip(pages, np.split(scores, ends[:-1]) if x else [], strict=True)]

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        t = self.trees
        np.savez_compressed(out, names=np.array(list(self.odds.table), str), odds=np.array(list(self.odds.table.values())),
                            base=t.base, feature=t.feature, cut=t.cut, value=t.value)
        return out.getvalue()

    @staticmethod
    def from_bytes(data: bytes) -> Extractor:
        kept = np.load(io.BytesIO(data))
        trees = Boosted()
        trees.base, trees.feature, trees.cut, trees.value = float(kept["base"]), kept["feature"], kept["cut"], kept["value"]
        return Extractor(Odds(dict(zip(kept["names"].tolist(), kept["odds"].tolist(), strict=True))), trees)


# -------------------------------------------------------------------- training

def page_texts(source: str) -> tuple[list[tuple[str, str]], list[str]]:
    """(tag, text) blocks of the article a page marks, and its other texts."""
    page = Page(source)
    inside = np.zeros(len(page.tag), bool)
    for i in range(1, len(page.tag)):
        inside[i] = inside[page.parent[i]] or page.tag[i] in ("article", "main")
    texts: dict[int, str] = {}
    for node, text in page.pieces:
        if node >= 0:
            texts[node] = texts.get(node, "") + text
    blocks = [(i, " ".join(t.split())) for i, t in texts.items() if t.strip()]
    main = [(page.tag[i] if page.tag[i] in ("h1", "h2", "h3", "p", "li", "blockquote", "pre") else "p", t) for i, t in blocks if inside[i]]
    return main, [t for i, t in blocks if not inside[i]]


def lay_out(main: list[tuple[str, str]], others: list[str], rng: np.random.Generator) -> str:
    """A page shape around the article.  Main texts begin with ``MARK`` for
    labelling; it is taken out before features are made."""
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    esc = html.escape
    pool = others + [t for _, t in main[-2:]] + list(FALLBACK)

    def words(low: int, high: int) -> str:
        text = pick(pool).split() or ["more"]
        start = int(rng.integers(len(text)))
        return esc(" ".join((text[start:] + text)[:int(rng.integers(low, high + 1))]))

    def inner(kind: str) -> str:
        if kind == "header" and rng.random() < 0.5:               # the site's name, often as a heading
            name = f"<{pick(('h1', 'h1', 'h2', 'div'))}>{words(1, 4)}</" if rng.random() < 0.8 else ""
            name = f"{name}{name[1:name.index('>')]}>" if name else ""
            return name + (f'<a href="/">{words(1, 2)}</a>' if rng.random() < 0.6 or not name else "") + (f"<p>{words(2, 8)}</p>" if rng.random() < 0.3 else "")
        if kind in ("menu", "sidebar") or (kind in ("header", "footer") and rng.random() < 0.5):
            items = "".join(f'<li><a href="/x">{words(1, 6)}</a></li>' for _ in range(int(rng.integers(2, 9))))
            return (f"<h3>{words(1, 3)}</h3>" if rng.random() < 0.4 else "") + f"<ul>{items}</ul>"
        if kind == "comments" and rng.random() < 0.3:             # no names: who, and what they say
            said = lambda: f"{words(1, 2)}: {words(2, 14)}"
            return "".join(f"<p>{said()}</p>" if rng.random() < 0.7 else f"<div>{said()}</div>" for _ in range(int(rng.integers(1, 7))))
        if kind == "comments":
            note = lambda: f"<p>{words(6, 50)}</p>" if rng.random() < 0.6 else words(6, 50)
            return (f"<h3>{words(1, 3)}</h3>" if rng.random() < 0.7 else "") + "".join(
                f'<div class="{pick(PART_NAMES["comments"])}"><b>{words(1, 2)}</b> {note()}</div>' if rng.random() < 0.5 else f"<p>{words(5, 50)}</p>"
                for _ in range(int(rng.integers(1, 6))))
        if kind == "form":
            return f'<label>{words(1, 4)}</label><input type="text"><button>{words(1, 2)}</button>' + (f"<p>{words(3, 15)}</p>" if rng.random() < 0.5 else "")
        body = words(2, 25)
        return f"<p>{body}</p>" if rng.random() < 0.4 else (f'<a href="/y">{body}</a>' if rng.random() < 0.3 else body)

    def part(kind: str) -> str:
        tag = PART_TAGS[kind] if rng.random() < 0.5 else pick(("div", "section", "div"))
        name = ""
        nameless = kind == "comments" and rng.random() < 0.3
        if not nameless and (tag != PART_TAGS[kind] or PART_TAGS[kind] in ("div", "section") or rng.random() < 0.4):
            name = f' {pick(("class", "id"))}="{pick(PART_NAMES[kind])}{pick(("", "-box", " wide", "-1"))}"'
        return f"<{tag}{name}>{inner(kind)}</{tag}>"

    if rng.random() < 0.3:                                    # short articles too
        main = main[:int(rng.integers(1, 4))]
        if rng.random() < 0.6:
            main = [(t, " ".join(x.split()[:int(rng.integers(1, 8))])) for t, x in main]
    untitled = [x for x in main if x[0] not in ("h1", "h2", "h3")]
    if untitled and rng.random() < 0.2:
        main = untitled
    # Some articles stand in bare text with line breaks, some in plain divs.
    style = rng.random()
    bare, plain = style < 0.2, 0.2 <= style < 0.3
    blocks = []
    for tag, text in main:
        if tag == "p" and (bare or (style > 0.9 and rng.random() < 0.3)):
            blocks.append(f"{MARK}{esc(text)}<br><br>")
        else:
            tag = "div" if plain and tag == "p" else tag
            blocks.append(f"<{tag}>{MARK}{esc(text)}</{tag}>")
    for kind in ("advert", "form", "sidebar", "comments", "notice", "menu"):
        if rng.random() < 0.2:
            blocks.insert(len(blocks) if kind == "comments" else int(rng.integers(len(blocks) + 1)), part(kind))
    container = pick(("article", "article", "main", "div", "div", "section", ""))
    if container and main and main[0][0] in ("h1", "h2", "h3") and rng.random() < 0.35:
        # The article's own header holds its title.
        title = next(i for i, b in enumerate(blocks) if MARK in b)
        blocks[title] = f"<header{pick(('', ' class=entry-header', ' class=article-header', ' class=post-header'))}>{blocks[title]}</header>"
    body = "".join(blocks)
    if container:
        name = f' {pick(("class", "id"))}="{pick(CONTENT_NAMES)}"' if container in ("div", "section") and rng.random() < 0.8 or rng.random() < 0.3 else ""
        body = f"<{container}{name}>{body}</{container}>"
        if rng.random() < 0.3:
            body = f"<div{pick(('', ' class=wrapper', ' id=page', ' class=container'))}>{body}{part('sidebar')}</div>"
    top = "".join(part(k) for k in ("notice", "header", "menu", "advert", "form") if rng.random() < 0.5)
    low = "".join(part(k) for k in ("comments", "sidebar", "advert", "form", "footer", "notice") if rng.random() < 0.5)
    return f"<html><body>{top}{body}{low}</body></html>"


def fit(sources: list[str], shapes: int = SHAPES_PER_PAGE, seed: int = SEED) -> Extractor:
    """Trees from pages that mark their article, in a fixed order."""
    rng = np.random.default_rng(seed)
    known = [t for t in map(page_texts, sources) if t[0]] or [([("h1", FALLBACK[2]), ("p", FALLBACK[0]), ("p", FALLBACK[1])], [FALLBACK[2]])] * 40
    pages, labels = [], []
    for main, others in known:
        for _ in range(shapes):
            page = Page(lay_out(main, others, rng))
            y = np.zeros(len(page.tag), np.int64)
            for i, (node, text) in enumerate(page.pieces):
                if MARK in text:
                    page.pieces[i] = (node, text.replace(MARK, ""))
                    y[node] = 1
            # Every node around main text is kept with it.
            for i in range(len(y) - 1, 0, -1):
                y[page.parent[i]] |= y[i]
            pages.append(page)
            labels.append(y)
    odds = Odds.learn(pages, labels)
    x = np.concatenate([page_features(p, odds) for p in pages])
    return Extractor(odds, Boosted.fit(x, np.concatenate(labels).astype(float)))


def train(pages: DataFrame, limit: int = TRAIN_PAGES) -> bytes:
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html"))
    # The sample's ids first (bounded by ``limit``); their pages are then few as well.
    marked = rows.filter(F.col("html").rlike("(?i)<(article|main)[\\s>]")).select("page_id", F.xxhash64("page_id").alias("ev_key"))
    chosen = marked.filter("page_id is not null").orderBy("ev_key", "page_id").limit(limit).distinct()
    sample = rows.join(F.broadcast(chosen), "page_id").select("ev_key", "html").repartition(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for b in batches:
            found += [(k, h) for k, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if h]
        yield pa.RecordBatch.from_arrays([pa.array([fit([h for _, h in sorted(found)]).to_bytes()], pa.binary())], ["model"])

    made = sample.mapInArrow(run, "model binary").collect()
    return bytes(made[0]["model"]) if made else fit([]).to_bytes()


def extract(pages: DataFrame, model: bytes) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    sent = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extractor = Extractor.from_bytes(sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_PAGES):
                part = batch.slice(at, BATCH_PAGES)
                texts = extractor.texts([h or "" for h in part.column(2).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()),
                                                  pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
