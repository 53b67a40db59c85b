"""Operator 5, main-text extraction from HTML.

Gradient-boosted trees judge each block node of a page's tree from its text and link density (its own and its subtree's),
the tokens of its tag and attributes and of its ancestors', its depth and its siblings. Decoding is hierarchical: the best
set of kept nodes in which nothing is kept under a dropped node. The trees are trained here, on pages that are made by rule
with all the parts of real ones in random wording and order (``training_pages``).
"""

from __future__ import annotations

import html
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taskspire.llm.common import map_arrow

# ---------------------------------------------------------------- the page's tree

INLINE = frozenset(
    "a abbr acronym b bdi bdo big canvas cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr "
    "math semantics mrow mi mn mo ms mtext mspace msup msub msubsup mfrac msqrt mroot mover munder munderover mstyle mpadded menclose mtable mtr mtd "
    "svg g text tspan textpath path rect circle ellipse line polyline polygon".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = "script|style|noscript|template|iframe|object|textarea|select|annotation|annotation-xml|defs|metadata"
#: Elements that a start tag ends if they are open: tag -> (what it ends, where the search stops).
_PARAGRAPH_ENDS = frozenset("address article aside blockquote center details dialog dir div dl dt dd fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table ul td th tr".split())
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, set()), "body": ({"head"}, set()),
}
#: What follows a tag's name: a quote opens a value only after '='; elsewhere it is a character like others.
_REST = r"(?:=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*)|[^>])*+"
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(" + SILENT + r")(?=[\s/>])" + _REST + r">.*?(?:</\1\s*>|\Z)|<(/?)([a-z][a-z0-9:-]*)(" + _REST + r")>|<[!?][^>]*>", re.S | re.I)
#: A tag that the page's end cuts off.
_CUT_OFF = re.compile(r"<[a-z/!?]", re.I)
_ATTRIBUTE = re.compile(r"\b(?:class|id|role|aria-label|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Page:
    """Node i has its parent and depth; block j (a run of text) belongs to a node. Node 0 is the root."""

    tag: list[str] = field(default_factory=lambda: ["#root"])
    parent: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])
    attributes: list[str] = field(default_factory=lambda: [""])
    block_node: list[int] = field(default_factory=list)
    block_text: list[str] = field(default_factory=list)
    block_link: list[int] = field(default_factory=list)  # characters inside links


def parse(page: str) -> Page:
    out = Page()
    stack, links, at = [0], 0, 0
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            raw = "".join(parts)
            text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
            if text:
                out.block_node.append(stack[-1])
                out.block_text.append(text)
                out.block_link.append(linked)
            parts.clear()
        linked = 0

    for m in _TAG.finditer(page):
        if m.start() > at:
            part = page[at : m.start()]
            parts.append(part)
            if links:
                linked += len(part)
        at = m.end()
        name = m[3]
        if not name:
            continue
        name = name.lower()
        if m[2]:
            if name == "a":
                links = max(0, links - 1)
            elif name not in INLINE:
                for i in range(len(stack) - 1, 0, -1):
                    if out.tag[stack[i]] == name:
                        flush()
                        del stack[i:]
                        links = 0
                        break
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in INLINE:
            links += name == "a"
            continue
        if name in VOID:
            if name == "hr":
                flush()
            continue
        flush()
        links = 0
        if name in _PARAGRAPH_ENDS and out.tag[stack[-1]] == "p":
            stack.pop()
        if out.tag[stack[-1]] == "head" and name not in ("title", "meta", "link", "base"):
            stack.pop()
        if name in _ENDS:
            ends, stop = _ENDS[name]
            for i in range(len(stack) - 1, 0, -1):
                if out.tag[stack[i]] in stop:
                    break
                if out.tag[stack[i]] in ends:
                    del stack[i:]
                    break
        out.tag.append(name)
        out.parent.append(stack[-1])
        out.depth.append(out.depth[stack[-1]] + 1)
        out.attributes.append(" ".join(a or b or c for a, b, c in _ATTRIBUTE.findall(m[4])) if m[4] else "")
        stack.append(len(out.tag) - 1)
    rest = _CUT_OFF.split(page[at:], maxsplit=1)[0]
    if rest:
        parts.append(rest)
        if links:
            linked += len(rest)
    flush()
    return out


# ---------------------------------------------------------------- features

FEATURES = (
    "own_chars", "own_words_a_block", "own_link_share", "own_stops", "tree_chars", "tree_link_share", "tree_blocks", "tree_nodes", "tree_chars_a_node", "tree_longest", "page_share",
    "depth", "place", "siblings", "same_tag", "siblings_chars", "before_share", "token_score", "token_least", "ancestor_least", "ancestor_most", "child_token_least", "is_heading", "is_item",
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


def tokens_of(tag: str, attributes: str) -> list[str]:
    return [f"<{tag}>", *(t.lower() for t in _TOKEN.findall(attributes))] if attributes else [f"<{tag}>"]


def features(page: Page, weight: dict[str, float]) -> np.ndarray:
    """A row for each node; ``weight`` has the learned log-odds of tokens."""
    n = len(page.tag)
    own, link, blocks, words, stops, longest = ([0] * n for _ in range(6))
    for node, text, linked in zip(page.block_node, page.block_text, page.block_link, strict=True):
        size = len(text)
        own[node] += size
        link[node] += min(linked, size)
        blocks[node] += 1
        words[node] += text.count(" ") + 1
        stops[node] += text.count(". ") + text.count(", ") + text.endswith(".")
        longest[node] = max(longest[node], size)
    tree, tlink, tblocks, tnodes, tlong = own[:], link[:], blocks[:], [1] * n, longest[:]
    kids: list[list[int]] = [[] for _ in range(n)]
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        tree[p] += tree[i]
        tlink[p] += tlink[i]
        tblocks[p] += tblocks[i]
        tnodes[p] += tnodes[i]
        tlong[p] = max(tlong[p], tlong[i])
    for i in range(1, n):
        kids[page.parent[i]].append(i)
    child_least = [math.inf] * n
    total, seen = max(1, tree[0]), 0
    score, least, a_least, a_most = [0.0] * n, [0.0] * n, [0.0] * n, [0.0] * n
    cache: dict[tuple[str, str], tuple[float, float]] = {}
    for i in range(n):
        key = (page.tag[i], page.attributes[i])
        if key not in cache:
            got = [weight.get(t, 0.0) for t in tokens_of(*key)]
            cache[key] = (sum(got), min(got))
        score[i], least[i] = cache[key]
        if i:
            p = page.parent[i]
            a_least[i], a_most[i] = min(a_least[p], score[p]), max(a_most[p], score[p])
            child_least[p] = min(child_least[p], score[i])
    rows = np.zeros((n, len(FEATURES)), np.float32)
    log = math.log1p
    for i in range(n):
        p = page.parent[i]
        near = kids[p] if i else [0]
        mean = (tree[p] - own[p]) / len(near) if i else tree[0]
        rows[i] = (
            log(own[i]), words[i] / max(1, blocks[i]), link[i] / max(1, own[i]), stops[i] / max(1, words[i]), log(tree[i]), tlink[i] / max(1, tree[i]), log(tblocks[i]), log(tnodes[i]), log(tree[i] / tnodes[i]), log(tlong[i]), tree[i] / total,
            page.depth[i], 0.0, log(len(near)), 0.0, log(mean), seen / total, score[i], least[i], a_least[i], a_most[i], child_least[i] if kids[i] else 0.0, page.tag[i] in HEADINGS, page.tag[i] == "li",
        )
        seen += own[i]
    for near in kids:
        if near:
            same: dict[str, int] = {}
            for k in near:
                same[page.tag[k]] = same.get(page.tag[k], 0) + 1
            for place, k in enumerate(near):
                rows[k, 12], rows[k, 14] = place / len(near), same[page.tag[k]] / len(near)
    return rows


# ---------------------------------------------------------------- boosted trees


@dataclass
class Trees:
    """Complete binary trees of one depth: node i of a tree has the children 2i + 1 (at most the bound) and 2i + 2."""

    base: float
    feature: np.ndarray
    bound: np.ndarray
    leaf: np.ndarray

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows, inner = np.arange(len(x)), self.feature.shape[1]
        depth = (inner + 1).bit_length() - 1
        for t in range(len(self.feature)):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, self.feature[t, at]] > self.bound[t, at])
            out += self.leaf[t, at - inner]
        return out


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 50, depth: int = 4, rate: float = 0.2, bins: int = 32, ridge: float = 2.0) -> Trees:
    """Newton boosting of the logistic loss over histograms of each feature's quantiles."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], axis=1)
    base = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    f = np.full(len(y), base)
    inner, leaves = 2**depth - 1, 2**depth
    out = Trees(base, np.zeros((rounds, inner), np.int64), np.full((rounds, inner), np.inf, np.float32), np.zeros((rounds, leaves)))
    for t in range(rounds):
        p = 1 / (1 + np.exp(-f))
        g, h = p - y, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            best, where = np.zeros(width), [(0, np.inf)] * width
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                key = (at - first) * (len(e) + 1) + binned[:, j]
                gs = np.bincount(key, g, width * (len(e) + 1)).reshape(width, -1).cumsum(axis=1)
                hs = np.bincount(key, h, width * (len(e) + 1)).reshape(width, -1).cumsum(axis=1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + ridge) + (gt - gs) ** 2 / (ht - hs + ridge) - gt**2 / (ht + ridge)
                top = gain[:, :-1].argmax(axis=1)
                for w in range(width):
                    if gain[w, top[w]] > best[w] + 1e-9:
                        best[w], where[w] = gain[w, top[w]], (j, e[top[w]])
            for w, (j, bound) in enumerate(where):
                out.feature[t, first + w], out.bound[t, first + w] = j, bound
            at = 2 * at + 1 + (x[np.arange(len(y)), out.feature[t, at]] > out.bound[t, at])
        gl, hl = np.bincount(at - inner, g, leaves), np.bincount(at - inner, h, leaves)
        out.leaf[t] = -rate * gl / (hl + ridge)
        f += out.leaf[t, at - inner]
    return out


# ---------------------------------------------------------------- training pages

# The wording of class and id attributes from which training pages draw.
NAMES = {
    "content": "article post entry story content main body text article-body post-content entry-content story-body main-content page-content rich-text blog-post single hentry article__text",
    "header": "header masthead top site-header page-header topbar branding logo hero-nav banner-top",
    "nav": "nav menu navigation navbar main-menu breadcrumb breadcrumbs pagination pager tabs toc site-nav primary-nav skip-links",
    "ad": "ad ads advert advertisement banner sponsor sponsored promo promotion adsbox ad-slot google-ad native-ad outbrain",
    "notice": "notice cookie cookie-notice cookie-banner consent gdpr alert disclaimer message warning popup modal newsletter-popup paywall privacy-notice",
    "sidebar": "sidebar side aside widget secondary rail right-column related related-posts recommended trending popular more-stories tags share social sharing author-box",
    "form": "form search search-form newsletter subscribe signup login contact-form register feedback poll",
    "comments": "comments comment comment-list discussion responses disqus replies reader-comments user-comments comment-body",
    "footer": "footer bottom site-footer page-footer copyright colophon legal credits foot footer-links",
}
TAGS = {"content": ("article", "div", "section", "main"), "header": ("header", "div"), "nav": ("nav", "div", "ul"), "ad": ("div", "aside", "section", "ins"), "notice": ("div", "section", "p"), "sidebar": ("aside", "div", "section"), "form": ("form", "div"), "comments": ("section", "div", "ol"), "footer": ("footer", "div")}
KEEP = "\x01"


def training_pages(n: int, seed: int = 5) -> Iterator[str]:
    """Pages in which each text that belongs to the article begins with KEEP."""
    r = random.Random(seed)
    syllables = "the an re tion er in on st en ed or ing le la de un que ou et men ver lich sch ung ge ein co ra do es cion te".split()

    def words(a: int, b: int) -> str:
        out = ["".join(r.choices(syllables, k=r.choice((1, 1, 2, 2, 3)))) for _ in range(r.randint(a, b))]
        for i in range(len(out)):
            if r.random() < 0.1:
                out[i] += r.choice(".,")
        return " ".join(out).capitalize() + r.choice((".", ".", ""))

    def block(kind: str, inside: str, bare: float = 0.15) -> str:
        tag = r.choice(TAGS[kind])
        name = r.choice(NAMES[kind].split())
        semantic = tag not in ("div", "section", "p", "ul", "ol", "ins")
        attribute = "" if r.random() < (0.6 if semantic else bare) else f' {r.choice(("class", "class", "id"))}="{name}{r.choice(("", "", " x" + str(r.randint(1, 9)), " " + r.choice(("col", "row", "box", "inner", "wide"))))}"'
        if tag in ("ul", "ol"):
            inside = f"<li>{inside}</li>"
        return f"<{tag}{attribute}>{inside}</{tag}>"

    def links(a: int, b: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{i}">{words(1, 4)}</a></li>' for i in range(r.randint(a, b))) + "</ul>" if r.random() < 0.7 else " | ".join(f'<a href="/{i}">{words(1, 3)}</a>' for i in range(r.randint(a, b)))

    def prose(a: int, b: int, most: int, keep: str) -> str:
        out = []
        for _ in range(r.randint(a, b)):
            text = words(1, 6) if r.random() < 0.15 else words(4, most)
            if r.random() < 0.2:
                text += f' <a href="/x">{words(1, 3)}</a> ' + words(2, 20)
            if r.random() < 0.15:
                text = f"<b>{keep}{text}</b>" if r.random() < 0.5 else f"<b>{keep}{text}<br>"
                out.append(f"<p>{text}</p>")
            else:
                out.append(f"<p>{keep}{text}</p>")
            if keep and r.random() < 0.08:
                out.append(f"<h2>{keep}{words(2, 6)}</h2>")
            if keep and r.random() < 0.06:
                out.append("<ul>" + "".join(f"<li>{keep}{words(2, 15)}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            if keep and r.random() < 0.04:
                out.append(f"<blockquote><p>{keep}{words(5, 40)}</p></blockquote>")
            if keep and r.random() < 0.03:
                out.append("<table>" + "".join(f"<tr><td>{keep}{words(1, 4)}</td><td>{keep}{words(1, 4)}</td></tr>" for _ in range(r.randint(2, 4))) + "</table>")
        return "".join(out)

    def form() -> str:
        return block("form", f"<label>{words(1, 4)}</label><input name=q><button>{words(1, 2)}</button>" + (f"<p>{words(3, 15)}</p>" if r.random() < 0.5 else ""), 0.05)

    for _ in range(n):
        size = r.choice((2, 5, 10, 20))
        inside = (f"<h1>{KEEP}{words(3, 12)}</h1>" if r.random() < 0.85 else "") + prose(1, size, r.choice((15, 40, 120)), KEEP)
        extras = [lambda: block("ad", words(2, 25) if r.random() < 0.5 else prose(1, 2, 25, ""), 0.0), lambda: block("sidebar", links(2, 6), 0.05), form, lambda: block("notice", words(4, 25), 0.0)]
        if r.random() < 0.35:
            extra = r.choice(extras)()
            half = inside.rfind("</p>", 0, r.randint(1, len(inside))) + 4 if "</p>" in inside else 0
            inside = inside[:half] + extra + inside[half:] if half > 3 and "<table>" not in inside else inside + extra
        if r.random() < 0.1:
            inside += block("comments", prose(1, 4, 40, ""), 0.0)
        article = block("content", inside, 0.1)
        around = [article]
        if r.random() < 0.4:
            around.append(block("comments", (f"<h3>{words(1, 3)}</h3>" if r.random() < 0.6 else "") + "".join(f'<div class="comment">{prose(1, 2, 50, "")}</div>' if r.random() < 0.7 else prose(1, 2, 50, "") for _ in range(r.randint(1, 6))), 0.0))
        if r.random() < 0.5:
            around.insert(r.randint(0, len(around)), block("sidebar", f"<h3>{words(1, 3)}</h3>" * (r.random() < 0.6) + (links(2, 9) if r.random() < 0.6 else prose(1, 3, 30, "")), 0.05))
        if r.random() < 0.3:
            around.insert(r.randint(0, len(around)), form())
        middle = "".join(around)
        for _ in range(r.choice((0, 0, 1, 2))):
            middle = f'<div{r.choice(("", " id=" + chr(34) + r.choice(("page", "wrapper", "container", "main", "content", "site", "layout")) + chr(34), " class=" + chr(34) + r.choice(("container", "wrap", "row", "grid", "col")) + chr(34)))}>{middle}</div>'
        before, after = [], []
        if r.random() < 0.4:
            before.append(block("header", f"<p>{words(1, 5)}</p>" + (links(2, 6) if r.random() < 0.5 else ""), 0.02))
        if r.random() < 0.8:
            before.append(block("nav", links(3, 9), 0.1))
        if r.random() < 0.55:
            (before if r.random() < 0.7 else after).append(block("ad", words(2, 25), 0.0))
        if r.random() < 0.3:
            (before if r.random() < 0.5 else after).append(block("notice", words(4, 30) if r.random() < 0.6 else prose(1, 2, 30, "") + "<button>ok</button>", 0.0))
        if r.random() < 0.85:
            after.append(block("footer", f"&copy; {words(1, 10)}" if r.random() < 0.6 else f"<p>{words(3, 20)}</p>" + links(2, 6), 0.03))
        yield f"<!DOCTYPE html><html><head><title>{words(2, 8)}</title></head><body>{''.join(before)}{middle}{''.join(after)}</body></html>"


@dataclass
class Extractor:
    weight: dict[str, float]
    trees: Trees

    def texts(self, pages: list[str | None]) -> list[str]:
        """The main text of each page; '' where there is none. Scores are made for all pages at once, decoding goes page by page."""
        parsed = [parse(p or "") for p in pages]
        rows = [features(p, self.weight) for p in parsed]
        logits = self.trees.logit(np.concatenate(rows)) if rows else np.zeros(0)
        out, at = [], 0
        for p in parsed:
            out.append("\n".join(t for t, node in zip(p.block_text, decode(p, logits[at : at + len(p.tag)].tolist())[0], strict=True) if node))
            at += len(p.tag)
        return out


def decode(page: Page, logit: list[float]) -> tuple[list[bool], list[bool]]:
    """For each block and for each node whether it is kept: the set of greatest total log-odds in which all ancestors of a kept node are kept."""
    n = len(page.tag)
    kept, dropped = list(logit), [-x for x in logit]
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        kept[p] += max(kept[i], dropped[i])
        dropped[p] += dropped[i]
    keep = [False] * n
    for i in range(n):
        keep[i] = kept[i] > dropped[i] and (i == 0 or keep[page.parent[i]])
    return [keep[node] for node in page.block_node], keep


def train(pages: int = 700, seed: int = 5) -> Extractor:
    """Learns the tokens' log-odds and the trees. A node counts as kept if any text of the article lies in it."""
    parsed, labels, good, bad = [], [], {}, {}
    for source in training_pages(pages, seed):
        p = parse(source)
        keep = [False] * len(p.tag)
        for node, text in zip(p.block_node, p.block_text, strict=True):
            keep[node] = keep[node] or KEEP in text
        p.block_text = [t.replace(KEEP, "") for t in p.block_text]
        for i in range(len(keep) - 1, 0, -1):
            keep[p.parent[i]] = keep[p.parent[i]] or keep[i]
        parsed.append(p)
        labels.append(keep)
        for i, k in enumerate(keep):
            for t in set(tokens_of(p.tag[i], p.attributes[i])):
                (good if k else bad)[t] = (good if k else bad).get(t, 0) + 1
    weight = {t: math.log((good.get(t, 0) + 1) / (bad.get(t, 0) + 1)) for t in {*good, *bad} if good.get(t, 0) + bad.get(t, 0) >= 3}
    x = np.concatenate([features(p, weight) for p in parsed])
    return Extractor(weight, boost(x, np.concatenate(labels).astype(float)))


def extract(pages: DataFrame, extractor: Extractor) -> DataFrame:
    """page_id, url, text, n_chars for each page. Null, empty or wholly dropped pages give ''."""
    model = pages.sparkSession.sparkContext.broadcast(extractor)  # some tens of trees: fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                texts = model.value.texts(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    source = pages.select("page_id", "url", "html")
    return map_arrow(source, run, source.select("page_id", "url", F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema)


def op5_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"), train())


QUERIES = {"op5_html_extraction": op5_html_extraction}
SQL: dict[str, str] = {}
