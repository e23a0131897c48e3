"""HTML extraction: boosted trees over DOM blocks, decoded from the root down.

A page is read into its block elements. Each gets features of itself and its surroundings:
subtree text and link density, attribute tokens, kind of tag, depth and sibling statistics.
Gradient-boosted trees give the odds that a block belongs to the article. Decoding picks
for every subtree the best of three: all article, no article, or mixed, at a price, with
its children decided one by one; so no block is kept below one that was dropped as a whole.

The trees are trained here, on pages that a small grammar of layouts writes (``training_page``);
their number is fixed, so the model has one size for any input. Scripts, styles, forms,
comments, titles and controls are never text, whatever the trees say.

Defined results: null and empty pages give an empty text; markup without text too; text
outside any element is judged as the page's body; unclosed and wrongly nested tags are
closed as browsers do; rows are independent, so repeats get equal texts.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea|title|iframe|noembed|noframes|xmp)\b(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>=]++|=)*+"
    r"(?:>.*?(?:</\1[^>]*>|\Z)|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>=]++|=)*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"(class|id|role|style|hidden|aria-hidden|aria-label)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
PART = re.compile(r"[a-z]+")

HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
BLOCKS = HEADINGS | frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot "
    "th thead tr ul template noscript svg math select button object audio video canvas head".split()
)
NEVER = frozenset("form button select template noscript svg math object audio video canvas head dialog fieldset".split())
SINGLE = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# An open element that the start of another one ends, unless an element of the third set is between.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table", "tbody", "thead", "tfoot")),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "body": (("head",), ()),
}
KINDS = {
    **dict.fromkeys(HEADINGS, 1), "p": 2, "pre": 2, "blockquote": 2, "ul": 3, "ol": 3, "dl": 3, "menu": 3,
    "li": 4, "dd": 4, "dt": 4, "table": 5, "tbody": 5, "tr": 5, "td": 5, "th": 5, "div": 6, "section": 6,
    "center": 6, "article": 7, "main": 7, "nav": 8, "footer": 9, "header": 10, "aside": 11, "figure": 12,
    "figcaption": 12, "address": 13, "body": 14, "html": 14,
}
AWAY = frozenset(
    "nav navbar navigation menu header masthead topbar footer foot sidebar side aside ad ads advert adverts "
    "advertisement sponsor sponsored promo promotion banner cookie cookies consent gdpr notice alert popup modal "
    "overlay comment comments reply replies discussion disqus share sharing social related recommended trending "
    "breadcrumb breadcrumbs login signup subscribe newsletter widget copyright legal search toolbar pagination "
    "pager tags tagcloud meta toc skip feedback".split()
)
HOME = frozenset("article content main post entry story body text prose page blog document".split())


class Page:
    """The block elements of a page and its runs of text, in order."""

    __slots__ = ("tags", "parents", "away", "home", "hidden", "texts", "owners", "links")

    def __init__(self, source: str) -> None:
        self.tags, self.parents, self.away, self.home, self.hidden = ["html"], [-1], [0], [0], [0]
        self.texts: list[str] = []
        self.owners: list[int] = []
        self.links: list[int] = []
        stack, run, linked, in_link, never = [0], [], 0, False, 0

        def flush() -> None:
            nonlocal linked
            if run:
                text = " ".join(html.unescape("".join(run)).split())
                if text and not never:
                    self.texts.append(text)
                    self.owners.append(stack[-1])
                    self.links.append(min(linked, len(text)))
                run.clear()
            linked = 0

        def close(level: int) -> None:
            nonlocal never, in_link
            flush()
            for node in stack[level:]:
                never -= self.tags[node] in NEVER
            del stack[level:]
            in_link = False

        at = 0
        for token in TOKEN.finditer(source):
            if token.start() > at:
                piece = source[at : token.start()]
                run.append(piece)
                if in_link:
                    linked += len(piece)
            at = token.end()
            name = token[3]
            if not name:
                continue
            name = name.lower()
            if name not in BLOCKS:
                if name == "a":
                    in_link = not token[2]
                elif name == "br":
                    run.append(" ")
                continue
            if token[2]:
                level = next((i for i in range(len(stack) - 1, 0, -1) if self.tags[stack[i]] == name), 0)
                if level:
                    close(level)
                continue
            if name == "html":
                continue
            flush()
            if self.tags[stack[-1]] == "p":
                close(len(stack) - 1)
            elif name in ENDS:
                ended, walls = ENDS[name]
                for i in range(len(stack) - 1, 0, -1):
                    tag = self.tags[stack[i]]
                    if tag in ended:
                        close(i)
                        break
                    if tag in walls:
                        break
            if name in SINGLE:
                continue
            node = len(self.tags)
            away = home = hidden = 0
            if token[4]:
                for key, value in ATTRIBUTE.findall(token[4]):
                    key, value = key.lower(), value.strip("\"'").lower()
                    if key == "style":
                        hidden |= "display:none" in value.replace(" ", "")
                    elif key in ("hidden", "aria-hidden"):
                        hidden |= value != "false"
                    else:
                        for part in PART.findall(value):
                            away += part in AWAY
                            home += part in HOME
            self.tags.append(name)
            self.parents.append(stack[-1])
            self.away.append(away)
            self.home.append(home)
            self.hidden.append(hidden)
            stack.append(node)
            never += name in NEVER
            in_link = False
        if at < len(source):
            run.append(source[at:])
        flush()


FEATURES = 25


def block_features(page: Page) -> np.ndarray:
    """One row for each block."""
    n = len(page.tags)
    parents = page.parents
    own, own_links, words, stops = [0] * n, [0] * n, [0] * n, [0] * n
    for text, owner, linked in zip(page.texts, page.owners, page.links):
        own[owner] += len(text)
        own_links[owner] += linked
        words[owner] += text.count(" ") + 1
        stops[owner] += text.count(".") + text.count(",")
    chars, links, count, size, stop, long_ = own[:], own_links[:], words[:], [1] * n, stops[:], [0] * n
    kids, para = [0] * n, [0] * n
    for i in range(n - 1, 0, -1):
        p = parents[i]
        chars[p] += chars[i]
        links[p] += links[i]
        count[p] += count[i]
        size[p] += size[i]
        stop[p] += stop[i]
        kids[p] += 1
        is_para = page.tags[i] == "p"
        para[p] += para[i] + is_para
        long_[p] += long_[i] + (own[i] > 80)
    depth, place, away_above, home_above, kind_above = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
    seen = [0] * n
    alike: dict[tuple[int, str], int] = {}
    for i in range(1, n):
        key = (parents[i], page.tags[i])
        alike[key] = alike.get(key, 0) + 1
    kinds = [KINDS.get(t, 0) for t in page.tags]
    rows = []
    total = max(1, chars[0])
    before = 0
    for i in range(n):
        p = parents[i]
        if i:
            depth[i] = depth[p] + 1
            place[i] = seen[p]
            seen[p] += 1
            away_above[i] = away_above[p] + page.away[p] + (kinds[p] in (8, 9, 10, 11))
            home_above[i] = home_above[p] + page.home[p] + (kinds[p] == 7)
            kind_above[i] = kinds[p]
        c = chars[i]
        rows.append(
            (
                kinds[i], depth[i], kids[i], kids[p] if i else 1, place[i] / max(1, kids[p]) if i else 0,
                alike.get((p, page.tags[i]), 1), own[i], c, links[i] / max(1, c), c / size[i], count[i],
                c / max(1, count[i]), stop[i] / max(1, count[i]), c / total, before / total,
                page.away[i], page.home[i], page.hidden[i], away_above[i], home_above[i], kind_above[i],
                links[p] / max(1, chars[p]) if i else 0, chars[p] / total if i else 1, para[i], long_[i],
            )
        )
        before += own[i]
    return np.array(rows, dtype=np.float64)


class Trees:
    """Gradient boosting on the logistic loss: full binary trees over binned features."""

    def __init__(self, rounds: int = 50, depth: int = 4, rate: float = 0.25, bins: int = 32) -> None:
        self.rounds, self.depth, self.rate, self.bins = rounds, depth, rate, bins
        self.feature = np.zeros((rounds, (1 << depth) - 1), dtype=np.int32)
        self.cut = np.full((rounds, (1 << depth) - 1), np.inf)
        self.leaf = np.zeros((rounds, 1 << depth))
        self.start = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        n, width = x.shape
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins + 1)[1:-1])) for f in range(width)]
        binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
        mean = y.mean()
        self.start = float(np.log(mean / (1 - mean)))
        margin = np.full(n, self.start)
        for t in range(self.rounds):
            p = 1 / (1 + np.exp(-margin))
            g, h = y - p, p * (1 - p)
            node = np.zeros(n, dtype=np.int64)
            for level in range(self.depth):
                width_now = 1 << level
                base = width_now - 1
                best = np.full(width_now, 1e-6)
                for f in range(width):
                    key = node * self.bins + binned[:, f]
                    shape = (width_now, self.bins)
                    gs = np.bincount(key, weights=g, minlength=width_now * self.bins).reshape(shape).cumsum(axis=1)
                    hs = np.bincount(key, weights=h, minlength=width_now * self.bins).reshape(shape).cumsum(axis=1)
                    gt, ht = gs[:, -1:], hs[:, -1:]
                    gain = gs**2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt**2 / (ht + 1)
                    gain[:, len(edges[f]) :] = 0
                    at = gain.argmax(axis=1)
                    top = gain[np.arange(width_now), at]
                    for k in np.flatnonzero(top > best):
                        best[k] = top[k]
                        self.feature[t, base + k] = f
                        self.cut[t, base + k] = edges[f][at[k]]
                node = 2 * node + (x[np.arange(n), self.feature[t, base + node]] > self.cut[t, base + node])
            gs = np.bincount(node, weights=g, minlength=1 << self.depth)
            hs = np.bincount(node, weights=h, minlength=1 << self.depth)
            self.leaf[t] = self.rate * gs / (hs + 1)
            margin += self.leaf[t][node]
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for t in range(self.rounds):
            node = np.zeros(len(x), dtype=np.int64)
            for level in range(self.depth):
                at = (1 << level) - 1 + node
                node = 2 * node + (x[rows, self.feature[t, at]] > self.cut[t, at])
            out += self.leaf[t][node]
        return out


def training_page(rng: random.Random) -> tuple[str, list[tuple[str, bool]]]:
    """A page of a random layout, as (markup, is article) pieces; text of the pieces is random words."""

    def words(low: int, high: int, stop: bool = True) -> str:
        out = []
        for _ in range(rng.randint(low, high)):
            w = "".join(rng.choice("aeioutnrslhdcmp") for _ in range(rng.randint(1, 9)))
            out.append(w + (rng.choice(",.") if stop and rng.random() < 0.15 else ""))
        return " ".join(out)

    pieces: list[tuple[str, bool]] = []
    put = lambda text, good=False: pieces.append((text, good))

    def link_list(n: int) -> str:
        items = "".join(f'<li><a href="/{i}">{words(1, 3, False)}</a></li>' for i in range(n))
        return f"<ul>{items}</ul>"

    def away(kind: str) -> None:
        plain = rng.random() < 0.25
        tag, name = {
            "nav": ("nav", "menu"), "header": ("header", "site-header"), "footer": ("footer", "footer"),
            "side": ("aside", "sidebar"), "ad": ("div", "ad"), "notice": ("div", "cookie-notice"),
            "comments": ("section", "comments"), "related": ("div", "related"), "share": ("div", "share"),
        }[kind]
        name = rng.choice([name, name, {"ad": "advert", "notice": "banner", "side": "widget", "nav": "navbar"}.get(kind, name)])
        if kind in ("nav", "header", "footer", "side") and rng.random() < 0.4:
            tag = "div"
            plain = False
        if tag in ("div", "section"):
            plain = False
        mark = "" if plain else rng.choice([f' class="{name}"', f' id="{name}"'])
        put(f"<{tag}{mark}>")
        if kind in ("nav", "related", "share") or (kind in ("header", "footer", "side") and rng.random() < 0.5):
            put(link_list(rng.randint(2, 12)))
        if kind == "header":
            put(f"<div>{words(1, 4)}</div>")
        if kind in ("footer", "side", "ad", "notice"):
            inner = words(3, 40)
            put(inner if rng.random() < 0.5 else f"<p>{inner}</p>")
        if kind == "comments":
            for _ in range(rng.randint(1, 6)):
                put(f'<div class="comment"><p>{words(5, 60)}</p></div>' if rng.random() < 0.7 else f"<p>{words(5, 60)}</p>")
        put(f"</{tag}>")

    put("<html><head><title>x</title></head><body>")
    for kind in ("header", "nav", "notice", "ad"):
        if rng.random() < 0.6:
            away(kind)
    wrap = rng.choice(["article", "article", "main", "div", "section", "div"])
    mark = "" if wrap in ("article", "main") and rng.random() < 0.6 else f' class="{rng.choice(["content", "post", "entry-content", "article-body", "main", "story", "text"])}"'
    if rng.random() < 0.1:
        mark = ""
    outer = rng.random() < 0.4
    if outer:
        put(f'<div{rng.choice(["", " class=wrapper", " id=page", " class=container"])}>')
    put(f"<{wrap}{mark}>")
    if rng.random() < 0.8:
        title = f"<h1>{words(2, 12)}</h1>"
        put(f"<header>{title}</header>" if rng.random() < 0.2 else title, True)
    for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 14])):
        kind = rng.random()
        if kind < 0.68:
            bold = rng.random() < 0.25
            put(f"<p>{'<b>' if bold else ''}{words(*rng.choice([(1, 5), (5, 40), (30, 140)]))}{'<br>' if bold else '</p>'}", True)
        elif kind < 0.74:
            put(f"<h2>{words(1, 8)}</h2>", True)
        elif kind < 0.80:
            put("<ul>" + "".join(f"<li>{words(2, 25)}</li>" for _ in range(rng.randint(2, 6))) + "</ul>", True)
        elif kind < 0.84:
            put(f"<blockquote><p>{words(5, 50)}</p></blockquote>", True)
        elif kind < 0.88:
            put("<table>" + "".join(f"<tr><td>{words(1, 6)}</td><td>{words(1, 6)}</td></tr>" for _ in range(rng.randint(2, 5))) + "</table>", True)
        elif kind < 0.91:
            put(f"<p>{words(3, 20)} <a href='/x'>{words(1, 4)}</a> {words(3, 20)}</p>", True)
        elif kind < 0.94:
            put(f"<div>{words(10, 80)}</div>", True)
        else:
            away(rng.choice(["ad", "share", "related", "side"]))
    put(f"</{wrap}>")
    for kind in ("comments", "related", "share", "side", "ad"):
        if rng.random() < 0.3:
            away(kind)
    if outer:
        put("</div>")
    if rng.random() < 0.7:
        away("footer")
    if rng.random() < 0.15:
        away("notice")
    put("</body></html>")
    return "".join(p for p, _ in pieces), pieces


def _labelled(rng: random.Random) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of one training page that hold text."""
    whole, pieces = training_page(rng)
    # The same page with a mark in front of each word of the article, to label its runs.
    marked = "".join(re.sub(r"(?<=>)(?=[^<\s])", "\u0001", p) if g else p for p, g in pieces)
    plain, labelled = Page(whole), Page(marked)
    n = len(plain.tags)
    yes, no = [0] * n, [0] * n
    for text, owner in zip(labelled.texts, labelled.owners):
        if "\u0001" in text:
            yes[owner] += len(text)
        else:
            no[owner] += len(text)
    for i in range(n - 1, 0, -1):
        yes[plain.parents[i]] += yes[i]
        no[plain.parents[i]] += no[i]
    held = np.array([bool(a) != bool(b) for a, b in zip(yes, no)])
    return block_features(plain)[held], (np.array(yes) > 0)[held].astype(float)


@cache
def default_trees(pages: int = 900, seed: int = 3) -> Trees:
    rng = random.Random(seed)
    rows = [_labelled(rng) for _ in range(pages)]
    return Trees().fit(np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows]))


def decode(page: Page, margin: np.ndarray, price: float = 1.0) -> list[bool]:
    """Which runs of text are article: the best cut of the tree into kept and dropped subtrees."""
    n = len(page.tags)
    log_yes = -np.logaddexp(0, -margin)
    log_no = -np.logaddexp(0, margin)
    texts = [0] * n
    for owner in page.owners:
        texts[owner] += 1
    yes, no, mixed = [0.0] * n, [0.0] * n, [0.0] * n
    under = [0.0] * n
    held = [bool(t) for t in texts]
    choice = [""] * n
    for i in range(n - 1, -1, -1):
        if held[i]:
            # Containers speak as well, but their text decides.
            weight = 1.0 if texts[i] else 0.3
            yes[i] += weight * float(log_yes[i])
            no[i] += weight * float(log_no[i])
            mixed[i] = under[i] - price + (weight * max(float(log_yes[i]), float(log_no[i])) if texts[i] else 0.0)
            best = max(yes[i], no[i], mixed[i])
            choice[i] = "y" if best == yes[i] else "n" if best == no[i] else "m"
            p = page.parents[i]
            if p >= 0:
                held[p] = True
                yes[p] += yes[i]
                no[p] += no[i]
                under[p] += best
    kept = [False] * n
    final = [""] * n
    for i in range(n):
        p = page.parents[i]
        final[i] = choice[i] if p < 0 or final[p] == "m" else final[p]
        kept[i] = final[i] == "y" or (final[i] == "m" and bool(log_yes[i] > log_no[i]))
    return [kept[owner] for owner in page.owners]


def extract_pages(
    pages: DataFrame, *, source: str = "html", column: str = "text", trees: Trees | None = None
) -> DataFrame:
    """``pages`` with the main text of ``source`` in ``column``. A column of that name is replaced."""
    pages = pages.drop(column) if column != source else pages
    schema = T.StructType([*pages.schema.fields, T.StructField(column, T.StringType())])
    model = pages.sparkSession.sparkContext.broadcast(trees or default_trees())

    def texts(sources: list[str | None]) -> list[str]:
        read = [Page(s or "") for s in sources]
        rows = [block_features(p) for p in read]
        margins = model.value.margin(np.concatenate(rows))
        out, at = [], 0
        for page, block in zip(read, rows):
            keep = decode(page, margins[at : at + len(block)]) if page.texts else []
            at += len(block)
            out.append("\n".join(t for t, k in zip(page.texts, keep) if k))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources = batch.column(source).to_pylist()
            out: list[str] = []
            for low in range(0, len(sources), 256):
                out += texts(sources[low : low + 256])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.string())], names=[*batch.schema.names, column]
            )

    return pages.mapInArrow(run, schema)
