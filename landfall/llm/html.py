"""Main-text extraction: gradient-boosted trees over DOM-node features, decoded along the tree.

Every block element gets the chance that it holds main text. A dropped element drops all below it;
the best consistent labelling is found bottom-up, so an element is never kept inside a dropped one.
"""

import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.llm.common import unit_hash

#: Documented bounds of the training data.
SAMPLE_PAGES = 150
DRILLS = 600
TREES, DEPTH, BINS, RATE = 40, 4, 24, 0.3

#: Elements whose content is no markup; an open one of these runs to the end of the page.
TEXT_ONLY = frozenset("script style textarea title iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg select".split())
BLOCK = frozenset(
    "html body div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption section "
    "article header footer nav aside main figure figcaption blockquote pre form fieldset address details "
    "summary hgroup center head dialog menu button".split())
#: Elements that end an open element of the first kind when they begin.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tr", "td", "th", "thead"}}
SCOPES = frozenset("ul ol dl table div section article body main aside td th blockquote form".split())
#: A quote opens a value only after an equals sign, and the value is read whole. Any other quote, and
#: one that is never closed, is a plain mark: at most one quote of each kind is sought in vain.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)"
    r"((?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+|[\"'])*+)>?", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)

#: Groups of attribute tokens; a token belongs to a group if a word of it is listed.
GROUPS = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs tabs toc pagination pager topnav links skip",
    "ad": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner "
          "dfp adsense adslot adbox commercial",
    "foot": "foot footer colophon copyright legal imprint contentinfo bottom",
    "head": "header head masthead topbar top brand logo siteheader hero title tagline",
    "side": "side sidebar aside widget widgets related recommended recommendations trending rail complementary "
            "secondary more popular",
    "talk": "comment comments commentlist reply replies disqus discussion respond feedback thread",
    "notice": "cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe "
              "subscription signup paywall dialog privacy warning toast",
    "form": "form search searchbox login register input contact",
    "share": "share sharing social follow tweet facebook buttons toolbar tools tags meta byline author",
    "text": "article content main post entry story text articlebody postcontent body prose page blog news copy",
}
_GROUP_OF = {w: i for i, words in enumerate(GROUPS.values()) for w in words.split()}
TAGS = {t: i for i, t in enumerate(
    "div p section article main header footer nav aside form ul ol li table td blockquote pre figure "
    "figcaption h1 h2 h3 button dl address details".split())}
N_TAGS, N_GROUPS = len(TAGS) + 1, len(GROUPS)


def _mask(attributes):
    bits = 0
    for m in _NAMES.finditer(attributes):
        value = re.sub(r"([a-z])([A-Z])", r"\1 \2", m[1] or m[2] or m[3] or "")
        for word in re.split(r"[^a-z]+", value.lower()):
            if word in _GROUP_OF:
                bits |= 1 << _GROUP_OF[word]
    return bits


class _Masks(dict):
    def __missing__(self, attributes):
        if len(self) > 100_000:
            self.clear()
        value = _mask(attributes) if "=" in attributes else 0
        if len(attributes) <= 1_000:
            self[attributes] = value
        return value


class Page:
    """Block elements in page order: tag, mask, parent, depth, links' text, and blocks of text.

    ``blocks``: (element, text) in page order, characters decoded and white space reduced.
    """

    def __init__(self, source, masks):
        self.tags, self.masks, self.parents, self.depths = ["html"], [0], [-1], [0]
        self.linked, self.blocks = [0], []
        self._open, self._text, self._anchor = [("html", 0)], [], 0
        self._places = {tag: [-1] for tag in BLOCK}  # of open elements of each tag, the root left out
        endless = set()
        at, size = 0, len(source)
        while at < size:
            m = _TOKEN.search(source, at)
            if not m:
                self._add(source[at:])
                break
            if m.start() > at:
                self._add(source[at:m.start()])
            at = m.end()
            if not m[2]:
                continue
            tag = m[2].lower()
            if m[1]:
                self._close(tag)
                continue
            self._start(tag, m[3], masks)
            # A slash at the end closes only foreign elements.
            if tag in RAW and tag not in endless and not (tag == "svg" and m[3].endswith("/")):
                end = re.compile(f"</{re.escape(tag)}(?![a-z0-9-])[^>]*>?", re.I).search(source, at)
                if end:
                    at = end.end()
                elif tag in TEXT_ONLY:
                    at = size
                else:
                    endless.add(tag)  # never closed from here on: what follows is page text
        self._flush()

    def _add(self, text):
        if "&" in text:
            text = entities.unescape(text)
        self._text.append(text)
        if self._anchor:
            self.linked[self._open[-1][1]] += len(text.strip())

    def _flush(self):
        if self._text:
            text = " ".join("".join(self._text).split())
            self._text = []
            if text:
                self.blocks.append((self._open[-1][1], text))

    def _start(self, tag, attributes, masks):
        if tag in RAW or tag in VOID:
            if tag == "br":
                self._text.append(" ")
            elif tag == "hr":
                self._flush()
            return
        if tag not in BLOCK:
            self._anchor += tag == "a"
            return
        self._flush()
        self._anchor = 0
        if tag != "html":
            self._end_implied({"p"}, SCOPES - {"blockquote"})
            if tag in CLOSES:
                self._end_implied(CLOSES[tag], SCOPES - CLOSES[tag])
        parent = self._open[-1][1]
        self.tags.append(tag)
        self.masks.append(masks[attributes])
        self.parents.append(parent)
        self.depths.append(self.depths[parent] + 1)
        self.linked.append(0)
        self._places[tag].append(len(self._open))
        self._open.append((tag, len(self.tags) - 1))

    def _last(self, tags):
        """Where the last open element of ``tags`` stands; -1 for none."""
        return max(self._places[t][-1] for t in tags)

    def _end(self, at):
        while len(self._open) > at:
            self._places[self._open.pop()[0]].pop()

    def _end_implied(self, names, stop):
        least = self._last(stop)
        while self._last(names) > least:
            self._end(self._last(names))

    def _close(self, tag):
        if tag == "a":
            self._anchor = max(0, self._anchor - 1)
        if tag not in BLOCK:
            return
        self._flush()
        self._anchor = 0
        at = self._places[tag][-1]
        if at >= 0 and not (tag == "p" and self._last(SCOPES) > at):
            self._end(at)


class _DrillPage(Page):
    """A generated page, whose elements carry the mark that ``drill`` gave them."""

    def __init__(self, source, masks):
        self.marks = [None]
        super().__init__(source, masks)

    def _start(self, tag, attributes, masks):
        before = len(self.tags)
        super()._start(tag, attributes, masks)
        if len(self.tags) > before:
            mark = re.search("data-keep=([01])", attributes)
            self.marks.append(mark and mark[1])


def features(page):
    """A row per element: tag, attribute groups of it and above it, subtree sums, place, siblings."""
    n = len(page.tags)
    parents = np.array(page.parents)
    text = np.zeros(n)
    blocks = np.zeros(n)
    stops = np.zeros(n)
    for e, t in page.blocks:
        text[e] += len(t)
        blocks[e] += 1
        stops[e] += t.count(".") + t.count(",")
    own = text.copy()
    linked = np.array(page.linked, float)
    below = np.ones(n)
    paragraphs = np.array([t == "p" for t in page.tags], float)
    above_tags, above_masks = [0] * n, [0] * n
    tag_ids = [TAGS.get(t, N_TAGS - 1) for t in page.tags]
    rank, siblings = np.zeros(n), np.zeros(n)
    children = [0] * n
    for e in range(1, n):
        p = page.parents[e]
        above_tags[e] = above_tags[p] | 1 << tag_ids[p]
        above_masks[e] = above_masks[p] | page.masks[p]
        rank[e] = children[p]
        children[p] += 1
    sums = np.stack([text, linked, blocks, stops, paragraphs, below], axis=1)
    for e in range(n - 1, 0, -1):
        sums[page.parents[e]] += sums[e]
    text, linked, blocks, stops, paragraphs, below = sums.T
    siblings[1:] = np.array(children)[parents[1:]]
    total = max(text[0], 1.0)
    before = np.concatenate([[0], np.cumsum(own)[:-1]])
    up = np.where(parents >= 0, parents, 0)

    def bits(values, size):
        values = np.array(values, dtype=np.int64)
        return (values[:, None] >> np.arange(size)) & 1

    numbers = np.stack([
        np.log1p(text), linked / np.maximum(text, 1), text / below, text / np.maximum(blocks, 1),
        stops / np.maximum(text, 1) * 100, np.log1p(paragraphs), text / total, before / total,
        np.minimum(page.depths, 30), rank, siblings, (text[up] - text) / np.maximum(siblings - 1, 1),
        np.log1p(own)], axis=1)
    marks = bits([1 << t for t in tag_ids], N_TAGS)
    return np.hstack([numbers, marks, bits(page.masks, N_GROUPS), bits(above_tags, N_TAGS),
                      bits(above_masks, N_GROUPS)]).astype(np.float32)


class Boosting:
    """Logistic gradient boosting of binned regression trees of fixed depth."""

    def __init__(self):
        self.start, self.trees, self.edges = 0.0, [], []

    def fit(self, x, y):
        self.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(self.edges)], axis=1)
        rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(rate / (1 - rate)))
        z = np.full(len(y), self.start)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-z))
            tree, at = self._grow(binned, y - p, p * (1 - p))
            self.trees.append(tree)
            z += tree[2][at]
        return self

    def _grow(self, binned, g, h):
        """Nodes in heap order: feature (-1 for none), threshold, value."""
        size = 2 ** (DEPTH + 1) - 1
        feature, cut, value = np.full(size, -1), np.zeros(size), np.zeros(size)
        at = np.zeros(len(g), int)
        for node in range(size):
            rows = np.flatnonzero(at == node)
            if not len(rows):
                continue
            gs, hs = g[rows].sum(), h[rows].sum()
            value[node] = RATE * gs / (hs + 1.0)
            if 2 * node + 2 >= size or len(rows) < 20:
                continue
            best = (1e-3, None, None)
            for f in range(binned.shape[1]):
                width = len(self.edges[f]) + 1
                if width < 2:
                    continue
                b = binned[rows, f]
                gl = np.cumsum(np.bincount(b, g[rows], width))[:-1]
                hl = np.cumsum(np.bincount(b, h[rows], width))[:-1]
                gain = gl ** 2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs ** 2 / (hs + 1)
                i = int(np.argmax(gain))
                if gain[i] > best[0]:
                    best = (gain[i], f, i)
            if best[1] is not None:
                feature[node], cut[node] = best[1], self.edges[best[1]][best[2]]
                right = binned[rows, best[1]] > best[2]
                at[rows] = 2 * node + 1 + right
        return (feature, cut, value), at

    def predict(self, x):
        z = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            at = np.zeros(len(x), int)
            for _ in range(DEPTH):
                f = feature[at]
                inner = f >= 0
                at = np.where(inner, 2 * at + 1 + (x[rows, np.maximum(f, 0)] > cut[at]), at)
            z += value[at]
        return z


def decode(page, z):
    """Kept elements: the labelling with the highest likelihood in which no kept element has a
    dropped ancestor. The root is kept."""
    n = len(page.tags)
    keep = -np.logaddexp(0, -z)
    drop = -np.logaddexp(0, z)
    kept, dropped = keep.copy(), drop.copy()
    for e in range(n - 1, 0, -1):
        p = page.parents[e]
        dropped[p] += dropped[e]
        kept[p] += max(kept[e], dropped[e])
    out = [True] * n
    for e in range(1, n):
        out[e] = out[page.parents[e]] and kept[e] >= dropped[e]
    return out


#: Elements and groups that the weak labels of sampled pages go by.
_MAIN_TAGS = frozenset(("article", "main"))
_LEFT_OUT = frozenset("nav footer aside form button".split())
_LEFT_GROUPS = sum(1 << i for i, g in enumerate(GROUPS) if g in ("menu", "ad", "foot", "side", "talk", "notice", "form"))


def weak_labels(page):
    """1 for elements with main text below them, by their page's own semantic elements."""
    n = len(page.tags)
    inside, out = [False] * n, [False] * n
    for e in range(1, n):
        p = page.parents[e]
        inside[e] = inside[p] or page.tags[e] in _MAIN_TAGS
        out[e] = out[p] or page.tags[e] in _LEFT_OUT or bool(page.masks[e] & _LEFT_GROUPS)
    good = [i and not o for i, o in zip(inside, out)]
    return _upwards(page, good)


def _upwards(page, good):
    y = np.zeros(len(page.tags))
    for e, _ in page.blocks:
        y[e] = max(y[e], float(good[e]))
    for e in range(len(y) - 1, 0, -1):
        y[page.parents[e]] = max(y[page.parents[e]], y[e])
    return y


def _marked_labels(page):
    good = [False] * len(page.tags)
    for e in range(1, len(good)):
        mark = page.marks[e]
        good[e] = mark == '1' if mark is not None else good[page.parents[e]]
    return _upwards(page, good)


def drill(rng, passages):
    """A page of random layout whose elements are marked by whether they hold main text."""
    def text(low, high):
        words = passages[rng.integers(len(passages))].split() or ["text"]
        n = int(rng.integers(low, high))
        at = int(rng.integers(max(1, len(words) - n)))
        return entities.escape(" ".join(words[at:at + n]))

    def pick(*options):
        return options[rng.integers(len(options))]

    def box(tag, names, body, keep):
        name = pick(*names.split()) if names else ""
        attribute = f' {pick("class", "class", "id")}="{name}"' if name else ""
        return f"<{tag}{attribute} data-keep={keep}>{body}</{tag}>"

    def links(n):
        return "".join(f'<li><a href="/x">{text(1, 4)}</a></li>' for _ in range(n))

    def menu():
        items = f"<ul>{links(rng.integers(3, 9))}</ul>"
        return box(*pick(("nav", ""), ("div", "menu navbar nav main-menu breadcrumbs"), ("nav", "top-nav")), items, 0)

    def advert():
        return box(pick("div", "div", "aside", "section"), "ad ads advert ad-slot sponsored promo banner-ad",
                   f"<p>{text(3, 40)}</p>" if rng.random() < 0.5 else text(3, 40), 0)

    def side():
        return box(*pick(("aside", ""), ("aside", "sidebar"), ("div", "sidebar related widget side-bar trending")),
                   f"<h3>{text(1, 4)}</h3>" + pick(f"<ul>{links(4)}</ul>", f"<p>{text(5, 40)}</p>"), 0)

    def notice():
        return box(pick("div", "section", "div"), "cookie-notice cookie-banner consent newsletter popup notice "
                   "subscribe-box alert", f"<p>{text(5, 40)}</p>" + pick("", "<button>OK</button>"), 0)

    def form():
        inner = f"<label>{text(1, 4)}</label><input name=q><button>{text(1, 2)}</button>"
        return pick(f"<form data-keep=0>{inner}</form>", box("div", "search login contact-form", f"<form>{inner}</form>", 0))

    def talk():
        said = "".join(box(pick("div", "li", "article"), "comment comment-body reply", f"<p>{text(5, 60)}</p>", 0)
                       for _ in range(rng.integers(1, 6)))
        return box(pick("section", "div", "div", "ol"), "comments comment-list replies discussion disqus_thread", said, 0)

    def article():
        tiny = rng.random() < 0.35
        parts = [f"<h1>{text(1, 10)}</h1>"] if rng.random() < 0.9 else []
        for _ in range(rng.integers(1, 3) if tiny else 0):
            parts.append(f"<p>{text(1, 8)}</p>")
        for _ in range(0 if tiny else rng.integers(1, 12)):
            parts.append(pick(*[f"<p>{text(3, 120)}</p>"] * 8, f"<h2>{text(2, 8)}</h2>",
                              f"<ul>{''.join(f'<li>{text(3, 20)}</li>' for _ in range(3))}</ul>",
                              f"<blockquote>{text(5, 40)}</blockquote>", f"<pre>{text(3, 30)}</pre>",
                              f"<figure><img src=a><figcaption>{text(3, 12)}</figcaption></figure>",
                              f"<table><tr><td>{text(1, 5)}</td><td>{text(1, 5)}</td></tr></table>",
                              f"<div>{text(10, 80)}</div>"))
        for _ in range(rng.integers(0, 3)):
            parts.insert(rng.integers(1, len(parts) + 1), pick(advert, side, notice, form, menu)())
        if rng.random() < 0.2:
            parts.append(talk())
        tag, names = pick(("article", ""), ("article", "post entry story"), ("main", ""),
                          ("div", "content article-body post-content entry-content story main text"), ("section", "post article"))
        inner = box(tag, names, "".join(parts), 1)
        return pick(inner, inner, f"<main data-keep=1>{inner}</main>", f'<div class="{pick("wrap", "row", "col")}">{inner}</div>')

    top = pick("header", "div", "header")
    parts = [box(top, "" if top == "header" else "header masthead top-bar site-header",
                 f"<p>{text(1, 6)}</p>" + pick("", menu()), 0)] if rng.random() < 0.6 else []
    for maker, chance in ((menu, 0.7), (advert, 0.5), (notice, 0.3), (form, 0.25)):
        if rng.random() < chance:
            parts.append(maker())
    after = [maker() for maker, chance in ((side, 0.4), (advert, 0.3), (talk, 0.4), (notice, 0.2), (form, 0.2)) if rng.random() < chance]
    foot = pick(("footer", ""), ("div", "footer site-footer copyright"))
    tail = [box(*foot, pick(text(3, 20), f"<p>&copy; {text(3, 20)}</p>"), 0)] if rng.random() < 0.8 else []
    body = "".join([*parts, article(), *after, *tail])
    return f"<html><head><title>x</title></head><body>{body}</body></html>"


def fit(pages, sample_pages=SAMPLE_PAGES, drills=DRILLS):
    """Trees fitted on an expected ``sample_pages`` pages, labelled by their semantic elements, and
    on ``drills`` pages of random layout filled with their passages. Pages are chosen by a hash of
    page_id and html, at most four times as many, and read whole; those longer than 200,000 characters
    teach nothing."""
    some = pages.where(F.length("html").between(1, 200_000)).select("page_id", "html")
    n = some.count()
    rate = min(1.0, sample_pages / n) if n else 0.0
    chosen = some.where(unit_hash("page_id", "html", F.lit(2)) < rate)
    order = F.xxhash64("page_id", "html", F.lit(2))
    sample = sorted(r["html"] for r in chosen.orderBy(order, "html").limit(4 * sample_pages).collect())
    masks, x, y, passages = _Masks(), [], [], ["Some plain words stand here."]
    for source in sample:
        page = Page(source, masks)
        labels = weak_labels(page)
        passages += [t for _, t in page.blocks if len(t) > 60]
        if labels.any():
            x.append(features(page))
            y.append(labels)
    rng = np.random.default_rng(4)
    for _ in range(drills):
        page = _DrillPage(drill(rng, passages), masks)
        x.append(features(page))
        y.append(_marked_labels(page))
    return Boosting().fit(np.vstack(x), np.concatenate(y))


def main_texts(sources, trees, masks):
    """The main text of each page, blocks joined by an empty line."""
    pages = [Page(s or "", masks) for s in sources]
    z = trees.predict(np.vstack([features(p) for p in pages])) if pages else []
    out, at = [], 0
    for page in pages:
        n = len(page.tags)
        keep = decode(page, z[at:at + n])
        out.append("\n\n".join(t for e, t in page.blocks if keep[e]))
        at += n
    return out


def extract(spark, pages, sample_pages=SAMPLE_PAGES, drills=DRILLS):
    """page_id, url, text and n_chars for every row of ``pages``, from the whole html.

    NULL and empty html, and pages without main text, have an empty text. Repeated rows give equal
    rows; NULL page_id and url stay; other columns play no part.
    """
    trees = spark.sparkContext.broadcast(fit(pages, sample_pages, drills))

    def run(batches):
        masks = _Masks()
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = main_texts(part.column("html").to_pylist(), trees.value, masks)
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select("page_id", "url", "html")
    schema = T.StructType([rows.schema["page_id"], rows.schema["url"], T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])
    return rows.mapInArrow(run, schema)
