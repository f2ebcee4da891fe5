"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree of its block elements; inline elements belong to the
block they are in.  Every block is content or not.  Its potential comes from
its tag, the words of its class, id and role, and its text (length, share of
links, punctuation); parent-child potentials, by kind of child, say how labels
continue down the tree.  Sum-product messages go up to the root and down again
(exact on a tree), which gives each block's marginal; blocks over one half make
the text, in page order.

The weights are trained by maximum likelihood on labelled pages: annotated
layouts (:mod:`.labelled_pages`) and a bounded sample of the table's pages whose
article element is unambiguous.  A batch of pages is one forest, whose messages
are passed level by level in numpy.  Pages are independent rows: no shuffle.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import labelled_pages
from .common import bounded_sample, read_table

SAMPLE, SAMPLE_CHARS = 300, 60_000
#: Nodes of a forest whose messages are passed together.
FOREST = 20_000
STEPS, RATE, RIDGE = 300, 0.5, 1e-4

#: Element names of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page: scripts, styles, form controls, the title.
RAW = set("script style title textarea template select button".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark meter output picture progress q "
             "rp rt ruby s samp small span strike strong sub sup time tt u var wbr nobr "
          # embedded content: its text belongs to the block around it
          "object video audio canvas noscript iframe noframes svg g path text tspan math mi mn mo ms mtext mrow msup msub msubsup mfrac "
          "msqrt mroot mover munder munderover mstyle mspace mfenced mtable mtr mtd semantics annotation".split())
TAGS = ("#root html head body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tr td th blockquote pre "
        "figure figcaption header footer nav aside form fieldset address details summary center dialog menu").split()
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "thead": {"thead", "tbody", "tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
#: Where the search for an element to close ends.
SCOPE = {"ul", "ol", "dl", "table", "#root", "menu"}
#: Words in class, id and role attributes, by what they say.
WORDS = {
    "ad": "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion dfp adsense",
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc tabs toolbar skip",
    "head": "header masthead topbar banner logo branding hero",
    "foot": "footer colophon copyright legal bottom contentinfo",
    "side": "sidebar aside rail widget widgets secondary complementary",
    "notice": "notice notices cookie cookies consent gdpr alert popup modal overlay toast disclaimer warning paywall",
    "comment": "comment comments commentlist reply replies respond disqus discussion reader",
    "form": "form search login signup subscribe subscription newsletter register contact feedback",
    "share": "share sharing social follow facebook twitter tags tag",
    "related": "related recommended recommendations more popular trending latest teaser teasers read",
    "meta": "meta byline author date time posted info category categories caption",
    "content": "article content entry post story main text body copy maincontent page",
    "hidden": "hidden invisible print sr screen offscreen",
}
_WORD_GROUP = {w: g for g, ws in WORDS.items() for w in ws.split()}

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role|itemprop|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""display\s*:\s*none|visibility\s*:\s*hidden|\baria-hidden\s*=\s*["']?true|\shidden(?=[\s=/>]|$)""", re.I)
_SPLIT = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Numbers of features, by name.
_NAMED = ["bias", "leaf", "hidden", "sentence", "copyright", *(f"tag:{t}" for t in [*TAGS, "other"]), *(f"name:{g}" for g in WORDS),
          *(f"words:{k}" for k in range(7)), *(f"links:{k}" for k in range(4)), *(f"all words:{k}" for k in range(7)),
          *(f"all links:{k}" for k in range(4)), "paragraphs", "near root"]
NUMBER = {n: i for i, n in enumerate(_NAMED)}
_TAG_NUMBER = {t: NUMBER[f"tag:{t}"] for t in TAGS}
#: Parent-child potentials differ by kind of child.
CHILD_KINDS = ["text", "heading", "list", "named", "container"]


class Page:
    """The tree of a page's blocks: parents come before their children."""

    def __init__(self, source: str):
        self.tag, self.parent, self.attrs = ["#root"], [-1], [""]
        self.words, self.link_words, self.sentence, self.copyright = [0], [0], [False], [False]
        self.texts: list[tuple[int, str]] = []  # (block, text) in page order
        self._read(source)

    def _read(self, source: str) -> None:
        stack, run, links, in_link = [0], [], 0, False
        opened: Counter = Counter()  # open blocks by tag, so that an end tag of none isn't searched for
        endless: set[str] = set()  # elements that have no end from here on

        def flush():
            nonlocal run, links
            if run:
                text = " ".join(entities.unescape("".join(run)).split())
                if text:
                    k = stack[-1]
                    self.texts.append((k, text))
                    self.words[k] += text.count(" ") + 1
                    self.link_words[k] += links
                    self.sentence[k] |= text[-1] in ".!?:\"'»”" or ". " in text
                    self.copyright[k] |= "©" in text or "All rights reserved" in text
            run, links = [], 0

        def close(to: int):
            nonlocal in_link
            flush()
            opened.subtract(self.tag[k] for k in stack[to:])
            del stack[to:]
            in_link = False

        at, skip_to = 0, 0
        for m in _TOKEN.finditer(source):
            if m.start() < skip_to:
                continue
            if m.start() > at:
                text = source[at:m.start()]
                run.append(text)
                if in_link:
                    links += len(text.split())
            at = m.end()
            name = m["tag"] or m["tag2"]
            if name is None:
                continue
            name = name.lower()
            if m["end"] or m["end2"]:
                if name == "a":
                    in_link = False
                elif opened[name] > 0:
                    for d in range(len(stack) - 1, 0, -1):
                        if self.tag[stack[d]] == name:
                            close(d)
                            break
                elif name == "br":
                    run.append(" ")
                continue
            attrs = m["attrs"] if m["tag"] else m["attrs2"]
            if name in RAW:
                end = None
                if name not in endless and (not attrs.endswith("/") or name in ("script", "style")):
                    end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(source, at)
                    if not end:
                        endless.add(name)
                if end:
                    at = skip_to = end.end()
                elif name in ("script", "style", "title", "textarea"):
                    at = skip_to = len(source)
                continue
            if name in INLINE:
                if name == "a":
                    in_link = True
                elif name in ("br", "img", "input"):
                    run.append(" ")
                continue
            if name in VOID:
                if name == "hr":
                    flush()
                continue
            # a block: ends an open paragraph, and siblings that it closes
            for d in range(len(stack) - 1, 0, -1):
                t = self.tag[stack[d]]
                if t == "p":
                    close(d)
                    break
                if t in SCOPE or t not in ("h1", "h2", "h3", "h4", "h5", "h6"):
                    break
            if name in CLOSES:
                for d in range(len(stack) - 1, 0, -1) if any(opened[t] > 0 for t in CLOSES[name]) else ():
                    if self.tag[stack[d]] in CLOSES[name]:
                        close(d)
                        if name in ("li", "dt", "dd", "td", "th"):
                            break
                    elif self.tag[stack[d]] in SCOPE:
                        break
            elif name == "body" and opened["body"] > 0:
                continue
            flush()
            in_link = False
            self.tag.append(name)
            opened[name] += 1
            self.parent.append(stack[-1])
            self.attrs.append(attrs)
            self.words.append(0)
            self.link_words.append(0)
            self.sentence.append(False)
            self.copyright.append(False)
            stack.append(len(self.tag) - 1)
        if at < len(source) and skip_to < len(source):
            run.append(source[at:])
        flush()

    def features(self) -> list[list[int]]:
        """Numbers of the features that hold, for each block."""
        n = len(self.tag)
        words, links, paragraphs, leaf = self.words[:], self.link_words[:], [0] * n, [True] * n
        for k in range(n - 1, 0, -1):
            p = self.parent[k]
            words[p] += words[k]
            links[p] += links[k]
            leaf[p] = False
            if self.tag[k] == "p":
                paragraphs[p] += 1
        out = []
        for k, tag in enumerate(self.tag):
            on = [0, _TAG_NUMBER.get(tag, _OTHER), _WORDS_AT + _size(self.words[k]), _ALL_WORDS_AT + _size(words[k])]
            if self.words[k]:
                on.append(_LINKS_AT + _share(self.link_words[k], self.words[k]))
            if words[k]:
                on.append(_ALL_LINKS_AT + _share(links[k], words[k]))
            if leaf[k]:
                on.append(1)
            if self.sentence[k]:
                on.append(3)
            if self.copyright[k]:
                on.append(4)
            if paragraphs[k] >= 3:
                on.append(NUMBER["paragraphs"])
            if self.parent[k] <= 0:
                on.append(NUMBER["near root"])
            attrs = self.attrs[k]
            if attrs:
                groups = names_in(attrs)
                on += [NUMBER[f"name:{g}"] for g in groups]
                if _HIDDEN.search(attrs):
                    on.append(2)
            out.append(on)
        return out

    def kinds(self) -> list[int]:
        """Kind of child, for the parent-child potentials."""
        return [0 if t in ("p", "blockquote", "pre", "td", "figcaption", "dd") else 1 if t[0] == "h" and len(t) == 2 and t[1].isdigit()
                else 2 if t in ("ul", "ol", "li", "dl", "dt", "table", "tr", "tbody", "thead", "th", "figure")
                else 3 if t in ("nav", "aside", "footer", "header", "form", "address", "menu", "dialog") or names_in(a) else 4
                for t, a in zip(self.tag, self.attrs, strict=True)]


_OTHER, _WORDS_AT, _LINKS_AT = NUMBER["tag:other"], NUMBER["words:0"], NUMBER["links:0"]
_ALL_WORDS_AT, _ALL_LINKS_AT = NUMBER["all words:0"], NUMBER["all links:0"]
_SIZES = [1, 4, 10, 20, 50, 200]


def _size(n: int) -> int:
    return sum(n >= s for s in _SIZES)


def _share(part: int, whole: int) -> int:
    x = part / whole
    return 0 if x == 0 else 1 if x < 0.3 else 2 if x < 0.8 else 3


_NAME_MEMO: dict[str, frozenset] = {}


def names_in(attrs: str) -> frozenset:
    """Groups of the words in an element's class, id, role and label."""
    got = _NAME_MEMO.get(attrs)
    if got is None:
        got = frozenset(_WORD_GROUP[w] for m in _NAMES.finditer(attrs) for w in map(str.lower, _SPLIT.findall(m.group(1))) if w in _WORD_GROUP)
        if len(_NAME_MEMO) < 50_000 and len(attrs) < 200:
            _NAME_MEMO[attrs] = got
    return got


class Forest:
    """The trees of several pages, ready for messages."""

    def __init__(self, pages: list[Page]):
        first = np.concatenate([[0], np.cumsum([len(p.tag) for p in pages])]).astype(int)
        self.first, n = first, int(first[-1])
        self.parent = np.concatenate([np.where(np.array(p.parent) < 0, -1, np.array(p.parent) + f) for p, f in zip(pages, first, strict=False)]) if n else np.empty(0, int)
        self.kind = np.concatenate([p.kinds() for p in pages]).astype(int) if n else np.empty(0, int)
        flat = [f for p in pages for f in p.features()]
        self.row = np.repeat(np.arange(n), [len(f) for f in flat]) if n else np.empty(0, int)
        self.feature = np.array([x for f in flat for x in f], int)
        depth = np.zeros(n, int)
        for k, p in enumerate(self.parent.tolist()):  # parents come first
            if p >= 0:
                depth[k] = depth[p] + 1
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.cumsum(np.bincount(depth)))[:-1] if n else []


class Model:
    """Weights: a score per feature for "content", and log potentials [kind, parent, child]."""

    def __init__(self):
        self.unary = np.zeros(len(_NAMED))
        self.pair = np.tile(np.array([[0.5, -0.5], [-0.5, 0.5]]), (len(CHILD_KINDS), 1, 1))

    def marginals(self, f: Forest) -> tuple[np.ndarray, np.ndarray]:
        """P(content) of every node, and the joint [parent, child] of every edge (zero for roots)."""
        n = len(f.parent)
        own = np.zeros((n, 2))
        own[:, 1] = np.bincount(f.row, self.unary[f.feature], n) if n else 0
        up = np.zeros((n, 2))  # to the parent, over the parent's label
        held = own.copy()  # own potential and messages from the children
        for level in reversed(f.levels[1:]):
            m = _logsum(held[level][:, None, :] + self.pair[f.kind[level]], 2)
            up[level] = m - m.max(axis=1, keepdims=True)
            np.add.at(held, f.parent[level], up[level])
        down = np.zeros((n, 2))
        joint = np.zeros((n, 2, 2))
        for level in f.levels[1:]:
            p = f.parent[level]
            rest = held[p] + down[p] - up[level]  # the parent without this child
            both = rest[:, :, None] + self.pair[f.kind[level]]
            m = _logsum(both, 1)
            down[level] = m - m.max(axis=1, keepdims=True)
            z = both + held[level][:, None, :]
            z = np.exp(z - z.max(axis=(1, 2), keepdims=True))
            joint[level] = z / z.sum(axis=(1, 2), keepdims=True)
        belief = held + down
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500))), joint

    def train(self, f: Forest, label: np.ndarray, weight: np.ndarray) -> None:
        """Maximum likelihood: observed minus expected features, with a ridge and momentum.

        weight: of each node's page, so that long pages don't prevail."""
        child = np.flatnonzero(f.parent >= 0)
        seen = np.zeros((len(label), 2, 2))
        seen[child, label[f.parent[child]], label[child]] = 1
        scale = 100.0 / weight.sum()
        prior = self.pair.copy()
        speed_u, speed_p = np.zeros_like(self.unary), np.zeros_like(self.pair)
        for _ in range(STEPS):
            p, joint = self.marginals(f)
            miss = (label - p) * weight
            gu = np.bincount(f.feature, miss[f.row], len(self.unary)) * scale - RIDGE * 100 * self.unary
            gp = np.zeros_like(self.pair)
            np.add.at(gp, f.kind[child], (seen[child] - joint[child]) * weight[child][:, None, None])
            gp = gp * scale - RIDGE * 100 * (self.pair - prior)
            speed_u, speed_p = 0.9 * speed_u + 0.1 * gu, 0.9 * speed_p + 0.1 * gp
            self.unary += RATE * speed_u
            self.pair += RATE * speed_p


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis)
    return top + np.log(np.exp(x - np.expand_dims(top, axis)).sum(axis=axis))


def article_labels(page: Page) -> np.ndarray | None:
    """Labels of a page with one article element: its blocks, less those that name
    themselves something else."""
    if page.tag.count("article") != 1:
        return None
    label = np.zeros(len(page.tag), int)
    for k, (tag, p) in enumerate(zip(page.tag, page.parent, strict=True)):
        if tag == "article":
            label[k] = 1
        elif p >= 0 and label[p]:
            label[k] = not (tag in ("nav", "aside", "footer", "form") or names_in(page.attrs[k]) - {"content", "meta"})
    return label


def fit(pages: DataFrame, html: str = "html", key: str = "page_id") -> Model:
    """Train on the annotated layouts and a bounded sample of the table."""
    trees, labels = [], []
    for source in labelled_pages.layouts():
        page = Page(source)
        trees.append(page)
        labels.append(labelled_pages.labels_of(page))
    some = pages.where(F.length(html) <= SAMPLE_CHARS).where(F.contains(F.lower(html), F.lit("<article")))
    for r in bounded_sample(some.select(F.col(html).alias("h"), F.col(key).alias("k")), ["k", "h"], SAMPLE):
        page = Page(r["h"])
        label = article_labels(page)
        if label is not None:
            trees.append(page)
            labels.append(label)
    model = Model()
    forest = Forest(trees)
    model.train(forest, np.concatenate(labels), np.concatenate([np.full(len(p.tag), len(p.tag) ** -0.5) for p in trees]))
    return model


def main_texts(sources: list[str], model: Model) -> list[str]:
    """Main text of each page."""
    out, pages, size = [], [], 0

    def close():
        nonlocal pages, size
        if not pages:
            return
        forest = Forest(pages)
        p, _ = model.marginals(forest)
        for page, f in zip(pages, forest.first, strict=False):
            out.append(" ".join(t for k, t in page.texts if p[f + k] > 0.5))
        pages, size = [], 0

    for s in sources:
        pages.append(Page(s))
        size += len(pages[-1].tag)
        if size >= FOREST:
            close()
    close()
    return out


def extract(df: DataFrame, model: Model, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns of ``keep``, ``text`` and ``n_chars`` (code points) for every row.

    A null or empty page has the empty text; a page without tags is one block."""
    held = df.sparkSession.sparkContext.broadcast(model)

    def rows(batches):
        for b in batches:
            texts = main_texts([h or "" for h in b.column(len(keep)).to_pylist()], held.value)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             [*keep, "text", "n_chars"])

    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), "text string, n_chars long"])
    return df.select(*keep, html).mapInArrow(rows, schema)


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages, fit(pages))
