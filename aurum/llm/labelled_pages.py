"""Annotated page layouts that the extraction model is trained on.

A layout is made from a few parts: a container of the article, what stands in
it, and what stands around it.  Every element carries its label in a
``data-label`` attribute (1: content), which is read for training and is not a
feature.  Texts are made of syllables; only lengths and punctuation matter.
"""

from __future__ import annotations

import random
import re

import numpy as np

_LABEL = re.compile(r'data-label="([01])"')
COUNT, SEED = 400, 11

#: Containers of articles, and blocks around and inside them, by tag and attributes.
CONTAINERS = ["article", "main", 'div class="content"', 'div id="content"', 'div class="post-body"', 'div class="entry-content"',
              'section class="story"', 'div class="article-text"', 'div class="c1"', 'div id="x7"', 'article class="post"', "section", "div"]
WRAPPERS = ['div id="page"', 'div class="wrapper"', 'div class="container"', "div", 'div class="row"', 'div id="main"', "main"]
LINK_BOXES = ["nav", 'div class="menu"', 'ul class="breadcrumb"', 'div id="navigation"', 'div class="related"', 'div class="tags"',
              'aside class="popular"', 'div class="share-buttons"', 'div class="pagination"', 'section class="recommended"', 'div class="c9"']
TEXT_BOXES = ['div class="ad"', 'div class="advert"', 'aside', 'div class="sidebar"', 'div class="cookie-notice"', 'div class="notice"',
              'div id="consent"', 'section class="comments"', 'div class="comment"', 'div id="disqus_thread"', 'div class="newsletter"',
              'div class="promo"', 'aside class="widget"', 'div class="banner"', 'div class="popup"', 'div role="alert"',
              'div class="sponsored"', 'div class="disclaimer"', 'section id="comments"', 'div class="subscribe"', 'ol class="commentlist"',
              'div role="complementary"', 'div style="display:none"', 'div class="user-replies"']
FORMS = ["form", 'form class="search"', 'form id="login"', 'form class="comment-form"']
HEADS = ["header", 'div class="header"', 'div id="masthead"', 'div class="topbar"', 'header class="site-header"']
FEET = ["footer", 'div class="footer"', 'div id="footer"', 'footer class="site-footer"', 'div class="copyright"']


def layouts() -> list[str]:
    rng = random.Random(SEED)
    return [_Layout(rng).page() for _ in range(COUNT)]


def labels_of(page) -> np.ndarray:
    """Labels of a parsed layout's blocks (blocks that carry none follow their parent)."""
    label = np.zeros(len(page.tag), int)
    for k, (a, p) in enumerate(zip(page.attrs, page.parent, strict=True)):
        m = _LABEL.search(a)
        label[k] = int(m.group(1)) if m else label[p] if p >= 0 else 0
    return label


class _Layout:
    def __init__(self, rng: random.Random):
        self.r = rng

    def words(self, least: int, most: int) -> str:
        n = self.r.randint(least, most)
        return " ".join("".join(self.r.choice("ba de ki lo mu ra se ti vo zen".split()) for _ in range(self.r.randint(1, 4))) for _ in range(n))

    def sentences(self, least: int, most: int) -> str:
        return " ".join(self.words(3, 18).capitalize() + self.r.choice("...!?") for _ in range(self.r.randint(least, most)))

    def tag(self, spec: str, label: int, body: str) -> str:
        return f'<{spec} data-label="{label}">{body}</{spec.split(" ")[0]}>'

    def link(self) -> str:
        return f'<a href="/{self.words(1, 1)}">{self.words(1, 4)}</a>'

    def links(self, label: int = 0) -> str:
        if self.r.random() < 0.6:
            return self.tag("ul", label, "".join(self.tag("li", label, self.link()) for _ in range(self.r.randint(2, 8))))
        return " ".join(self.link() for _ in range(self.r.randint(2, 8)))

    def paragraph(self, label: int) -> str:
        text = self.sentences(1, 6) if self.r.random() < 0.85 else self.words(1, 4).capitalize() + "."
        if self.r.random() < 0.15:
            text += " " + self.link() + " " + self.sentences(1, 2)
        if self.r.random() < 0.1:
            return f'<p data-label="{label}"><b>{text}<br>'  # left open
        return self.tag("p", label, text)

    def inside(self) -> str:
        """Blocks of an article, now and then with something else between them."""
        out = []
        if self.r.random() < 0.75:
            head = self.tag(self.r.choice(["h1", "h1", "h2"]), 1, self.words(2, 12).capitalize() + self.r.choice(["", "", "."]))
            out.append(self.tag("header", 1, head) if self.r.random() < 0.15 else head)
        for _ in range(self.r.choice([0, 1, 2, 3, 5, 8, 12])):
            x = self.r.random()
            if x < 0.72:
                out.append(self.paragraph(1))
            elif x < 0.78:
                out.append(self.tag(self.r.choice(["h2", "h3"]), 1, self.words(1, 6)))
            elif x < 0.83:
                kind = self.r.choice(["ul", "ol"])
                out.append(self.tag(kind, 1, "".join(self.tag("li", 1, self.sentences(1, 2)) for _ in range(self.r.randint(2, 5)))))
            elif x < 0.86:
                out.append(self.tag("blockquote", 1, self.paragraph(1)))
            elif x < 0.88:
                rows = "".join(self.tag("tr", 1, "".join(self.tag("td", 1, self.words(1, 3)) for _ in range(3))) for _ in range(3))
                out.append(self.tag("table", 1, rows))
            elif x < 0.90:
                out.append(self.tag("figure", 1, "<img src=x>" + self.tag("figcaption", 1, self.sentences(1, 1))))
            elif x < 0.92:
                out.append(self.tag("pre", 1, self.words(5, 30)))
            else:
                out.append(self.around())
        if not any('data-label="1"' in o for o in out):
            out.append(self.paragraph(1))
        return "".join(out)

    def around(self) -> str:
        x = self.r.random()
        if x < 0.35:
            return self.tag(self.r.choice(LINK_BOXES), 0, self.links())
        if x < 0.85:
            body = self.sentences(1, 2) if self.r.random() < 0.4 else "".join(self.paragraph(0) for _ in range(self.r.randint(1, 3)))
            if self.r.random() < 0.3:
                body = self.tag("h3", 0, self.words(1, 3)) + body
            spec = self.r.choice(TEXT_BOXES)
            return self.tag(spec, 0, self.tag("li", 0, body) if spec.startswith("ol") else body)
        return self.tag(self.r.choice(FORMS), 0, self.tag("p", 0, self.words(1, 5)) + "<input name=q>" + self.words(1, 2))

    def page(self) -> str:
        top = self.r.random()
        parts = []
        if top < 0.7:
            logo = self.tag("div", 0, self.link()) if self.r.random() < 0.5 else self.words(1, 3)
            parts.append(self.tag(self.r.choice(HEADS), 0, logo + self.links()))
        if self.r.random() < 0.7:
            parts.append(self.tag("nav", 0, self.links()))
        parts += [self.around() for _ in range(self.r.randint(0, 3))]
        if self.r.random() < 0.08:
            parts.append(self.inside())  # the article stands in the body itself
        else:
            spec = self.r.choice(CONTAINERS)
            body = self.tag(spec, 1, self.inside())
            for _ in range(self.r.randint(0, 2)):
                body = self.tag(self.r.choice(WRAPPERS), 0, body + (self.around() if self.r.random() < 0.4 else ""))
            parts.append(body)
        parts += [self.around() for _ in range(self.r.randint(0, 3))]
        if self.r.random() < 0.85:
            text = ("&copy; " if self.r.random() < 0.7 else "") + self.sentences(1, 2)
            parts.append(self.tag(self.r.choice(FEET), 0, self.tag("p", 0, text) if self.r.random() < 0.3 else text + (self.links() if self.r.random() < 0.3 else "")))
        return '<!DOCTYPE html><html data-label="0"><head data-label="0"></head><body data-label="0">' + "".join(parts) + "</body></html>"
