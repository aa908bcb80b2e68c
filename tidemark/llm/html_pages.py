"""Labelled pages for the extractor, made from a rule.

Each page is a list of blocks (html, text, label); label 1 is main text. The
layouts differ in containers, class names, order and faults of the markup.
"""

from __future__ import annotations

import numpy as np

#: Names in use for the parts of a page.
MAIN = ("article", "main", "div class=content", "div id=main-content", "div class=post-body", "section class=entry", "div class=story", "div")
ADVERTS = ("div class=ad", "div class=advert", "aside class=sponsor", "div id=banner-ad", "div class=promo", "ins class=adsbygoogle", "section class=sponsored")
NOTICES = ("div class=notice", "div class=cookie-notice", "div id=consent", "div role=alert", "div class=alert", "p class=notice", "div class=banner")
SIDES = ("aside", "div class=sidebar", "div id=side", "aside class=related", "section class=widget")
HEADERS = ("header", "div class=header", "div id=masthead", "div class=topbar", "header class=site-header")
FOOTERS = ("footer", "div class=footer", "div id=footer", "footer class=site-footer")
MENUS = ("nav", "ul class=menu", "div class=navbar", "div id=breadcrumbs", "nav class=pagination", "div class=share")
COMMENTS = ("section class=comments", "div id=comments", "div class=comment-list", "ol class=comments", "div class=replies")
FORMS = ("form", "form class=search", "form id=newsletter", "div class=subscribe")


class Page:
    def __init__(self, rng: np.random.Generator):
        self.rng, self.html, self.blocks = rng, [], []

    def words(self, low: int, high: int) -> str:
        n = int(self.rng.integers(low, high + 1))
        w = ["".join(self.rng.choice(list("abcdeghilmnoprstuéñü"), int(self.rng.integers(1, 9)))) for _ in range(n)]
        ends = self.rng.random(n) < 0.12
        return " ".join(x + "." * bool(e) for x, e in zip(w, ends)) + "." * int(n > 6)

    def block(self, tag: str, text: str, label: int, inner: str = "{}", close: bool = True) -> None:
        name = tag.split()[0]
        attrs = "".join(f' {k}="{v}"' for k, v in (a.split("=") for a in tag.split()[1:]))
        self.html.append(f"<{name}{attrs}>{inner.format(text)}" + f"</{name}>" * close)
        self.blocks.append((text, label))

    def inside(self, tag: str, body) -> None:
        name = tag.split()[0]
        attrs = "".join(f' {k}="{v}"' for k, v in (a.split("=") for a in tag.split()[1:]))
        self.html.append(f"<{name}{attrs}>")
        body()
        self.html.append(f"</{name}>")

    def pick(self, names: tuple[str, ...]) -> str:
        return names[int(self.rng.integers(len(names)))]

    def links(self, low: int, high: int) -> None:
        for _ in range(int(self.rng.integers(low, high))):
            self.block(self.pick(("li", "li", "li", "p", "div")), self.words(1, 4), 0, '<a href="/x">{}</a>')

    def prose(self, n: int, label: int) -> None:
        for _ in range(n):
            self.block(self.pick(("p", "p", "p", "div", "blockquote")), self.words(4, 60), label, close=self.rng.random() < 0.9)

    def main(self) -> None:
        tag = self.pick(MAIN)

        def body() -> None:
            title = lambda: self.block("h1", self.words(1, 10), 1)
            if self.rng.random() < 0.2:
                self.inside("header", title)
            elif self.rng.random() < 0.9:
                title()
            if self.rng.random() < 0.3:
                self.block("p", self.words(2, 60), 1, "<b>{}<br>", close=False)
            for _ in range(int(self.rng.integers(1, 4))):
                self.prose(int(self.rng.integers(1, 5)), 1)
                if self.rng.random() < 0.4:
                    self.block("h2", self.words(1, 6), 1)
                if self.rng.random() < 0.3:
                    self.inside("ul", lambda: [self.block("li", self.words(1, 15), 1) for _ in range(3)])
                if self.rng.random() < 0.2:
                    self.block("pre", self.words(3, 20), 1)
                if self.rng.random() < 0.25:
                    self.block(self.pick(ADVERTS), self.words(2, 25), 0)
                if self.rng.random() < 0.1:
                    self.block("p", self.words(1, 3), 1)

        self.inside(tag, body)

    def build(self) -> tuple[str, list[tuple[str, int]]]:
        r = lambda p: self.rng.random() < p
        group = lambda names, body: self.inside(self.pick(names), body)
        if r(0.5):
            group(HEADERS, lambda: [self.block(self.pick(("h1", "p", "div", "span")), self.words(1, 8), 0)])
        if r(0.9):
            group(MENUS, lambda: self.inside("ul", lambda: self.links(2, 8)))
        if r(0.4):
            self.block(self.pick(NOTICES), self.words(4, 40), 0)
        if r(0.7):
            self.block(self.pick(ADVERTS), self.words(3, 40), 0)
        if r(0.3):
            group(FORMS, lambda: [self.block(t, self.words(1, 5), 0) for t in ("label", "button", "p")])
        if r(0.3):
            group(SIDES, lambda: self.prose(1, 0))
        self.main()
        if r(0.3):
            self.block(self.pick(ADVERTS), self.words(3, 30), 0)
        if r(0.5):
            group(SIDES, lambda: [self.links(1, 5), self.prose(int(r(0.5)), 0)])
        if r(0.5):
            one = self.pick(("div class=comment", "article class=comment", "li", "p"))
            group(COMMENTS, lambda: [self.inside(one, lambda: self.prose(1, 0)) for _ in range(3)])
        if r(0.3):
            group(FORMS, lambda: [self.block(t, self.words(1, 12), 0) for t in ("p", "label", "button")])
        if r(0.3):
            self.block(self.pick(NOTICES), self.words(4, 30), 0)
        if r(0.9):
            group(FOOTERS, lambda: [self.block(self.pick(("p", "div", "span")), "© " + self.words(2, 25), 0)])
        page = f"<!DOCTYPE html><html><head><title>x</title><style>p{{}}</style></head><body>{''.join(self.html)}</body></html>"
        return page, self.blocks


def labelled_pages(n: int = 240, seed: int = 1) -> list[tuple[str, list[tuple[str, int]]]]:
    """``n`` pages as (html, blocks with labels in page order)."""
    rng = np.random.default_rng(seed)
    return [Page(rng).build() for _ in range(n)]
