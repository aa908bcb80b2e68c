"""Main text of web pages: a linear-chain conditional random field over blocks.

The markup is cut into leaf blocks (runs of text between block-level tags)
with their ancestor tags, class names and text statistics as features. A
two-label chain, trained by gradient ascent on its log-likelihood over the
labelled pages, is decoded by Viterbi, and the blocks of the main text are
joined in page order.

Results at the edges: a null or empty page, and one without text blocks, has
the empty text. Pages of any length are read whole; broken markup is read as
far as it goes. Repeated rows are read one by one; an empty table gives an
empty table; columns of the input named like a result are replaced. Reading
takes time in line with the page's length, however broken its tags are; text
in formulas (MathML) is part of the block around it.
"""

from __future__ import annotations

import functools
import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.html_pages import labelled_pages

SIMPLE = re.compile(r"<(/?)([a-zA-Z][^\s/><]*)(\s*/?)>")
OPENING = re.compile(r"<(/?)([a-zA-Z][^\s/><]*)(?=[\s/>])")
#: One attribute's name and, if it has a value, the sign before the value.
ATTRIBUTE = re.compile(r"[\s/]*(=?[^\s/>=]+|=)(\s*=\s*)?")
UNQUOTED = re.compile(r"[^\s>]*")
GAP = re.compile(r"[\s/]*")
LONG_NUMBER = re.compile(r"&#([0-9]{9,});?")
#: Elements by the way they are read.
HIDDEN = frozenset("script style noscript template textarea title iframe svg object select head".split())
#: What ends a hidden element: its own closing tag alone, whatever else looks like one.
CLOSING = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in HIDDEN}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr "
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom msub msup msubsup munder mover "
    "munderover mmultiscripts mprescripts mtable mtr mtd semantics annotation annotation-xml".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words in class names, ids and roles that tell the part of a page.
PARTS = {
    "ad": "ad ads advert advertisement adsbygoogle sponsor sponsored promo promotion banner",
    "notice": "notice cookie consent alert warning gdpr popup modal overlay notification",
    "side": "sidebar side aside widget related recommended trending complementary",
    "menu": "menu nav navbar navigation breadcrumb breadcrumbs pagination share social toolbar tags",
    "head": "header masthead topbar site-header banner top",
    "foot": "footer copyright site-footer contentinfo bottom legal",
    "comment": "comment comments reply replies respond discussion disqus",
    "form": "form search newsletter subscribe signup login",
    "main": "content main article post entry body story text page-content",
}
WORD_PART = {w: part for part, names in PARTS.items() for w in names.split()}


class Reader:
    """Cuts a page into tags and text; each character is looked at a bounded number of times.

    A quote starts a value only right after ``=``, and runs to the next such
    quote, as in a browser. Where none is left, the quote is a plain character
    of an unquoted value. A tag that would run past the page's end, and every
    tag after it, ends at its first ``>``.
    """

    def __init__(self, page: str):
        self.page, self.last_end = page, page.rfind(">")
        self.unclosed: set[str] = set()  # quotes that do not occur again
        self.plain = False

    def tag(self, at: int) -> tuple[int, bool, str, list[tuple[str, str]], bool] | None:
        """The tag at ``at``: its end, closing or not, name, attributes, empty or not; None: no tag."""
        if at > self.last_end:
            return None
        if m := SIMPLE.match(self.page, at):
            return m.end(), bool(m[1]), m[2].lower(), [], "/" in m[3]
        m = OPENING.match(self.page, at)
        if not m:
            return None
        end, found, empty = self._attributes(m.end())
        return end, bool(m[1]), m[2].lower(), found, empty

    def _attributes(self, start: int) -> tuple[int, list[tuple[str, str]], bool]:
        page, at, found = self.page, start, []
        stop = page.find(">", start) if self.plain else len(page)
        while m := ATTRIBUTE.match(page, at, stop):
            at, value = m.end(), ""
            if m[2] and at < stop:
                quote = page[at]
                end = -1
                if quote in "\"'" and quote not in self.unclosed:
                    end = page.find(quote, at + 1, stop)
                    if end < 0 and stop == len(page):
                        self.unclosed.add(quote)
                if end >= 0:
                    value, at = page[at + 1 : end], end + 1
                else:
                    v = UNQUOTED.match(page, at, stop)
                    value, at = v[0], v.end()
            found.append((m[1].lower(), value))
        gap = GAP.match(page, at, stop)
        at = gap.end()
        if at == len(page):  # the page ends inside this tag
            self.plain = True
            return self._attributes(start)
        return at + 1, found, gap[0].endswith("/")

    def other(self, at: int) -> int | None:
        """The end of a comment, declaration or instruction at ``at``; None: plain text."""
        if self.page.startswith("<!--", at):
            end = self.page.find("-->", at + 4)
            return len(self.page) if end < 0 else end + 3
        if at < self.last_end and self.page[at + 1] in "!?":
            return self.page.find(">", at) + 1
        return None

    def after_hidden(self, name: str, at: int) -> int:
        """Where a hidden element that began before ``at`` ends."""
        closing = CLOSING[name].search(self.page, at)
        if not closing or closing.end() > self.last_end:
            return len(self.page)
        return self.page.find(">", closing.end()) + 1


def unescape(text: str) -> str:
    """Character references decoded; numbers beyond any code point give U+FFFD."""

    def shorten(m: re.Match) -> str:
        digits = m[1].lstrip("0") or "0"
        return f"&#{digits};" if len(digits) < 9 else "\ufffd"

    return html.unescape(LONG_NUMBER.sub(shorten, text))


def _parts(attributes: list[tuple[str, str]]) -> list[str]:
    found = []
    for name, value in attributes:
        if name in ("class", "id", "role", "itemprop"):
            for w in re.split(r"[^a-z]+", unescape(value).lower()):
                if w in WORD_PART:
                    found.append(WORD_PART[w])
    return found


class Open:
    """An open element with what holds for all open ones around it (shared, so depth costs nothing)."""

    __slots__ = ("name", "tags", "parts", "last", "linked", "on")

    def __init__(self, around: Open | None, name: str, parts: list[str]):
        self.name = name
        if around is None:
            self.tags, self.parts, self.last, self.linked, self.on = frozenset(), frozenset(), "none", False, ()
            return
        tags = {name} - around.tags if name not in INLINE or parts else frozenset()
        more = sorted(set(parts) - around.parts)
        self.tags = around.tags | tags if tags else around.tags
        self.parts = around.parts.union(more) if more else around.parts
        self.last = name if name not in INLINE or parts else around.last
        self.linked = around.linked or name == "a"
        self.on = around.on + (*("in=" + t for t in tags), *("part=" + p for p in more)) if tags or more else around.on


class Stack:
    def __init__(self) -> None:
        self.items = [Open(None, "", [])]
        self.n_open: dict[str, int] = {}

    @property
    def top(self) -> Open:
        return self.items[-1]

    def open(self, name: str, attributes: list[tuple[str, str]]) -> None:
        self.items.append(Open(self.top, name, _parts(attributes)))
        self.n_open[name] = self.n_open.get(name, 0) + 1

    def close(self, name: str, stop: tuple[str, ...] = ()) -> None:
        """Close the innermost ``name`` and what is open inside it, unless a barrier is met."""
        if not self.n_open.get(name):
            return
        for k in range(len(self.items) - 1, 0, -1):
            here = self.items[k].name
            if here == name:
                for x in self.items[k:]:
                    self.n_open[x.name] -= 1
                del self.items[k:]
                return
            if here in stop or name in INLINE and here not in INLINE:
                return


class Block:
    __slots__ = ("around", "text", "linked")

    def __init__(self, around: Open, text: str, linked: int):
        self.around, self.text, self.linked = around, text, linked


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order."""
    out, stack, text, linked = [], Stack(), [], 0
    reader, at = Reader(page), 0

    def add(piece: str) -> None:
        nonlocal linked
        text.append(piece)
        if stack.top.linked:
            linked += len(piece)

    def flush() -> None:
        nonlocal linked
        if text:
            joined = " ".join(unescape("".join(text)).split())
            if joined:
                out.append(Block(stack.top, joined, linked))
            text.clear()
        linked = 0

    while at < len(page):
        if page[at] != "<":
            end = page.find("<", at)
            end = len(page) if end < 0 else end
            add(page[at:end])
            at = end
            continue
        tag = reader.tag(at)
        if tag is None:
            end = reader.other(at)
            if end is None:
                add("<")
            at = end or at + 1
            continue
        at, closes, name, attributes, empty = tag
        if name in HIDDEN and not closes:
            if name != "head" and not empty:
                at = reader.after_hidden(name, at)
            flush()
        elif name in INLINE:
            if name == "br":
                add(" ")
            elif closes:
                stack.close(name)
            elif name not in VOID:
                stack.open(name, attributes)
        else:
            flush()
            if closes:
                stack.close(name)
            elif name not in VOID and not empty:
                if name == "p" or name in HEADINGS:
                    stack.close("p")
                elif name in ("li", "td", "tr", "dd", "dt", "option"):
                    stack.close(name, stop=("ul", "ol", "table", "dl", "select", "div"))
                else:
                    stack.close("p", stop=("div", "article", "section", "li", "td"))
                stack.open(name, attributes)
    flush()
    return out


def features(found: list[Block]) -> list[list[str]]:
    """Names of the features that are on, per block."""
    rows, n = [], len(found)
    has_main = any("article" in b.around.tags or "main" in b.around.tags or "main" in b.around.parts for b in found)
    for i, b in enumerate(found):
        tags, parts = b.around.tags, b.around.parts
        words = b.text.count(" ") + 1
        inside = "article" in tags or "main" in tags or "main" in parts
        f = ["bias", "tag=" + b.around.last, *b.around.on]
        f += [f"words={min(words.bit_length(), 6)}", f"linked={min(3, 4 * b.linked // max(1, len(b.text)))}"]
        f.append(f"main={inside}" if has_main else "main=none")
        f.append("end" if b.text[-1] in ".!?…" else "no end")
        if "©" in b.text:
            f.append("copyright")
        if b.around.last in HEADINGS:
            f.append(f"heading={inside}")
        if not parts and not tags & {"nav", "header", "footer", "aside", "form"}:
            f.append("plain")
        f.append("place=" + str(min(4, 5 * i // n)))
        rows.append(f)
    return rows


class Chain:
    """Two-label linear chain; ``w`` per feature and label, ``t`` per label pair."""

    def __init__(self, names: dict[str, int], w: np.ndarray, t: np.ndarray):
        self.names, self.w, self.t = names, w, t

    def scores(self, rows: list[list[str]]) -> np.ndarray:
        ids = [[self.names[x] for x in r if x in self.names] for r in rows]
        flat = self.w[[k for r in ids for k in r]]
        starts = np.cumsum([0, *map(len, ids)])[:-1]
        return np.add.reduceat(flat, starts, axis=0)  # every block has the bias

    def decode(self, rows: list[list[str]]) -> list[int]:
        (t00, t01), (t10, t11) = self.t.tolist()
        back, (a, b) = [], (0.0, 0.0)
        for k, (s0, s1) in enumerate(self.scores(rows).tolist()):
            if k:
                x0, x1 = a + t00 < b + t10, a + t01 < b + t11
                back.append((x0, x1))
                a, b = (b + t10 if x0 else a + t00) + s0, (b + t11 if x1 else a + t01) + s1
            else:
                a, b = s0, s1
        path = [int(b > a)]
        for step in reversed(back):
            path.append(int(step[path[-1]]))
        return path[::-1]


def _marginals(s: np.ndarray, t: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """log Z, label marginals and expected transitions of one page."""
    n = len(s)
    alpha, beta = np.empty((n, 2)), np.zeros((n, 2))
    alpha[0] = s[0]
    for i in range(1, n):
        alpha[i] = s[i] + np.logaddexp.reduce(alpha[i - 1][:, None] + t, axis=0)
    for i in range(n - 2, -1, -1):
        beta[i] = np.logaddexp.reduce(t + (s[i + 1] + beta[i + 1])[None, :], axis=1)
    z = np.logaddexp.reduce(alpha[-1])
    pairs = np.exp(alpha[:-1, :, None] + t + (s[1:] + beta[1:])[:, None, :] - z).sum(axis=0) if n > 1 else np.zeros((2, 2))
    return z, np.exp(alpha + beta - z), pairs


def train(pages: list[tuple[str, list[tuple[str, int]]]], steps: int = 45, ridge: float = 0.05) -> Chain:
    """The chain that maximises the pages' penalised log-likelihood (RProp steps)."""
    data, names = [], {}
    for page, labels in pages:
        found = blocks(page)
        want = {" ".join(t.split()): y for t, y in labels}
        rows = features(found)
        y = np.array([want[b.text] for b in found])
        ids = [[names.setdefault(x, len(names)) for x in r] for r in rows]
        sizes = np.array([len(r) for r in ids])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        data.append((np.concatenate(ids), starts, np.repeat(np.arange(len(ids)), sizes), np.eye(2)[y], y))
    w, t = np.zeros((len(names), 2)), np.zeros((2, 2))
    size_w, size_t = np.full(w.shape, 0.1), np.full(t.shape, 0.1)
    old_w, old_t = np.zeros(w.shape), np.zeros(t.shape)
    for _ in range(steps):
        gw, gt = -ridge * w, -ridge * t
        for ids, starts, block, one_hot, y in data:
            _, p, pairs = _marginals(np.add.reduceat(w[ids], starts, axis=0), t)
            np.add.at(gw, ids, (one_hot - p)[block])
            np.add.at(gt, (y[:-1], y[1:]), 1.0)
            gt -= pairs
        for g, old, size, value in ((gw, old_w, size_w, w), (gt, old_t, size_t, t)):
            same = np.sign(g) * np.sign(old)
            size *= np.where(same > 0, 1.2, np.where(same < 0, 0.5, 1.0))
            np.clip(size, 1e-4, 1.0, out=size)
            value += np.sign(g) * size
            old[:] = g
    return Chain(names, w, t)


@functools.cache
def default_chain() -> Chain:
    return train(labelled_pages(160))


def main_text(page: str | None, chain: Chain) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    return " ".join(b.text for b, y in zip(found, chain.decode(features(found))) if y)


def extract(pages: DataFrame, chain: Chain | None = None, column: str = "html") -> DataFrame:
    """``pages`` without the html, with ``text`` and ``n_chars`` (its code points)."""
    chain = chain or default_chain()
    kept = [c for c in pages.columns if c not in (column, "text", "n_chars")]
    rows = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(column).cast("string").alias("_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h, chain) for h in b.column(len(kept)).to_pylist()]
            cols = [b.column(i) for i in range(len(kept))]
            cols += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.record_batch(cols, names=[*kept, "text", "n_chars"])

    schema = rows.drop("_html").schema.add("text", "string").add("n_chars", "long")
    return rows.mapInArrow(run, schema)
