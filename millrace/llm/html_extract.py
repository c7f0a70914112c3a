"""Main-text extraction by the maximum-scoring subsequence.

A page is a sequence of words and tags. A word scores the log-odds that it belongs to the main text, learned
from labelled pages (`labelled_pages`) by logistic regression on the elements, classes, ids and roles that it stands in; a tag
costs what its kind cost in them. One linear scan finds the contiguous region of the greatest total score, and the text
blocks of the region are returned, without the words that the weights give to no main text (a notice, a form or a menu
amid the article) and without blocks of such links alone.

Reading and scoring are linear in the page, whatever its markup: what is searched for and not found is not searched for
again, an element knows the block around it, and an element's score is its parent's and its own.

Nulls count as empty. Pages without any positive word give an empty text. Repeated rows are read alike; columns but the
three named ones are not read. Empty tables give empty results. Broken markup is read as far as it goes: an end tag
closes the nearest open element of its name, a new block closes an open paragraph, and all is closed at the end.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import slices
from .labelled_pages import rendered

#: Elements whose content is never text (fixed values of the HTML standard).
RAW = {"script", "style", "template", "noscript", "iframe", "svg", "math", "object", "canvas", "audio", "video", "title", "textarea", "select"}
#: Raw elements that run to the end of the page if nothing closes them; others are then read as plain elements.
TO_THE_END = {"script", "style", "title", "textarea"}
#: Raw elements that end at "/>".
SELF_CLOSED = {"svg", "math"}
#: Elements without an end tag (fixed values of the HTML standard).
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements inside a line; all others begin and end a block (fixed values of the HTML standard).
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}

#: Elements that belong to the section they stand in, else to the page, and what makes a section (fixed values of the HTML standard).
SCOPED, SECTIONING = {"header", "footer"}, ("article", "aside", "main", "nav", "section")

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile(r"""=\s*(["'])|>""")
_CLOSE = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", re.I)
_CAMEL = re.compile(r"([a-z])([A-Z])")
_PART = re.compile(r"[a-z]+|\d+")


@lru_cache(100_000)
def features(name: str, attrs: str) -> tuple[str, ...]:
    """What an element says about its words: its name, and the words of its class, id and role, without the plural's s.
    The page's own elements, which stand around everything, say nothing."""
    if name in ("html", "body"):
        return ()
    if not attrs:
        return (name,)
    found = {name}
    for m in _NAMED.finditer(attrs):
        parts = _PART.findall(_CAMEL.sub(r"\1 \2", m[2]).lower())
        found.update("." + (p[:-1] if len(p) > 3 and p.endswith("s") and not p.endswith("ss") else p) for p in parts if not p.isdigit())
    return tuple(sorted(found))


class _Finder:
    """Searches from growing places; what is not found once is not searched for again."""

    def __init__(self, source: str):
        self.source, self.absent = source, set()

    def __call__(self, what: str | re.Pattern, start: int) -> tuple[int, int] | None:
        if what in self.absent:
            return None
        if isinstance(what, str):
            at = self.source.find(what, start)
            span = (at, at + len(what)) if at >= 0 else None
        else:
            m = what.search(self.source, start)
            span = m.span() if m else None
        if span is None:
            self.absent.add(what)
        return span


def tokens(source: str) -> Iterator[tuple[str, str, str]]:
    """("text", run, ""), ("open" or "close", name, attributes), ("raw", name, "") of a page, in order."""
    find, at = _Finder(source), 0
    while at < len(source):
        lt = source.find("<", at)
        if lt < 0:
            yield "text", source[at:], ""
            return
        if lt > at:
            yield "text", source[at:lt], ""
        start, at = lt, lt + 1
        if source.startswith(("<!", "<?"), start):
            for head, tail in (("<!--", "-->"), ("<![CDATA[", "]]>"), ("<", ">")):
                if source.startswith(head, start) and (span := find(tail, start + len(head))):
                    at = span[1]
                    break
            else:
                if not source.startswith("<![", start):  # an open comment or declaration runs to the end
                    return
            continue
        ends = source.startswith("/", at)
        m = _NAME.match(source, at + ends)
        if not m:
            if not ends:
                yield "text", "<", ""
            continue
        name, here = m[0].lower(), m.end()
        while True:  # the tag ends at the first > outside of quoted values
            stop = _STOP.search(source, here)
            if not stop:
                return  # an open tag at the end
            if stop[1] is None:
                break
            quote = find(stop[1], stop.end())
            here = quote[1] if quote else stop.end()
        attrs, at = source[m.end() : stop.start()], stop.end()
        if ends:
            yield "close", name, ""
        elif name in RAW:
            if name in SELF_CLOSED and attrs.endswith("/"):
                yield "raw", name, ""
            elif span := find(_CLOSE[name], at):
                at = span[1]
                yield "raw", name, ""
            elif name in TO_THE_END:
                yield "raw", name, ""
                return
            else:
                yield "open", name, attrs
        else:
            yield "open", name, attrs


class Page:
    """The tokens of a page: text runs with the element that they stand in, and tags between."""

    def __init__(self, source: str):
        # Each item: ("text", run, node) or ("tag", name, whether it breaks a block).
        self.items: list[tuple[str, str, int]] = []
        # A node for each path of features: its parent, and the features that its ancestors do not have.
        self.parents, self.own = [0], [()]
        known: dict[tuple[int, tuple[str, ...]], int] = {}
        # Open elements: name, node outside, the place of the nearest block among them, their features.
        open_: list[tuple[str, int, int, tuple[str, ...]]] = []
        names: dict[str, int] = {}
        held: dict[str, int] = {}
        here = 0

        def close(to: int) -> None:
            nonlocal here
            while len(open_) > to:
                name, here, _, has = open_.pop()
                names[name] -= 1
                for f in has:
                    held[f] -= 1

        for kind, value, attrs in tokens(source):
            if kind == "text":
                self.items.append(("text", value, here))
                continue
            if kind == "raw":
                self.items.append(("tag", value, 0))
                continue
            if kind == "close":
                if names.get(value):
                    to = len(open_) - 1
                    while open_[to][0] != value:
                        to -= 1
                    close(to)
            elif value not in VOID and not attrs.endswith("/"):
                block = open_[-1][2] if open_ else -1
                if value not in INLINE and block >= 0 and open_[block][0] in ("p", "li") and (open_[block][0] == "p" or value == "li"):
                    close(block)
                scoped = value in SCOPED and any(map(names.get, SECTIONING))
                has = features(f"{value} of a section" if scoped else value, attrs)
                key = (here, has)
                if key not in known:
                    known[key] = len(self.parents)
                    self.parents.append(here)
                    self.own.append(tuple(f for f in has if not held.get(f)))
                block = len(open_) if value not in INLINE else open_[-1][2] if open_ else -1
                open_.append((value, here, block, has))
                names[value] = names.get(value, 0) + 1
                for f in has:
                    held[f] = held.get(f, 0) + 1
                here = known[key]
            self.items.append(("tag", value, int(value not in INLINE)))

    def paths(self) -> list[tuple[str, ...]]:
        """All features of every node (for learning: a path may be as long as the page)."""
        out: list[tuple[str, ...]] = []
        for parent, own in zip(self.parents, self.own, strict=True):
            out.append((*out[parent], *own) if out else own)
        return out


#: The greatest score of a word, and the costs of tags.
MOST, COSTS = 4.0, (0.05, 1.5)
#: What a path found on a labelled page counts against a made one.
AS_FOUND = 20
#: Elements that mark words inside a line of text (fixed values of the HTML standard).
INLINE_TEXT = {"a", "abbr", "b", "cite", "code", "em", "font", "i", "kbd", "mark", "q", "s", "small", "span", "strong", "sub", "sup", "time", "u"}


class Weights:
    """Log-odds of words by the features around them, and costs of tags."""

    def __init__(self, word: dict[str, float], bias: float, tag: dict[str, float], any_tag: float):
        self.word, self.bias, self.tag, self.any_tag = word, bias, tag, any_tag

    def odds(self, page: Page) -> tuple[list[float], list[float]]:
        """The log-odds of a word in each node, and what they would be outside of links."""
        word, link = self.word, self.word.get("a", 0.0)
        total, plain = [self.bias], [self.bias]
        for parent, own in zip(page.parents[1:], page.own[1:], strict=True):
            more = sum(word.get(f, 0.0) for f in own)
            total.append(total[parent] + more)
            plain.append(plain[parent] + more - (link if "a" in own else 0.0))
        return total, plain

    def scores(self, page: Page) -> list[float]:
        """The score of a word in each node, from 0 (no content) to MOST."""
        return [max(0.0, min(MOST, x)) for x in self.odds(page)[0]]

    def cost(self, name: str) -> float:
        return self.tag.get(name, self.any_tag)


def region(page: Page, weights: Weights) -> tuple[int, int]:
    """The items first..last (excluded) of the greatest total score, by one scan; empty if none is positive."""
    best, span, total, first, scores = 0.0, (0, 0), 0.0, 0, weights.scores(page)
    for i, (kind, value, node) in enumerate(page.items):
        total += (scores[node] and scores[node] * len(value.split())) if kind == "text" else -weights.cost(value)
        if total <= 0:
            total, first = 0.0, i + 1
        elif total > best:
            best, span = total, (first, i + 1)
    return span


def main_text(source: str, weights: Weights) -> str:
    page = Page(source)
    first, last = region(page, weights)
    odds, plain = weights.odds(page)
    blocks, line, words = [], [], 0

    def end_block() -> None:
        nonlocal line, words
        if words:
            blocks.append("".join(line))
        line, words = [], 0

    for kind, value, extra in page.items[first:last]:
        if kind == "text":
            # A link stays in a block that has more than links.
            if plain[extra] > 0:
                line.append(value)
                words += len(value.split()) if odds[extra] > 0 else 0
        elif extra:
            end_block()
        elif value == "br":
            line.append(" ")
    end_block()
    clean = (" ".join(entities.unescape(b).split()) for b in blocks)
    return "\n".join(b for b in clean if b)


def transplanted(pages: list[Page]) -> dict[tuple[str, ...], list[int]]:
    """Paths made from those of the labelled pages, with counts of (side, main): what is side text on one page is so within
    the main text of any other, and an element inside a line of main text changes nothing.

    A transplant is an element of a page without main text, within one with main text, that a feature sets apart which
    no main text has. Headings stay where they are: a page's title is side text at its head and main text elsewhere.
    """
    main, holders, grafts = set(), set(), set()
    for page in pages:
        paths, n = page.paths(), len(page.parents)
        count = np.zeros((n, 2), int)
        for kind, value, node in page.items:
            if kind == "text":
                count[node] += value.split().count("side"), value.split().count("main")
        whole = count.copy()
        for node in range(n - 1, 0, -1):
            whole[page.parents[node]] += whole[node]
        for node in range(n):
            path = tuple(sorted(paths[node]))
            if count[node, 1]:
                main.add(path)
                holders.add(tuple(sorted(paths[page.parents[node]])))
            if count[node, 0]:
                top = node
                while top and not whole[page.parents[top], 1]:
                    top = page.parents[top]
                if not whole[top, 1]:
                    grafts.add(tuple(sorted(set(paths[node]) - set(paths[page.parents[top]]))) if top else path)
    known = {f for path in main for f in path}
    out: dict[tuple[str, ...], list[int]] = {}
    for graft in grafts:
        if set(graft) - known and "h1" not in graft:
            for holder in holders:
                out.setdefault(tuple(sorted({*holder, *graft})), [0, 0])[0] += 1
    for path in main:
        for name in INLINE_TEXT - set(path):
            out.setdefault(tuple(sorted((*path, name))), [0, 0])[1] += 1
    return out


def learn(pages: list[str], rounds: int = 25, decay: float = 1e-5) -> Weights:
    """Weights from labelled pages, in which words of the main text are spelled `main` and all others `side`."""
    read = [Page(source) for source in pages]
    stacks, tags = transplanted(read), {}
    for page in read:
        paths = page.paths()
        inside = [i for i, (kind, value, _) in enumerate(page.items) if kind == "text" and "main" in value]
        lo, hi = (inside[0], inside[-1]) if inside else (0, -1)
        for i, (kind, value, extra) in enumerate(page.items):
            if kind == "text":
                n = stacks.setdefault(tuple(sorted(paths[extra])), [0, 0])
                n[0] += AS_FOUND * value.split().count("side")
                n[1] += AS_FOUND * value.split().count("main")
            else:
                tags.setdefault(value, [0, 0])[int(lo < i < hi)] += 1
    stacks = {s: n for s, n in stacks.items() if sum(n)}
    names = sorted({f for s in stacks for f in s})
    at = {f: j for j, f in enumerate(names)}
    x = np.zeros((len(stacks), len(names)))
    for i, s in enumerate(stacks):
        x[i, [at[f] for f in s]] = 1
    # Every path counts once, shared between its labels: what is rare on the pages is learned like what is common.
    n = np.array(list(stacks.values()), float)
    weight = np.where(n.sum(axis=1) >= AS_FOUND, AS_FOUND, 1.0)
    n *= (weight / n.sum(axis=1) / weight.sum())[:, None]
    # Newton steps on the penalised logistic loss; the bias, last, is not penalised.
    x = np.column_stack([x, np.ones(len(x))])
    ridge = np.append(np.full(len(names), decay), 1e-9)
    w = np.zeros(len(names) + 1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ w)))
        all_ = n.sum(axis=1)
        slope = x.T @ (all_ * p - n[:, 1]) + ridge * w
        w -= np.linalg.solve(x.T @ (x * (all_ * np.maximum(p * (1 - p), 1e-6))[:, None]) + np.diag(ridge), slope)
    *w, b = w.tolist()
    cost = {t: float(np.clip(np.log((out + 1) / (in_ + 1)), *COSTS)) for t, (out, in_) in tags.items()}
    return Weights(dict(zip(names, w, strict=True)), b, cost, 0.3)


@lru_cache(1)
def learned() -> Weights:
    return learn(rendered())


def extract(pages: DataFrame, page_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    weights = learned()  # a number for each feature of the labelled pages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(h or "", weights) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    own = pages.select(F.col(f"`{page_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").cast("string").alias("html"))
    out = StructType([own.schema["page_id"], own.schema["url"], StructField("text", StringType())])
    return own.mapInArrow(run, out).withColumn("n_chars", F.length("text").cast("long"))
