"""Main text of web pages by a linear-chain conditional random field.

A page is cut into leaf blocks (runs of text between block-level tags, in page
order, each with its ancestors). A block's features are its ancestors' tags,
the words of their class, id and role attributes, its own tag and simple
traits of its text (length, links, punctuation). The chain has two labels,
main text or not; it is trained by maximum likelihood (forward-backward, Adam)
on labelled pages, and Viterbi decodes a page.

No labelled pages are given, so they are drawn here from a seeded generator of
page layouts whose labels are known by construction; ``train`` takes any other
labelled pages as well.

Scripts, styles, titles and text areas are skipped, to the end of the page if
they are not closed. The contents of all other elements, also <svg>, <math>,
<noscript>, <template>, <object> and the like, are text of the block they stand
in or blocks of their own, for the chain to judge; a self-closed one is empty.

Defined results: a null or empty page, or one without main text, has an empty
text of 0 characters; a page of plain text, without block elements, is all main
text; unclosed, crossed and unknown tags, stray quotes and unclosed attribute
values are tolerated and lose no text; very long and very deep pages take time in
proportion to their length (of ancestors the outer MOST_DEPTH are kept); null ids, null urls and repeated rows are handled row by row; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import html as htmllib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements by how they are read.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option optgroup p pre search section select summary "
    "table tbody td tfoot th thead tr ul button label".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|title|textarea"  # their contents are no text of the page, whatever they hold
FOREIGN = frozenset(("svg", "math"))  # inside them <title/> and the like close themselves
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "option": ("option",), "tbody": ("tr", "td", "th"), "body": ("head",)}
NO_P = frozenset("button label option legend summary".split())  # these may stand inside a paragraph

_TAG = re.compile(r"<(/?)([a-z][a-z0-9:-]*)(?=[\s/>])", re.I)
# a tag without oddities in one match; anything else is read attribute by attribute
_PLAIN = re.compile(r"""<(/?)([a-z][a-z0-9:-]*+)((?:\s++[^\s"'<>/=]++(?:=(?:"[^"<>]*+"|'[^'<>]*+'|[^\s"'=<>`/]++))?+)*+)\s*+(/?)>""", re.I)
_ATTRIBUTE = re.compile(r"[\s/]*+(?:(>)|(=?[^\s/>=]*+)(\s*+=\s*+)?+)")
_UNQUOTED = re.compile(r"[^\s>]*+")
_RAW_ENDS = {t: re.compile(rf"</{t}\s*+>", re.I) for t in RAW.split("|")}
_NAMES = re.compile(r"""\b(?:class|id|role)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""", re.I)
_NAMED = frozenset(("class", "id", "role"))
_PIECES = re.compile(r"[a-z]+")
MOST_DEPTH = 64  # of the ancestors that are kept; what is nested deeper counts as lying in the last of them


@dataclass
class Tag:
    start: int
    end: int
    name: str  # "" for comments, declarations and the like
    closing: bool = False
    empty: bool = False  # closes itself
    names: str = ""  # its class, id and role


class Tags:
    """The tags of a page from left to right, in time linear in its length: what a
    failed reading has seen is not read again, and a sign is not looked for behind
    its last place. Only a quote that begins a value opens one, and only if the
    page closes it; a tag that would swallow the rest of the page ends at its
    first ">"; without any, the "<" is text."""

    def __init__(self, page: str):
        self.page = page
        self.last = {c: page.rfind(c) for c in ('"', "'", ">")}
        self.dead: set[int] = set()  # places between attributes from which no tag ends

    def next(self, at: int) -> Tag | None:
        page = self.page
        while (at := page.find("<", at)) >= 0 and at < self.last[">"]:
            if m := _PLAIN.match(page, at):
                names = " ".join(x or y or z for x, y, z in _NAMES.findall(m[3])) if m[3] else ""
                return Tag(at, m.end(), m[2].lower(), bool(m[1]), bool(m[4]), names)
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                return Tag(at, end + 3 if end >= 0 else len(page), "")
            if m := _TAG.match(page, at):
                end, names = self._attributes(m.end())
                end = end or page.find(">", at) + 1
                return Tag(at, end, m[2].lower(), bool(m[1]), page[end - 2] == "/", names)
            if page.startswith(("<!", "<?", "</"), at):
                return Tag(at, page.find(">", at) + 1, "")
            at += 1
        if at >= 0 and (at := page.find("<!--", at)) >= 0:
            return Tag(at, len(page), "")  # a comment that nothing ends
        return None

    def _attributes(self, at: int) -> tuple[int, str]:
        """Where the tag ends (0: nowhere), and its class, id and role."""
        page, seen, names = self.page, [], []
        while at < len(page) and at not in self.dead:
            seen.append(at)
            m = _ATTRIBUTE.match(page, at)
            at = m.end()
            if m[1]:
                return at, " ".join(names)
            if m[3]:
                quote = page[at:at + 1]
                if quote in ('"', "'") and self.last[quote] > at:
                    end = page.find(quote, at + 1)
                    value, at = page[at + 1:end], end + 1
                else:
                    v = _UNQUOTED.match(page, at)
                    value, at = v[0], v.end()
                if m[2].lower() in _NAMED:
                    names.append(value)
        self.dead.update(seen)
        return 0, " ".join(names)


@dataclass
class Block:
    text: str
    path: tuple[tuple[str, tuple[str, ...]], ...]  # (tag, words of its class, id, role), outermost first
    linked: int = 0  # characters inside links


def leaf_blocks(page: str | None) -> list[Block]:
    page = page or ""
    stack: list[tuple[str, tuple[str, ...]]] = []
    out: list[Block] = []
    run: list[str] = []
    linked, link, at, foreign, deeper = 0, False, 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if run:
            text = " ".join(htmllib.unescape("".join(run)).split())
            if text:
                out.append(Block(text, tuple(stack), linked))
            run.clear()
        linked = 0

    tags = Tags(page)
    while m := tags.next(at):
        if m.start > at:
            run.append(page[at:m.start])
            linked += link * (m.start - at)
        at, tag = m.end, m.name
        if tag in _RAW_ENDS:
            if not m.closing and not (foreign and m.empty):
                end = _RAW_ENDS[tag].search(page, at)
                at = end.end() if end else len(page)
            continue
        if not tag:
            continue
        if tag in FOREIGN and not m.empty:
            foreign = max(0, foreign + (-1 if m.closing else 1))
        if tag == "a":
            link = not m.closing
        elif tag == "br":
            run.append(" ")
        if tag not in BLOCKS:
            continue
        flush()
        if m.closing:
            if deeper:
                deeper -= 1
            elif any(tag == t for t, _ in stack):
                while stack.pop()[0] != tag:
                    pass
            continue
        if len(stack) >= MOST_DEPTH and tag not in VOID:
            deeper += 1
            continue
        if stack and stack[-1][0] == "p" and tag not in NO_P:
            stack.pop()
        closing = CLOSES.get(tag, ())
        while stack and stack[-1][0] in closing:
            stack.pop()
        if tag not in VOID:
            stack.append((tag, tuple(dict.fromkeys(_PIECES.findall(m.names.lower())))))
    if at < len(page):
        run.append(page[at:])
    flush()
    return out


def _size(n: int) -> int:
    return next((i for i, most in enumerate((2, 5, 10, 20, 40, 80)) if n <= most), 6)


def features(blocks: list[Block]) -> list[list[str]]:
    out = []
    for i, b in enumerate(blocks):
        text, tags = b.text, [t for t, _ in b.path]
        words, links = text.count(" ") + 1, b.linked / max(len(text), 1)
        f = ["one", f"own:{tags[-1] if tags else '-'}", f"words:{_size(words)}", f"links:{0 if links < 0.05 else 1 if links < 0.5 else 2}"]
        f += [f"in:{t}" for t in set(tags)]
        f += [f"name:{w}" for w in {w for _, ws in b.path for w in ws}]
        f.append(f"commas:{min(text.count(','), 3)}")
        if text[-1] in ".!?…":
            f.append("ends")
        if "©" in text or "copyright" in text.lower():
            f.append("rights")
        if i == 0:
            f.append("first")
        if i == len(blocks) - 1:
            f.append("last")
        out.append(f)
    return out


@dataclass
class Chain:
    """Weights for "main" against "other" a feature, and of label pairs."""

    weight: dict[str, float] = field(default_factory=dict)
    pair: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))

    def decode(self, blocks: list[Block]) -> list[bool]:
        """Viterbi: the most likely labels; a tie goes to "other"."""
        get, pair = self.weight.get, self.pair.tolist()
        other, main, back = 0.0, 0.0, []
        for i, f in enumerate(features(blocks)):
            e = sum(get(x, 0.0) for x in f)
            if i:
                oo, mo, om, mm = other + pair[0][0], main + pair[1][0], other + pair[0][1], main + pair[1][1]
                back.append((mo > oo, mm > om))
                other, main = max(oo, mo), max(om, mm)
            main += e
        labels = [main > other] if blocks else []
        for came in reversed(back):
            labels.append(came[labels[-1]])
        return labels[::-1]


def train(pages: list[tuple[list[Block], list[bool]]], steps: int = 150, ridge: float = 0.02) -> Chain:
    """Maximum likelihood with a ridge, all pages at once."""
    pages = [p for p in pages if p[0]]
    lists = [features(b) for b, _ in pages]
    names = sorted({x for page in lists for f in page for x in f})
    index = {x: i for i, x in enumerate(names)}
    width, most, n = max(len(f) for page in lists for f in page), max(map(len, lists)), len(pages)
    ids = np.full((n, most, width), len(names))
    gold, there = np.zeros((n, most), int), np.zeros((n, most), bool)
    for i, (page, (_, labels)) in enumerate(zip(lists, pages)):
        for j, f in enumerate(page):
            ids[i, j, :len(f)] = [index[x] for x in f]
        gold[i, :len(labels)], there[i, :len(labels)] = labels, True
    w, pair = np.zeros(len(names) + 1), np.zeros((2, 2))
    moment = [np.zeros_like(w), np.zeros_like(w), np.zeros((2, 2)), np.zeros((2, 2))]
    both = there[:, 1:]
    seen_pair = np.zeros((2, 2))
    np.add.at(seen_pair, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    rows = np.arange(n)
    last = there.sum(1) - 1

    def total(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)

    for step in range(1, steps + 1):
        emit = np.zeros((n, most, 2))
        emit[:, :, 1] = w[ids].sum(2)
        fore, rear = np.zeros((n, most, 2)), np.zeros((n, most, 2))
        fore[:, 0] = emit[:, 0]
        for t in range(1, most):
            fore[:, t] = total(fore[:, t - 1, :, None] + pair, 1) + emit[:, t]
        for t in range(most - 2, -1, -1):
            ahead = total(pair + (emit[:, t + 1] + rear[:, t + 1])[:, None, :], 2)
            rear[:, t] = np.where(there[:, t + 1, None], ahead, 0.0)
        z = total(fore[rows, last], 1)
        p_main = np.where(there, np.exp(np.minimum(fore[:, :, 1] + rear[:, :, 1] - z[:, None], 0)), 0)
        diff = np.where(there, p_main - gold, 0)
        grad = np.bincount(ids.ravel(), np.repeat(diff.ravel(), width), len(names) + 1) + ridge * w * n / 10
        joint = fore[:, :-1, :, None] + pair + (emit[:, 1:] + rear[:, 1:])[:, :, None, :] - z[:, None, None, None]
        grad_pair = np.where(both[:, :, None, None], np.exp(np.minimum(joint, 0)), 0).sum((0, 1)) - seen_pair + ridge * pair * n / 10
        for x, g, a, b in ((w, grad, moment[0], moment[1]), (pair, grad_pair, moment[2], moment[3])):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            x -= 0.15 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
        w[-1] = 0
    return Chain(dict(zip(names, w.tolist())), pair)


# --------------------------------------------------------- labelled pages
MAIN = "\ue000"  # marks main text in drawn pages; taken out before training
# Names that page authors commonly give to parts of a page.
MAIN_NAMES = "content article post entry story body text main-content post-content entry-content article-body story-body page-content".split()
PLAIN_NAMES = "container wrapper page row col inner site grid layout box section block".split()
ASIDES = {
    "menu": "nav navbar menu navigation breadcrumb breadcrumbs toc pagination pager topbar".split(),
    "header": "header masthead site-header branding top logo".split(),
    "footer": "footer site-footer copyright bottom legal colophon".split(),
    "side": "sidebar side widget related recommended aside trending tags more-stories".split(),
    "notice": "cookie cookies consent notice alert gdpr popup modal banner message disclaimer paywall".split(),
    "advert": "ad ads advert advertisement sponsor sponsored promo ad-slot ad-banner commercial".split(),
    "form": "newsletter subscribe signup search login form contact".split(),
    "social": "share social sharing follow".split(),
    "comments": "comments comment-list comment discussion replies reply disqus respond responses".split(),
}
SEMANTIC = {"menu": "nav", "header": "header", "footer": "footer", "side": "aside", "form": "form"}


def drawn_page(rng: random.Random) -> str:
    """One page with its main text marked."""

    def sentence(low: int, high: int) -> str:
        words = ["".join(rng.choice("bcdfghklmnprstvw") + rng.choice("aeiouy") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(low, high))]
        return " ".join(w + ("," if rng.random() < 0.08 else "") for w in words).capitalize() + "."

    def prose() -> str:
        return " ".join(sentence(3, 18) for _ in range(rng.choice((1, 1, 2, 3, 5, 8)))) if rng.random() > 0.12 else sentence(1, 2)

    def bare(low: int = 1, high: int = 3) -> str:
        return sentence(low, high).rstrip(".")

    def element(tag: str, inside: str, name: str = "") -> str:
        attr = f' {rng.choice(("class", "class", "id"))}="{name}"' if name else ""
        return f"<{tag}{attr}>{inside}" + ("" if tag in ("p", "li") and rng.random() < 0.1 else f"</{tag}>")

    def boilerplate(kind: str) -> str:
        link = lambda: f'<a href="/{rng.randint(1, 99)}">{bare()}</a>'
        links = "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(rng.randint(2, 7))) + "</ul>"
        tag = SEMANTIC.get(kind, "div")
        named = rng.random() < (0.5 if kind in SEMANTIC else 1)
        if named and kind in SEMANTIC and rng.random() < 0.5:
            tag = "div"
        name = rng.choice(ASIDES[kind]) if named else ""
        inside = {
            "menu": lambda: rng.choice((links, " ".join(link() for _ in range(4)))),
            "header": lambda: rng.choice((element("h1", bare()), element("p", bare(2, 5)), f"<span>{bare()}</span>", link())) + rng.choice(("", links)),
            "footer": lambda: rng.choice((f"&copy; {bare()} &middot; {prose()}", element("p", f"&copy; 20{rng.randint(10, 30)} {bare()}"), element("p", prose()) + links)),
            "side": lambda: element("h3", bare()) + rng.choice((links, element("p", prose()))),
            "notice": lambda: rng.choice((prose(), element("p", prose()) + "<button>Ok</button>")),
            "advert": lambda: rng.choice((prose(), element("p", prose()), link(), element("h4", bare()) + element("p", prose()))),
            "form": lambda: element("label", bare()) + '<input type="text">' + rng.choice(("", element("p", prose()))) + "<button>Go</button>",
            "social": lambda: " ".join(link() for _ in range(3)),
            "comments": lambda: element("h3", bare()) + "".join(element(rng.choice(("div", "li", "article")), element("p", prose()) * rng.randint(1, 2), rng.choice(("comment", "reply", "comment-body", ""))) for _ in range(rng.randint(1, 4))),
        }[kind]()
        if kind == "comments":
            tag = rng.choice(("section", "div", "ol"))
        return element(tag, inside, name)

    def main_block() -> str:
        kind = rng.random()
        if kind < 0.72:
            return element("p", f"{MAIN}{rng.choice(('', '', '<b>', '<em>'))}{prose()}{rng.choice(('', '', '<br>'))}")
        if kind < 0.82:
            return element(rng.choice(("h2", "h3")), MAIN + bare(2, 7))
        if kind < 0.88:
            return "<ul>" + "".join(element("li", MAIN + prose()) for _ in range(rng.randint(2, 4))) + "</ul>"
        if kind < 0.92:
            return element("blockquote", rng.choice((MAIN + prose(), element("p", MAIN + prose()))))
        if kind < 0.95:
            return "<table>" + "".join("<tr>" + "".join(element("td", MAIN + bare()) for _ in range(3)) + "</tr>" for _ in range(2)) + "</table>"
        return element("p", f'{MAIN}{prose()} <a href="/x">{bare()}</a> {prose()}')

    parts = [element("h1", MAIN + bare(3, 10))] if rng.random() < 0.85 else []
    parts += [main_block() for _ in range(rng.choice((1, 2, 4, 7, 12)))]
    for kind in ("advert", "social", "side", "form", "menu", "notice"):
        if rng.random() < 0.12:
            parts.insert(rng.randint(0, len(parts)), boilerplate(kind))
    if rng.random() < 0.15:
        parts.append(boilerplate("comments"))
    tag = rng.choice(("article", "article", "main", "div", "section"))
    main = element(tag, "".join(parts), rng.choice(MAIN_NAMES) if tag in ("div", "section") or rng.random() < 0.3 else "")
    for _ in range(rng.randint(0, 2)):
        main = element(rng.choice(("div", "main", "section")), main, rng.choice(PLAIN_NAMES + MAIN_NAMES))
    before = [boilerplate(k) for k in ("notice", "header", "menu", "advert", "form", "side") if rng.random() < 0.45]
    after = [boilerplate(k) for k in ("social", "comments", "side", "form", "advert", "notice", "footer") if rng.random() < 0.45]
    rng.shuffle(before)
    body = "".join(before) + main + "".join(after)
    if rng.random() < 0.3:
        body = element("div", body, rng.choice(PLAIN_NAMES))
    return f"<!DOCTYPE html><html><head><title>{bare()}</title></head><body>{body}" + rng.choice(("</body></html>", ""))


def labelled(page: str) -> tuple[list[Block], list[bool]]:
    blocks = leaf_blocks(page)
    labels = [MAIN in b.text for b in blocks]
    for b in blocks:
        b.text = b.text.replace(MAIN, "").strip() or "."
    return blocks, labels


@functools.lru_cache(maxsize=4)
def default_chain(pages: int = 1_000, seed: int = 1) -> Chain:
    rng = random.Random(seed)
    return train([labelled(drawn_page(rng)) for _ in range(pages)])


def main_text(page: str | None, chain: Chain) -> str:
    blocks = leaf_blocks(page)
    plain = not any(b.path for b in blocks)  # text without any element to judge it by
    return "\n\n".join(b.text for b, m in zip(blocks, [True] * len(blocks) if plain else chain.decode(blocks)) if m)


def extract(pages: DataFrame, chain: Chain | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    shared = pages.sparkSession.sparkContext.broadcast(chain or default_chain())

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = shared.value
        for s in batches:
            yield pd.Series([main_text(h, c) for h in s], dtype=object)

    rows = pages.select("page_id", "url", text(F.col("html").cast("string")).alias("text"))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
