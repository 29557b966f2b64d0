"""Main text of web pages: a linear-chain random field over the leaf blocks of the page.

A page is cut into leaf blocks: runs of text between the tags that start or end a block.  Each block
is described by its ancestors (tags, and what the names in their class, id and role say), by its text
and by whether the page has any regions at all.  The field, trained on the labelled pages below, labels every block main text or not; Viterbi decoding
picks the labels of the whole page at once.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from functools import lru_cache
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from weftline.llm.buffers import blocks
from weftline.llm.crf import LinearChain, fit

START = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][a-zA-Z0-9:-]*))")
QUOTE_OR_END = re.compile("[>\"']")
# Elements whose contents are no page text.
RAW_TAGS = frozenset("script style noscript template textarea svg iframe object".split())
RAW_ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW_TAGS}
ATTRIBUTE = re.compile(r"\b(class|id|role|data-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HINT = re.compile(r"[a-z]+|[A-Z][a-z]*")

# Elements of HTML that start a new block, that have no content, and that the opening
# of the listed others closes.
BLOCK_TAGS = frozenset(
    "html head body title p div section article main header footer nav aside h1 h2 h3 h4 h5 h6 ul ol"
    " li dl dt dd table thead tbody tfoot tr td th caption form fieldset legend label button select"
    " option input blockquote pre address figure figcaption details summary hr hgroup dialog menu"
    " center".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY = {
    "p": BLOCK_TAGS - {"button", "label", "input", "select", "option"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"},
    "tr": {"tr"},
    "option": {"option"},
    "head": {"body"},
}
SCOPES = frozenset("table article section main body div td th".split())

# Ancestors and words in their attributes that are features of a block.
TAG_FEATURES = (
    "title head nav header footer aside form article main section p li a h1 h2 h3 td button label"
    " select option figcaption blockquote pre table".split()
)
GROUPS = {
    "ad": "ad ads advert advertisement sponsor sponsored promo banner",
    "menu": "nav navigation menu breadcrumb breadcrumbs topbar navbar toc pagination pager tabs links",
    "head": "header masthead branding logo",
    "foot": "footer foot copyright legal colophon contentinfo",
    "side": "sidebar side aside related recommended widget popular trending complementary",
    "notice": "cookie cookies consent notice alert modal popup newsletter subscribe gdpr",
    "comment": "comment comments reply replies disqus discussion reader",
    "share": "share social sharing follow",
    "form": "form search login signup",
    "main": "content article post entry story main body text prose",
    "meta": "meta byline date tags category",
}
WORD_GROUP = {word: group for group, words in GROUPS.items() for word in words.split()}
# Words of names that tell a state of the element, not what it is.
STATES = frozenset("has with no without is enabled disabled open closed layout".split())
CONTENT_FEATURES = ("tag:article", "tag:main", "in:main")
FEATURE = {
    name: i
    for i, name in enumerate(
        ["one", *(f"tag:{t}" for t in TAG_FEATURES), *(f"in:{g}" for g in GROUPS)]
        + ["long", "short", "stops", "links", "all links", "copyright", "words", "outside", "header outside", "plain"]
    )
}
REGIONS = frozenset(
    FEATURE[name]
    for name in (
        *(f"tag:{t}" for t in "nav header footer aside form button label select option".split()),
        *(f"in:{g}" for g in GROUPS if g != "meta"),
        *CONTENT_FEATURES,
    )
)

# Words and class names of the training pages.
WORDS = (
    "river bread stone the a of and in old map wool was were it dough tide lamp north garden seed"
    " slowly under with Brot und der Fluss ist pan la casa mar les jours été vieux"
).split()
CONTENT_NAMES = ("content", "post", "entry", "article-body", "story", "main-text")
JUNK = {  # region: how it may be written
    "ad": ('<div class="ad">', '<div class="advert">', '<aside class="sponsored">', '<div id="promo-banner">'),
    "notice": ('<div class="cookie-notice">', '<div id="consent">', '<div class="alert">', '<div class="newsletter">'),
    "side": ("<aside>", '<div class="sidebar">', '<div id="related">', '<div class="widget">', '<aside class="side">'),
    "comments": (
        '<section class="comments">', '<div id="comments">', '<div class="comment-list">', '<section id="discussion">',
        '<div class="reader-comments">',
    ),
    "share": ('<div class="share">', '<ul class="social">'),
    "form": ("<form>", '<form class="search">', '<form id="login">'),
    "menu": ("<nav>", '<div class="menu">', '<ul class="breadcrumb">', '<div id="navigation">'),
    "header": ("<header>", '<div class="header">', '<div id="masthead">'),
    "footer": ("<footer>", '<div class="footer">', '<div role="contentinfo">'),
}


def labelled_page(random: Random) -> str:
    """A page for training, in which data-label tells the main text (1) from the rest (0).

    Text is drawn alike for all regions - long or short, with or without full stops or links - so
    that mostly the place of a block tells what it is.
    """

    def text(longest: int = 40) -> str:
        words = random.choices(WORDS, k=random.choice((1, 3, 8, 15, longest)))
        if random.random() < 0.2:
            words = [words[0]] * len(words)
        said = " ".join(words)
        said = random.choice((said, said.upper(), said.capitalize(), said.capitalize(), said.capitalize()))
        return said + random.choice((".", ".", ".", "", "!", " &amp;&amp;", " 3.5%", " |"))

    def link() -> str:
        return f'<a href="/{random.choice(WORDS)}">{text(4)}</a>'

    def prose() -> str:
        kinds = ["<p>{}</p>"] * 6 + ["<p>{}", "<p><b>{}<br><p>", "<h2>{}</h2>", "<blockquote>{}</blockquote>", "<pre>{}</pre>"]
        kinds += ["<ul><li>{}</li><li>{}</li></ul>", "<table><tr><td>{}</td><td>{}</td></tr></table>"]
        kinds += ["<figure><figcaption>{}</figcaption></figure>", "<p>{} " + link() + "</p>", "<div>{}</div>"]
        kind = random.choice(kinds)
        return kind.format(*(text() for _ in range(kind.count("{}"))))

    def junk(region: str) -> str:
        start = random.choice(JUNK[region])
        end = f"</{re.match('<([a-z]+)', start)[1]}>"
        if region in ("menu", "share"):
            inner = "".join(random.choice(("<li>{}</li>", "{} ")).format(link()) for _ in range(random.randint(1, 6)))
            inner = random.choice(("<ul>{}</ul>", "{}")).format(inner)
        elif region == "form":
            inner = f"<label>{text(3)}</label><input value=x><button>{text(3)}</button>"
        elif region == "comments":
            wrap = random.choice(("<p>{}</p>", "<article><p>{}</p></article>", '<div class="comment">{}</div>', "<li>{}</li>"))
            inner = f"<h3>{text(3)}</h3>" + "".join(wrap.format(text()) for _ in range(random.randint(1, 4)))
        else:
            mark = "&copy; " if region == "footer" and random.random() < 0.7 else ""
            title = f"<h1>{text(3)}</h1>" if region == "header" else text(3)
            inner = mark + random.choice((text(), title, f"<p>{text()}</p>", f"<h3>{text(3)}</h3><p>{text()}</p>{link()}", link()))
        return start.replace(">", " data-label=0>", 1) + inner + end

    def some(regions: list[str], share: float) -> str:
        return "".join(junk(r) for r in regions if random.random() < share)

    parts = [random.choice((f"<h1>{text(8)}</h1>", f"<header><h1>{text(8)}</h1></header>", ""))]
    parts += [prose() for _ in range(random.choice((0, 1, 2, 5, 9)))]
    if random.random() < 0.4:
        parts.insert(random.randint(1, len(parts)), junk(random.choice(("ad", "form", "share", "side", "notice"))))
    if random.random() < 0.2:
        parts.append(junk("comments"))
    body = "".join(parts)
    wrap = random.choice(("article", "article", "article", "main", "div", "both", "bare"))
    name = f"{random.choice(('id', 'class'))}={random.choice(CONTENT_NAMES)}"
    body = {
        "article": f"<article data-label=1>{body}</article>",
        "main": f"<main data-label=1>{body}</main>",
        "div": f"<div {name} data-label=1>{body}</div>",
        "both": f"<main data-label=0><article data-label=1>{body}</article>{some(['side', 'comments'], 0.3)}</main>",
        "bare": body,
    }[wrap]
    before = some(["header", "menu", "notice", "ad", "form"], 0.5)
    after = some(["share", "side", "comments", "ad", "form", "footer"], 0.5)
    if random.random() < 0.15:
        before = after = ""
    head = random.choice((f"<html><head><title>{text(8)}</title></head>", ""))
    kind = random.random()
    if kind < 0.1:  # no regions at all
        plain = "".join(prose() for _ in range(random.randint(1, 5))) if random.random() < 0.7 else text()
        return f"{head}<body data-label=1>{plain}"
    if kind < 0.18:  # regions are cells of a table
        links = " ".join(link() for _ in range(random.randint(1, 5)))
        cells = f"<td data-label=0>{links}</td><td data-label=1>{''.join(prose() for _ in range(random.randint(1, 5)))}</td>"
        return f"{head}<body><table><tr>{cells}</tr></table>{after}"
    return f"{head}<body data-label={int(wrap == 'bare')}>{before}{body}{after}"


class Block:
    __slots__ = ("text", "linked", "features", "label")

    def __init__(self, text: str, linked: int, features: tuple, label: bool):
        self.text, self.linked, self.features, self.label = text, linked, features, label


def _groups(name: str) -> set[str]:
    """The regions that one name of a class, id or role speaks of.

    ``has-sidebar`` or ``comments-enabled`` say nothing of the element itself, and the text of a
    sidebar or the content of a footer belongs there.
    """
    words = [word.lower() for word in HINT.findall(name)]
    if not STATES.isdisjoint(words):
        return set()
    groups = {WORD_GROUP[word] for word in words if word in WORD_GROUP}
    return groups - {"main"} if groups - {"main", "meta"} else groups


def _described(name: str, rest: str, above: tuple) -> tuple:
    """Features of an element's ancestors and itself, and whether it is marked as main text."""
    features, label = above
    found = {FEATURE[f"tag:{name}"]} if f"tag:{name}" in FEATURE else set()
    if "=" in rest:
        for key, *values in ATTRIBUTE.findall(rest):
            value = "".join(values)
            if key.lower() == "data-label":
                label = value == "1"
                continue
            if name not in ("html", "body"):
                found |= {FEATURE[f"in:{group}"] for each in value.split() for group in _groups(each)}
    return (features | found if not found <= features else features), label


class _Tags:
    """The tags of a page in one pass, whatever the page: no part of it is searched again and again."""

    def __init__(self, page: str):
        self.page, self.last_end = page, page.rfind(">")
        self.last_quote = {c: page.rfind(c) for c in "\"'"}
        self.quotes = True  # until a tag's quotes turn out to run to the end of the page

    def end(self, at: int) -> int:
        """Where the tag with its attributes from ``at`` on ends.

        A quote opens after an equals sign only; one that nothing closes is a letter like others, and
        the tag ends at the first bracket.  The caller knows that there is one.
        """
        page, place = self.page, at
        while self.quotes:
            found = QUOTE_OR_END.search(page, place)
            if found is None:
                self.quotes = False
                break
            if found[0] == ">":
                return found.end()
            before = found.start() - 1
            while page[before].isspace():
                before -= 1
            if page[before] != "=":
                place = found.end()
            elif found.start() == self.last_quote[found[0]]:
                break
            else:
                place = page.index(found[0], found.end()) + 1
        return page.index(">", at) + 1

    def __iter__(self) -> Iterator[tuple[int, int, str, bool, str]]:
        """(start, end, name, closes, attributes); comments and declarations have no name."""
        page, at = self.page, 0
        while found := START.search(page, at):
            start, at = found.span()
            if found[0] == "<!--":
                at = page.find("-->", at)
                at = len(page) if at < 0 else at + 3
                yield start, at, "", False, ""
            elif self.last_end >= at:
                if found[2] is None:
                    at = page.index(">", at) + 1
                    yield start, at, "", False, ""
                    continue
                end, name = self.end(at), found[2].lower()
                attributes, at = page[at : end - 1], end
                if name in RAW_TAGS and not found[1]:
                    closing = RAW_ENDS[name].search(page, end)
                    at = closing.end() if closing else len(page)
                yield start, at, name, bool(found[1]), attributes


class _Open:
    """The open elements; the innermost one of a name, of a kind and of all is at hand."""

    def __init__(self):
        self.stack: list[tuple[str, tuple]] = [("", (frozenset(), False))]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.scopes: list[int] = []

    def push(self, name: str, described: tuple) -> None:
        at = len(self.stack)
        self.stack.append((name, described))
        self.places.setdefault(name, []).append(at)
        if name in BLOCK_TAGS:
            self.blocks.append(at)
        if name in SCOPES:
            self.scopes.append(at)

    def pop(self, at: int) -> None:
        for name, _ in self.stack[at:]:
            self.places[name].pop()
        del self.stack[at:]
        for kind in (self.blocks, self.scopes):
            while kind and kind[-1] >= at:
                kind.pop()

    def close(self, name: str) -> None:
        """An end tag: a block closes its innermost start, a paragraph or phrase only within its block."""
        places = self.places.get(name)
        if not places:
            return
        limit = 0
        if name == "p":
            limit = self.blocks[-1]
        elif name not in BLOCK_TAGS and self.scopes:
            limit = self.scopes[-1]
        if places[-1] >= limit:
            self.pop(places[-1])

    def make_room(self, name: str) -> None:
        """The start of a block closes the innermost block if the two do not nest."""
        if self.blocks and name in CLOSED_BY.get(self.stack[self.blocks[-1]][0], ()):
            self.pop(self.blocks[-1])


def _closes_itself(attributes: str) -> bool:
    """Whether a tag ends in a slash that is no part of a value without quotes, as in ``href=/``."""
    if not attributes.endswith("/"):
        return False
    return attributes[-2:-1] in ("", '"', "'") or "=" not in attributes.split()[-1]


def leaf_blocks(page: str) -> list[Block]:
    """The blocks of a page with text, in page order; character references decoded."""
    found: list[Block] = []
    opened = _Open()
    stack = opened.stack
    pieces: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                features, label = stack[-1][1]
                found.append(Block(text, min(linked, len(text)), features, label))
            pieces.clear()
            linked = 0

    def add(text: str) -> None:
        nonlocal linked
        pieces.append(text)
        if any(name == "a" for name, _ in stack[-4:]):
            linked += len(text.strip())

    last = 0
    for start, end, name, closes, attributes in _Tags(page):
        if start > last:
            add(page[last:start])
        last = end
        if not name:
            continue
        if name in RAW_TAGS and not closes:
            if name != "svg":
                pieces.append(" ")
            continue
        if name == "br":
            pieces.append(" ")
            continue
        is_block = name in BLOCK_TAGS
        if is_block:
            flush()
        if closes:
            opened.close(name)
            continue
        if is_block:
            opened.make_room(name)
        if name not in VOID_TAGS and not _closes_itself(attributes):
            opened.push(name, _described(name, attributes, stack[-1][1]))
    if last < len(page):
        rest = page[last:]
        add(rest[: rest.rfind("<")] if re.search(r"<[a-zA-Z/!][^<>]*\Z", rest) else rest)
    flush()
    return found


def features(page_blocks: list[Block]) -> np.ndarray:
    """One row for each block."""
    rows = np.zeros((len(page_blocks), len(FEATURE)))
    body = [b for b in page_blocks if FEATURE["tag:title"] not in b.features]
    plain = all(REGIONS.isdisjoint(b.features) for b in body)
    plain = plain and 2 * sum(b.linked for b in body) < sum(len(b.text) for b in body)
    for row, block in zip(rows, page_blocks, strict=True):
        row[list(block.features)] = 1
        row[FEATURE["one"]] = 1
        outside = not any(FEATURE[name] in block.features for name in CONTENT_FEATURES)
        row[FEATURE["outside"]] = outside
        row[FEATURE["plain"]] = plain and FEATURE["tag:title"] not in block.features and block.linked <= 0.9 * len(block.text)
        row[FEATURE["header outside"]] = outside and FEATURE["tag:header"] in block.features
        n, words = len(block.text), block.text.count(" ") + 1
        row[FEATURE["long"]] = min(1.0, math.log1p(n) / 7)
        row[FEATURE["short"]] = n < 25
        row[FEATURE["stops"]] = block.text[-1] in ".!?…。"
        row[FEATURE["links"]] = block.linked / n
        row[FEATURE["all links"]] = block.linked > 0.9 * n
        row[FEATURE["copyright"]] = "©" in block.text
        row[FEATURE["words"]] = min(1.0, words / 20)
    return rows


@lru_cache(maxsize=1)
def trained(pages: int = 400) -> LinearChain:
    """The field, fitted to labelled pages made from fixed random numbers."""
    random = Random(20)
    made = [found for _ in range(pages) if (found := leaf_blocks(labelled_page(random)))]
    labels = [np.array([b.label for b in page], int) for page in made]
    return fit([features(page) for page in made], labels, rounds=300, penalty=1e-4)


def main_text(page: str, field: LinearChain) -> str:
    """The main text of a page: its blocks in page order, an empty line between two."""
    page_blocks = leaf_blocks(page)
    if not page_blocks:
        return ""
    labels = field.decode(field.scores(features(page_blocks)).tolist())
    return "\n\n".join(b.text for b, keep in zip(page_blocks, labels, strict=True) if keep)


def extract(
    df: DataFrame, page: str = "html", into: str = "text", field: LinearChain | None = None
) -> DataFrame:
    """``df`` with the main text of ``page`` in ``into`` and its code points in ``n_chars``.

    Null and empty pages and pages without main text give an empty text; markup that never ends is
    read as far as it goes; repeated rows are all returned; columns of ``df`` with the new names
    are replaced; an empty table gives an empty result.  Nothing is shuffled.
    """
    field = field or trained()
    names = [n for n in df.columns if n not in (into, "n_chars")]
    kept = df.select(*names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, page):
            texts = [main_text(p or "", field) for p in block.column(page).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*block.columns, pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                names=[*names, into, "n_chars"],
            )

    return kept.mapInArrow(read, f"{kept.schema.simpleString()[7:-1]}, {into} string, n_chars long")
