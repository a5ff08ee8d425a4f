"""HTML to leaf blocks: runs of text between block borders, with their places.

One pass over the page, linear in its length whatever its markup: a tag's end is
searched once, elements are closed by remembered places, and what the
extractor knows of an element's ancestors is a small state made from its
parent's.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field
from functools import lru_cache
from typing import NamedTuple

BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav noscript ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
INLINE = frozenset(
    "a abbr acronym audio b bdi bdo big canvas cite code data datalist del dfn em font i ins kbd label map mark math meter nobr object output picture progress q rb rp rt ruby s samp script slot small span strike strong style sub sup svg template textarea time tt u var video".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no text of the page, whatever it looks like.
RAW = frozenset("script style template textarea title iframe select head".split())
#: Of these the end is the next end tag of the name, whatever lies between.
OPAQUE = frozenset("script style textarea title iframe".split())
#: Any other start tag, and any text, ends a head that was left open.
IN_HEAD = frozenset("base basefont bgsound head html link meta noscript script style template title".split())
#: Any other block ends a select that was left open.
IN_SELECT = frozenset("select option optgroup hr".split())
#: An open element that a start tag ends, and where the search for it stops.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
ENDS_P = BLOCK - {"body", "html", "head", "button", "title"}
NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
#: What may end a tag, and what opens a value in quotes.
STOP = re.compile(r">|=\s*[\"']")
ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|style|hidden|aria-hidden|itemprop)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
HIDDEN = re.compile(r"display:\s*none|visibility:\s*hidden|(?:^| )hidden=|aria-hidden=true")
PARTS = re.compile(r"[^a-z]+")
ARTICLE, BESIDE = frozenset(("article", "main")), frozenset("nav aside footer header form".split())


class Place(NamedTuple):
    """What is known of an element and its ancestors."""

    tags: frozenset[str]
    #: The two innermost tags.
    leaf: tuple[str, ...]
    #: Parts of class, id and role names: all, and the innermost named element's.
    names: frozenset[str]
    near: frozenset[str]
    hidden: bool
    #: Behind the innermost article or main: what it holds that stands beside text.
    inner: str | None


ROOT = Place(frozenset(), (), frozenset(), frozenset(), False, None)


@lru_cache(maxsize=50_000)
def _inside(place: Place, tag: str, names: frozenset[str] | None, hidden: bool) -> Place:
    """The place of an element in a place."""
    inner = "none" if tag in ARTICLE else tag if place.inner == "none" and tag in BESIDE else place.inner
    return Place(place.tags | {tag}, (*place.leaf[-1:], tag), place.names if names is None else place.names | names, place.near if names is None else names, place.hidden or hidden, inner)


@dataclass
class Block:
    """A leaf block: its text, its place, and how much of it is links."""

    text: str
    place: Place
    linked: int
    parts: int = 1


@dataclass
class _Reader:
    #: Parts of names worth telling apart; the others are left out of places.
    known: frozenset[str]
    stack: list[tuple[str, Place]] = field(default_factory=list)
    #: Where in the stack each tag stands, and the blocks, and those but p.
    where: dict[str, list[int]] = field(default_factory=dict)
    blocks: list[int] = field(default_factory=list)
    walls: list[int] = field(default_factory=list)
    out: list[Block] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    linked: int = 0
    links: int = 0
    raw: int = 0
    anchors: int = 0

    def flush(self) -> None:
        if not self.text:
            return
        joined = " ".join(html.unescape("".join(self.text)).split())
        if joined:
            self.out.append(Block(joined, self.stack[-1][1] if self.stack else ROOT, min(self.linked, len(joined)), self.links))
        self.text, self.linked, self.links = [], 0, 0

    def end_head(self) -> None:
        """Ends the head if it, or a noscript in it, is the innermost element."""
        inner = [tag for tag, _ in self.stack[-2:]]
        if inner[-1:] == ["head"] or inner == ["head", "noscript"]:
            self.close_within({"head"}, set())

    def take(self, text: str) -> None:
        if self.raw and text and not text.isspace():
            self.end_head()
        if text and not self.raw:
            self.text.append(text)
            if self.anchors:
                self.linked += len(text.strip())

    def last(self, tags: set[str]) -> int:
        """The innermost place in the stack of any of the tags, or -1."""
        return max((held[-1] for t in tags if (held := self.where.get(t))), default=-1)

    def push(self, tag: str, place: Place) -> None:
        at = len(self.stack)
        self.stack.append((tag, place))
        self.where.setdefault(tag, []).append(at)
        if tag in BLOCK:
            self.blocks.append(at)
            if tag != "p":
                self.walls.append(at)
        self.raw += tag in RAW
        self.anchors += tag == "a"

    def pop(self, down_to: int) -> None:
        while len(self.stack) > down_to:
            tag, _ = self.stack.pop()
            self.where[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()
                if tag != "p":
                    self.walls.pop()
            self.raw -= tag in RAW
            self.anchors -= tag == "a"

    def close_within(self, tags: set[str], stop: set[str]) -> None:
        if (at := self.last(tags)) > self.last(stop):
            self.pop(at)

    def start(self, tag: str, attributes: str) -> None:
        if self.raw:
            if tag not in IN_HEAD:
                self.end_head()
            if tag in BLOCK and tag not in IN_SELECT:
                self.close_within({"select"}, set())
        if tag in BLOCK:
            self.flush()
        elif tag == "br":
            self.take(" ")
        if tag in VOID:
            return
        if tag in ENDS_P and (p := self.where.get("p")) and p[-1] > (self.walls[-1] if self.walls else -1):
            self.pop(p[-1])
        if tag in CLOSES:
            self.close_within(*CLOSES[tag])
        if tag == "body":  # a head is over, whether it was closed or not
            self.close_within({"head"}, set())
        names, hidden = None, False
        if attributes and not attributes.isspace():
            marks = " ".join(f"{m[1]}={m[2] or m[3] or m[4] or ''}" for m in ATTRIBUTE.finditer(attributes)).lower()
            if marks:
                names, hidden = frozenset(PARTS.split(marks)) & self.known, HIDDEN.search(marks) is not None
        # Tags of no known name are alike, so that places stay few.
        told = tag if tag in BLOCK or tag in INLINE else "other"
        self.push(tag, _inside(self.stack[-1][1] if self.stack else ROOT, told, names, hidden))
        self.links += tag == "a"

    def end(self, tag: str) -> None:
        if tag in BLOCK:
            self.flush()
        at = self.last({tag})
        if at >= 0 and (tag in BLOCK or not self.blocks or self.blocks[-1] < at):
            self.pop(at)


def _tag_end(page: str, at: int, quotes: bool) -> int:
    """Behind the > of the tag whose name ends at at, or -1; values in quotes
    may hold one."""
    while (m := STOP.search(page, at)) is not None:
        if m[0] == ">":
            return m.end()
        at = page.find(m[0][-1], m.end()) + 1 if quotes else m.end()
        if not at:
            return -1
    return -1


def blocks(page: str | None, known: frozenset[str] = frozenset()) -> list[Block]:
    """The page's blocks of visible text, in order; known: see _Reader."""
    page, r, at, quotes = page or "", _Reader(known), 0, True
    while (open_ := page.find("<", at)) >= 0:
        r.take(page[at:open_])
        if page.startswith(("<!", "<?"), open_):
            end = "-->" if page.startswith("<!--", open_) and not page.startswith(("<!-->", "<!--->"), open_) else ">"
            close = page.find(end, open_ + 4 if end == "-->" else open_ + 2)
            at = close + len(end) if close >= 0 else len(page)
            continue
        m = NAME.match(page, open_ + 1)
        if m is None:
            r.take("<")
            at = open_ + 1
            continue
        end = _tag_end(page, m.end(), quotes)
        if end < 0 and quotes:
            # A value whose quotes never close: from here on quotes mean nothing.
            quotes, end = False, _tag_end(page, m.end(), False)
        if end < 0:  # a tag that never ends is no text
            at = len(page)
            break
        tag, attributes, at = m[2].lower(), page[m.end() : end - 1], end
        if m[1]:
            r.end(tag)
            continue
        own = attributes.endswith("/") and tag not in BLOCK
        r.start(tag, attributes)
        if tag in VOID:
            continue
        if own and tag not in OPAQUE:
            r.pop(len(r.stack) - 1)
        elif tag in OPAQUE:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
            r.pop(len(r.stack) - 1)
            at = close.end() if close else len(page)
    r.take(page[at:])
    r.flush()
    return r.out
