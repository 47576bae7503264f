"""Leaf blocks of web pages: the text between block-level tags, with the path of tags around it."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field
from functools import lru_cache
from typing import NamedTuple

# Element names of HTML.
INLINE = frozenset(
    """a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt
    ruby s samp small span strike strong sub sup time tt u var wbr""".split()
)
VOID = frozenset(
    "area base basefont br col embed frame hr img input link meta param source track wbr".split()
)
#: Read as raw text up to their end tag, and never shown as text.
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
#: Elements whose content is no text of the page; skipped where they are closed.
UNSHOWN = frozenset("template noscript svg math select object video audio canvas datalist".split())
#: What an opening tag closes, up to the nearest of the listed parents.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
_LETTERS = re.compile(r"[a-z]{2,}")


class Frame(NamedTuple):
    """An open element: its tag and the words of its class, id and role."""

    tag: str
    words: tuple[str, ...]


@dataclass
class Block:
    path: tuple[Frame, ...]
    text: str
    #: Characters of the text that are inside links.
    linked: int = 0
    links: int = 0


@lru_cache(maxsize=4096)
def frame(tag: str, attributes: str) -> Frame:
    words: list[str] = []
    for found in _NAMES.findall(attributes):
        for word in _LETTERS.findall(_HUMP.sub(" ", found).lower()):
            words.append(word[:-1] if word.endswith("s") and len(word) > 2 else word)
    if _HIDDEN.search(attributes):
        words.append("hidden")
    return Frame(tag, tuple(dict.fromkeys(words)))


@dataclass
class _Reader:
    """Open elements, and the text gathered since the last block-level tag."""

    stack: list[Frame] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)
    linked: int = 0
    links: int = 0
    depth_of_links: int = 0

    def text(self, raw: str) -> None:
        shown = html.unescape(raw) if "&" in raw else raw
        self.parts.append(shown)
        if self.depth_of_links:
            self.linked += len(shown.strip())

    def end_block(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append(Block(tuple(self.stack), text, min(self.linked, len(text)), self.links))
            self.parts, self.linked, self.links = [], 0, 0

    def pop(self, keep: int) -> None:
        for gone in self.stack[keep:]:
            self.depth_of_links -= gone.tag == "a"
        del self.stack[keep:]

    def open(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.parts.append(" ")
            return
        if tag not in INLINE:
            self.end_block()
            at = len(self.stack)
            while at and self.stack[at - 1].tag in INLINE:
                at -= 1
            if at and self.stack[at - 1].tag == "p":
                self.pop(at - 1)
        if tag in CLOSES:
            closed, parents = CLOSES[tag]
            for at in range(len(self.stack) - 1, -1, -1):
                if self.stack[at].tag in parents:
                    break
                if self.stack[at].tag in closed:
                    self.pop(at)
                    if tag != "tr":
                        break
        if tag not in VOID:
            if tag == "a":
                self.depth_of_links += 1
                self.links += 1
            self.stack.append(frame(tag, attributes))

    def close(self, tag: str) -> None:
        if tag not in INLINE:
            self.end_block()
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at].tag == tag:
                self.pop(at)
                return
            if tag in INLINE and self.stack[at].tag not in INLINE:
                return


def read_blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in their order.

    Comments, scripts, styles and other unshown elements are left out, references
    are decoded, a line break is a blank, and white space within a block counts
    as one blank.  Broken markup is read the way browsers read it: missing end
    tags of paragraphs, items and cells are supplied, end tags that nothing opened
    are ignored, an unended comment or script runs to the end.
    """
    reader = _Reader()
    at, last = 0, len(page)
    while at < last:
        found = _MARKUP.search(page, at)
        if found is None:
            # markup that never ends is dropped, a lone < is text
            cut = re.compile(r"<(?:/?[a-zA-Z]|[!?])").search(page, at)
            reader.text(page[at : cut.start()] if cut else page[at:])
            break
        if found.start() > at:
            reader.text(page[at : found.start()])
        at = found.end()
        tag = (found.group(2) or found.group(5) or "").lower()
        if not tag:
            continue
        if found.group(1) or found.group(4):
            reader.close(tag)
            continue
        attributes = found.group(3) or found.group(6) or ""
        if tag in RAW or tag in UNSHOWN:
            ended = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            if ended or tag in RAW:
                if tag not in INLINE:
                    reader.end_block()
                at = ended.end() if ended else last
            continue
        if not (attributes.endswith("/") and tag in UNSHOWN):
            reader.open(tag, attributes.strip())
    reader.end_block()
    return reader.blocks
