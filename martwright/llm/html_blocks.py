"""Web pages as sequences of leaf blocks: their text, and the tags around it."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

# Fixed values of HTML: elements without content (an svg that gets here is one that closed itself), elements within a line,
# formulas among them, elements whose content is not text, and elements that an element of the same kind closes.
VOID = frozenset("area base br col embed hr img input link meta param source svg track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby s samp small span strike strong sub sup "
    "time tt u var wbr "
    "math annotation annotation-xml maction merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace "
    "msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
# of those, the ones that stand apart from what is before them
_SPACED = frozenset("annotation annotation-xml br mspace mtd mtr".split())
RAW = ("script", "style", "template", "noscript", "iframe", "object", "svg", "canvas")
CLOSES_ITSELF = frozenset("p li dt dd tr td th option".split())
# an opened block ends an open paragraph
_ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre "
    "section table ul".split()
)

# Attributes up to the end of a tag. A quote opens a value only directly after an equals sign and if it is closed; outside of values a tag ends before
# the next one opens. Possessive throughout, so that what can't match fails at once: pages of unclosed tags take time in proportion.
_VALUE = r"""=\s*+(?:"[^"]*+"|'[^']*+')?+"""
_ATTRIBUTES = rf"(?:[^<>=]++|{_VALUE})*+"
# A name ends at white space, a slash or the end of the tag: svg-icon is no svg. Only an svg can close itself.
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?!svg(?=[\s/])(?:[^<>=/]++|{_VALUE}|/(?!>))*+/>)({'|'.join(RAW)})(?=[\s/>]){_ATTRIBUTES}>.*?(?:</\1(?=[\s/>])[^<>]*+>?|\Z)"
    r"|<[!?][^<>]*+>"
    rf"|<(/?)([a-zA-Z][^\s/<>]*+)({_ATTRIBUTES})>",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME = re.compile(r"[a-z]+")


class Block(NamedTuple):
    text: str
    path: tuple[str, ...]  # tags and, marked with a dot, words of their class, id and role
    linked: float  # share of the characters inside links


class _Reader:
    def __init__(self):
        self.blocks: list[Block] = []
        self._open: list[tuple[str, tuple[str, ...]]] = []
        self._parts: list[str] = []
        self._linked = 0
        self._links = 0

    def text(self, text: str) -> None:
        if text:
            self._parts.append(text)
            if self._links:
                self._linked += len(text)

    def end_block(self) -> None:
        if self._parts:
            raw = "".join(self._parts)
            text = " ".join(html.unescape(raw).split())
            if text:
                path = tuple(name for _, names in self._open for name in names)
                self.blocks.append(Block(text, path, min(1.0, self._linked / len(raw))))
        self._parts, self._linked = [], 0

    def open(self, tag: str, attributes: str) -> None:
        if tag in _SPACED:
            self._parts.append(" ")
            return
        if tag in INLINE:
            self._links += tag == "a"
            return
        self.end_block()
        if tag in VOID:
            return
        if tag in _ENDS_PARAGRAPH:
            self._close_within("p")
        if tag in CLOSES_ITSELF and self._open and self._open[-1][0] == tag:
            self._open.pop()
        words = [w for found in _NAMES.findall(attributes) for w in _NAME.findall("".join(found).lower())] if attributes else []
        self._open.append((tag, (tag, *(f".{w}" for w in words))))

    def close(self, tag: str) -> None:
        if tag in INLINE:
            if tag == "a":
                self._links = max(0, self._links - 1)
            return
        self.end_block()
        if any(name == tag for name, _ in self._open):
            while self._open.pop()[0] != tag:
                pass
            self._links = 0

    def _close_within(self, tag: str) -> None:
        if self._open and self._open[-1][0] == tag:
            self._open.pop()


def leaf_blocks(page: str) -> list[Block]:
    """Texts between block elements, in page order; character references decoded, white space one space."""
    reader = _Reader()
    done = 0
    for found in _MARKUP.finditer(page):
        reader.text(page[done : found.start()])
        done = found.end()
        tag = found[3]
        if tag is None:
            if found[1]:
                reader.end_block()
        elif found[2]:
            reader.close(tag.lower())
        else:
            reader.open(tag.lower(), found[4])
    reader.text(page[done:])
    reader.end_block()
    return reader.blocks
