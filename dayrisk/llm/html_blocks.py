"""HTML as text blocks with what surrounds them: a small tolerant reader used inside tasks."""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title)\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>?",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|hidden|aria-hidden)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt s samp small span strike strong sub sup time tt u var wbr img br input svg math button select label canvas object iframe mi mn mo ms mrow msup msub mfrac msqrt mtext semantics".split())
UNSEEN = frozenset("head script style noscript template iframe object svg canvas audio video map select button datalist option annotation".split())
#: An opening tag ends an open element of the first kind unless one of the second lies between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "option": ({"option"}, {"select"}), "body": ({"head"}, set()),
}


@dataclass(slots=True)
class Element:
    tag: str
    words: frozenset
    number: int
    parent: Element | None
    unseen: bool


@dataclass(slots=True)
class Block:
    """Text between block boundaries, the characters of it inside links, and the element it lies in."""

    text: str
    linked: int
    element: Element


def _element(tag: str, attributes: str, number: int, parent: Element | None) -> Element:
    words: set[str] = set()
    hidden = tag in UNSEEN
    if attributes and "=" in attributes:
        for name, *values in ATTRIBUTE.findall(attributes):
            value = entities.unescape("".join(values)).lower()
            if name.lower() == "aria-hidden":
                continue
            if name.lower() == "role":
                words.add(f"role={value.strip()}")
            words.update(value.split())
    return Element(tag, frozenset(words), number, parent, hidden or bool(parent and parent.unseen))


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in page order; markup that is not closed, or closed twice, is put up with."""
    root = Element("html", frozenset(), 0, None, False)
    stack, blocks, number = [root], [], 0
    pieces: list[str] = []
    linked, links = 0, 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                blocks.append(Block(text, linked, stack[-1]))
            pieces.clear()
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        if raw and not stack[-1].unseen:
            text = entities.unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if links:
                linked += len(text.strip())

    def pop_to(depth: int) -> None:
        nonlocal links
        for gone in stack[depth:]:
            links -= gone.tag == "a"
        del stack[depth:]

    at = 0
    while (found := TOKEN.search(page, at)) is not None:
        say(page[at : found.start()])
        at = found.end()
        closing, tag, attributes = found[2], found[3], found[4]
        if tag is None:
            closing, tag, attributes = found[5], found[6], found[7]
        if tag is None:  # comment, declaration or an element whose content is not markup
            continue
        tag = tag.lower()
        block = tag not in INLINE and not stack[-1].unseen
        if tag in ("br", "td", "th"):
            pieces.append(" ")
            block = False
        if block:
            flush()
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    pop_to(depth)
                    break
                if tag in INLINE and stack[depth].tag not in INLINE:
                    break  # an inline end tag does not end blocks
            continue
        ends, stops = CLOSES.get(tag, ({"p"}, {"button", "table", "td", "th", "object"}) if block else (set(), set()))
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in ends:
                pop_to(depth)
                break
            if stack[depth].tag in stops:
                break
        if tag not in VOID and not attributes.rstrip().endswith("/"):
            number += 1
            stack.append(_element(tag, attributes, number, stack[-1]))
            links += tag == "a"
    say(page[at:])
    flush()
    return blocks
