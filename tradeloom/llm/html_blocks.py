"""Web pages as sequences of leaf blocks: a tolerant scanner for tags, paths and texts.

A block is the text between two places where a block element begins or ends. Inline elements and line breaks stay inside
their block. Comments are skipped, and raw elements (scripts, styles) up to their end tag. Elements that hold no text to
read (drawings, lists to choose from, templates) are skipped with all they hold; of one that is never closed only the start
tag is, and the page goes on. Formulas and what stands in an object are read as text. Missing end tags are supplied where a
new element implies them; end tags that match nothing are dropped.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

#: Element names of HTML.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data dfn em font i img ins kbd label mark q rb rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr del".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title head iframe".split())
SKIPPED = frozenset("noscript template svg select".split())
#: An element that begins ends these open ones, if no container lies between.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",),
}
CONTAINERS = frozenset("ul ol dl table tbody thead tfoot div section article main aside nav header footer body html form".split())

_TAG = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"']|["'])*?)(?:>|\Z)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAMES = re.compile(r"[a-z]+")


@dataclass
class Block:
    """A leaf: its path (one tuple of names per open element: the tag, then words of class, id and role), text, and how
    many characters of it stand in links."""

    path: tuple[tuple[str, ...], ...]
    text: str
    linked: int


def _names(tag: str, attributes: str) -> tuple[str, ...]:
    names = [tag]
    if "=" in attributes or "hidden" in attributes:
        for name, *values in _ATTRIBUTE.findall(attributes):
            name = name.lower()
            if name in ("class", "id", "role"):
                names += [f".{w}" for w in _NAMES.findall("".join(values).lower())]
            elif name == "hidden":
                names.append(".hidden")
    return tuple(names)


def _past(page: str, tag: str, at: int) -> int:
    """Where an element that is skipped and begins before `at` ends, counting those of its kind within it."""
    depth = 1
    for match in re.compile(rf"<!--.*?(?:-->|\Z)|<(/?){tag}(?=[\s/>])[^>]*?(/?)>", re.I | re.S).finditer(page, at):
        if match[1] is None or (match[2] and not match[1]):
            continue
        depth += -1 if match[1] else 1
        if not depth:
            return match.end()
    return at


def blocks(page: str | None) -> list[Block]:
    """The page's blocks that hold text, in order."""
    out: list[Block] = []
    if not page:
        return out
    stack: list[tuple[str, ...]] = []
    held: list[tuple[str, bool]] = []

    def close() -> None:
        if held:
            joined = "".join([t for t, _ in held])
            text = " ".join((html.unescape(joined) if "&" in joined else joined).split())
            if text:
                linked = sum([len(t.strip()) for t, link in held if link])
                out.append(Block(tuple(s for s in stack if s[0] not in INLINE or s[0] == "a"), text, min(linked, len(text))))
            held.clear()

    at, links, size = 0, False, len(page)
    while at < size:
        begin = page.find("<", at)
        if begin < 0:
            held.append((page[at:], links))
            break
        match = _TAG.match(page, begin)
        if match is None:  # a sign, not a tag
            held.append((page[at : begin + 1], links))
            at = begin + 1
            continue
        if begin > at:
            held.append((page[at:begin], links))
        at = match.end()
        if match[2] is None:
            if match[0].startswith("<![CDATA["):
                held.append((html.escape(match[0][9:].removesuffix("]]>")), links))
            continue
        tag, ends = match[2].lower(), bool(match[1])
        if (tag in RAW or tag in SKIPPED) and not ends:
            if tag not in INLINE:
                close()
            if not match[3].rstrip().endswith("/"):
                if tag in SKIPPED:
                    at = _past(page, tag, at)
                    continue
                if tag == "head":  # ends where the body begins, even if its end tag is missing
                    stop = re.compile(r"</head\s*>|(?=<body\b)", re.I).search(page, at)
                else:
                    stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                # A script or style that is never closed is all there is left; other elements are taken as empty.
                at = stop.end() if stop else (size if tag in ("script", "style") else at)
            continue
        if tag == "br":
            held.append((" ", False))
            continue
        if tag not in INLINE:
            close()
        if ends:
            places = [i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag]
            if places:
                cut = places[0]
                # An inline end tag does not end the blocks around it.
                if tag not in INLINE or all(s[0] in INLINE for s in stack[cut:]):
                    del stack[cut:]
        elif tag not in VOID:
            if tag not in INLINE:
                ended = ENDS.get(tag, ()) + (("p",) if tag not in ENDS else ())
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in ended:
                        del stack[i:]
                        if stack and tag in ("tr",):
                            continue
                        break
                    if stack[i][0] in CONTAINERS:
                        break
            if not match[3].rstrip().endswith("/"):
                stack.append(_names(tag, match[3]))
        links = any([s[0] == "a" for s in stack])
    close()
    return out
