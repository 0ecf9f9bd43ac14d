"""Text blocks of an HTML page, in page order, with the path of open elements."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

# A quote means something only after an equals sign.
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>\"']?))*+)>|"
    r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
# Elements whose content is no text of the page.
RAW = frozenset("script style title noscript template textarea iframe svg".split())
# A drawing ends with its tag, or where an element begins that none can hold.
DRAWING_END = re.compile(
    r"</svg\b[^>]*>|(?=</?(?:p|br)\b|<(?:blockquote|body|dd|div|dl|dt|h[1-6]|hr|img|li|ol|pre|"
    r"span|strong|table|ul)\b)",
    re.I,
)
# Elements whose names say nothing of where a block is.
WHOLE = frozenset("html body main article".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# Elements that do not end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s "
    "samp small span strike strong sub sup time tt u var wbr input svg math mi mn mo ms mtext mrow "
    "mfrac msup msub msubsup msqrt mroot mover munder mstyle semantics object".split()
)
# What an opening element ends, if it is open: the elements that hold only its like.
ENDS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
    "body": {"head"},
}
# An open element of these is not looked past for one to end.
WALLS = frozenset("table ul ol dl div section article main aside nav body html form".split())


@dataclass
class Block:
    """Text with its white space as written, and names of the elements around it."""

    path: tuple[str, ...]
    text: str
    linked: int

    @property
    def clean(self) -> str:
        return " ".join(self.text.split())


def names_of(tag: str, attributes: str) -> tuple[str, ...]:
    """The tag, and its class, id and role words: tag, .word, #word, =word."""
    names = [tag]
    if "=" in attributes and tag not in WHOLE:
        for key, *values in NAMED.findall(attributes):
            sign = {"class": ".", "id": "#", "role": "="}[key.lower()]
            names += [sign + word.lower() for word in "".join(values).split()]
    return tuple(names)


def blocks(page: str) -> list[Block]:
    """All blocks that hold text."""
    found: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked = links = 0
    at = 0

    def flush() -> None:
        nonlocal linked
        text = "".join(parts)
        parts.clear()
        if text and not text.isspace():
            text = unescape(text)
            if text.split():
                path = tuple(name for _, names in stack for name in names)
                found.append(Block(path, text, linked))
        linked = 0

    def close(depth: int) -> None:
        nonlocal links
        links -= sum(tag == "a" for tag, _ in stack[depth:])
        del stack[depth:]

    while match := TAG.search(page, at):
        if match.start() > at:
            parts.append(page[at : match.start()])
            if links:
                linked += match.start() - at
        at = match.end()
        ending = match[1] or match[4]
        tag = (match[2] or match[5] or "").lower()
        if not tag:
            continue
        if not ending and tag == "svg":
            if not (match[3] or "").endswith("/"):
                end = DRAWING_END.search(page, at)
                at = end.end() if end else at
            continue
        if not ending and tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            if tag not in INLINE:
                flush()
            continue
        if tag not in INLINE:
            flush()
        if ending:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    close(depth)
                    break
                if stack[depth][0] in WALLS and tag in ("p", "li"):
                    break
        elif tag == "br":
            parts.append(" ")
        elif tag not in VOID:
            ends = ENDS.get(tag, set()) | (set() if tag in INLINE else {"p"})
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] in ends:
                    close(depth)
                    break
                if stack[depth][0] in WALLS:
                    break
            stack.append((tag, names_of(tag, match[3] or match[6] or "")))
            links += tag == "a"
    if at < len(page):
        parts.append(page[at:])
    flush()
    return found
