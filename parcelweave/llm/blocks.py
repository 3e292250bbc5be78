"""Leaf blocks of an HTML page: the texts between block-level boundaries, with what stands above them."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)            # comment
      | <[!?][^>]*(?:>|\Z)           # declaration
      | <(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>   # tag
      | <(/?)([a-zA-Z][^\s/>]*)([^>]*)(>|\Z)                     # tag with a stray quote, or cut off
      | [^<]+ | <""",
    re.S | re.X,
)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[a-z]+")

# Element kinds of HTML, fixed values.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr img".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
IN_HEAD = frozenset("html head base basefont bgsound link meta noframes noscript script style template title".split())
TO_END = frozenset("script style title textarea iframe".split())
UNSEEN = frozenset("script style template noscript iframe object svg title textarea".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)


@dataclass
class Block:
    """A text with the tags and the class, id and role words above it."""

    text: str
    tags: frozenset[str]
    names: frozenset[str]
    parent: str
    linked: float
    place: int = field(default=0)


def leaf_blocks(page: str) -> list[Block]:
    """The non-empty leaf blocks of a page in order; whatever is malformed is read as browsers would."""
    stack: list[tuple[str, frozenset[str]]] = []
    tags: Counter = Counter()
    names: Counter = Counter()
    out: list[Block] = []
    pieces: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(pieces)).split()) if pieces else ""
        if text:
            parent = next((t for t, _ in reversed(stack) if t not in INLINE), "")
            out.append(Block(text, frozenset(tags), frozenset(names), parent, linked / max(1, sum(map(len, pieces))), len(out)))
        pieces.clear()
        linked = 0

    def pop() -> str:
        tag, own = stack.pop()
        for counter, keys in ((tags, (tag,)), (names, own)):
            for key in keys:
                counter[key] -= 1
                if not counter[key]:
                    del counter[key]
        return tag

    def leave_head() -> None:
        while pop() != "head":
            pass

    unclosed: set[str] = set()
    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.match(page, at)
        at = m.end()
        piece = m.group()
        if piece[0] != "<" or piece == "<":
            if "head" in tags and not piece.isspace():
                leave_head()
            pieces.append(piece)
            if "a" in tags:
                linked += len(piece)
            continue
        tag = (m.group(2) or m.group(5) or "").lower()
        if not tag or m.group(7) == "":
            continue
        if tag not in INLINE:
            flush()
        if m.group(1) or m.group(4):
            if tag in tags:
                while pop() != tag:
                    pass
            continue
        if tag not in IN_HEAD and "head" in tags:
            leave_head()
        if tag in UNSEEN:
            if tag in unclosed or tag == "svg" and piece.endswith("/>"):
                continue
            close = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            if close:
                at = close.end()
            elif tag in TO_END:
                at = end
            else:
                unclosed.add(tag)
            continue
        if tag in VOID:
            continue
        if tag in CLOSES_P and "p" in tags:
            while pop() != "p":
                pass
        closed = CLOSES.get(tag)
        while closed and stack and (stack[-1][0] in closed or stack[-1][0] in INLINE and any(t in closed for t in tags) and _near(stack, closed)):
            pop()
        own = frozenset(
            f"{part}" for a in _NAMED.finditer(m.group(3) or m.group(6) or "") for part in _PART.findall((a.group(2) or a.group(3) or a.group(4) or "").lower())
        )
        stack.append((tag, own))
        tags[tag] += 1
        names.update(own)
    flush()
    return out


def _near(stack: list[tuple[str, frozenset[str]]], closed: set[str]) -> bool:
    """Whether only inline elements are open inside the nearest element of ``closed``."""
    for tag, _ in reversed(stack):
        if tag in closed:
            return True
        if tag not in INLINE:
            return False
    return False
