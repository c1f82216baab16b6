"""Leaf blocks of a page: text between block boundaries, with the path of open elements.

The page is read once, in time linear in its length. A ``<`` begins a tag when a name and well-formed
attributes follow; where quotes do not pair, the tag ends at the first ``>`` before the next ``<``; where that is
missing too, or an attribute name begins with a digit (``a <b and 3 > 2``), it is text. Raw elements without an
end tag hide the rest of the page only where that is their rule (script, style).
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

# Element names of the HTML standard.
MATH = frozenset(
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup msubsup "
    "munder mover munderover mmultiscripts mprescripts mtable mtr mtd semantics annotation annotation-xml".split()
)
#: Elements whose content is not text of the page.
HIDDEN = frozenset(
    "script style head template svg iframe noscript object canvas select textarea title annotation annotation-xml".split()
)
INLINE = (
    frozenset(
        "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark picture q rp rt ruby s samp "
        "small source span strike strong sub sup time tt u var wbr".split()
    )
    | MATH
    | (HIDDEN - {"head", "title"})
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What may stand in a head; anything else ends it.
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
#: Elements that end an open drawing.
_ENDS_SVG = frozenset(
    "blockquote body center dd div dl dt em h1 h2 h3 h4 h5 h6 hr li main article section nav aside header footer ol p pre table ul".split()
)
#: An element of the first kind ends an open one of the second kinds.
_CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",),
}
#: Elements a path names at most: where more are open, half of them from the outside, half from the inside.
PATH_ELEMENTS = 64
#: Elements whose content is no markup, up to their end tag.
_RAW = frozenset("script style textarea title iframe noscript".split())
#: Those that hide the rest of the page where the end tag is missing.
_RAW_TO_THE_END = frozenset(("script", "style"))

_NAME = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:-]*+)")
#: A tag whose quoted values hold no angle bracket; a trial ends at the next one.
_PLAIN_TAG = re.compile(
    r"""(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[\s/]++(?:[^\s"'<>/=0-9][^\s"'<>/=]*+(?:\s*+=\s*+(?:"[^"<>]*+"|'[^'<>]*+'|[^\s"'<>]++))?+)?+)*+)>"""
)
_ATTRIBUTE = re.compile(r"""[\s/]*+[^\s"'<>/=0-9][^\s"'<>/=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'<>]++))?+(?=[\s/>])""")
_TAG_END = re.compile(r"[\s/]*+>")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in _RAW}
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z0-9]+")


@dataclass
class Block:
    """Normalised text, path of (element and class words) from the outside in, share of linked characters."""

    text: str
    path: tuple[str, ...]
    linked: float


def _words(rest: str) -> tuple[str, ...]:
    found = (w for m in _NAMED.finditer(rest) for w in _WORD.findall("".join(filter(None, m.groups())).lower()))
    return tuple("." + word for word in found)


class _Scanner:
    """Tags of one page. What a trial learnt of an attribute's place serves all later trials."""

    def __init__(self, page: str) -> None:
        self.page = page
        self.ends: dict[int, int] = {}
        self.without: dict[str, int] = {}

    def tag(self, at: int) -> tuple[bool, str, str, int] | None:
        """(end tag, name, attributes, place after it) of the tag at ``at``, or None where text stands."""
        found = _PLAIN_TAG.match(self.page, at + 1)
        if found:
            return found[1] == "/", found[2].lower(), found[3], found.end()
        found = _NAME.match(self.page, at + 1)
        if not found:
            return None
        end = self._well_formed(found.end())
        if end < 0:
            end = self.find(">", found.end())
            other = self.find("<", found.end())
            rest = self.page[found.end() : end] if 0 <= end and (other < 0 or end < other) else ""
            if '"' not in rest and "'" not in rest:  # only what unpaired quotes spoilt is still a tag
                return None
            end += 1
        return found[1] == "/", found[2].lower(), self.page[found.end() : end - 1], end

    def _well_formed(self, at: int) -> int:
        """The place after the tag whose attributes begin at ``at``; -1 where they are not well-formed."""
        seen = []
        end = -1
        while at not in self.ends:
            seen.append(at)
            closing = _TAG_END.match(self.page, at)
            if closing:
                end = closing.end()
                break
            attribute = _ATTRIBUTE.match(self.page, at) if self.page[at : at + 1].isspace() or self.page[at : at + 1] == "/" else None
            if not attribute:
                break
            at = attribute.end()
        else:
            end = self.ends[at]
        for place in seen:
            self.ends[place] = end
        return end

    def find(self, what: str, at: int) -> int:
        """``str.find`` that does not look again for what is known to be missing from some place on."""
        if at >= self.without.get(what, len(self.page) + 1):
            return -1
        place = self.page.find(what, at)
        if place < 0:
            self.without[what] = at
        return place

    def raw_end(self, name: str, at: int) -> int:
        """The place after the end tag of a raw element, -1 without one."""
        if at >= self.without.get(name, len(self.page) + 1):
            return -1
        found = _RAW_END[name].search(self.page, at)
        if not found:
            self.without[name] = at
            return -1
        end = self.find(">", found.end())
        return end + 1 if end >= 0 else len(self.page)


def leaf_blocks(page: str) -> list[Block]:
    """Non-empty blocks in page order."""
    scan = _Scanner(page)
    stack: list[tuple[str, tuple[str, ...]]] = []
    blocks: list[Block] = []
    parts: list[str] = []
    solid: list[int] = []  # places in the stack of the elements that are not inline
    opened: Counter[str] = Counter()
    linked = 0
    hidden = -1  # place in the stack of the outermost hidden element

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                named = solid if len(solid) <= PATH_ELEMENTS else solid[: PATH_ELEMENTS // 2] + solid[-PATH_ELEMENTS // 2 :]
                path = tuple(name for i in named for name in (stack[i][0], *stack[i][1]))
                blocks.append(Block(text, path, min(1.0, linked / len(text))))
            parts.clear()
        linked = 0

    def close(at: int) -> None:
        nonlocal hidden
        for name, _ in stack[at:]:
            opened[name] -= 1
        del stack[at:]
        while solid and solid[-1] >= at:
            solid.pop()
        if hidden >= at:
            hidden = -1

    def leave_head() -> None:
        """End an open head, with what stands unclosed in it."""
        for i, (name, _) in enumerate(stack):
            if name == "head":
                close(i)
                break

    def put(text: str) -> None:
        nonlocal linked
        if hidden >= 0 and stack[-1][0] == "head" and not text.isspace():
            leave_head()
        if hidden < 0 and text:
            parts.append(html.unescape(text))
            if opened["a"]:
                linked += len(text)

    at = look = 0  # text begins at ``at``; a tag is looked for from ``look`` on
    while True:
        start = page.find("<", look)
        if start < 0:
            break
        mark = page[start + 1 : start + 2]
        if mark in ("!", "?"):
            if page.startswith("<!--", start):
                if page.startswith((">", "->"), start + 4):  # a comment that ends at once
                    after = page.index(">", start) + 1
                else:
                    end = scan.find("-->", start + 4)
                    after = end + 3 if end >= 0 else len(page)
            else:
                end = scan.find(">", start)
                after = end + 1
            if not after:
                look = start + 1
                continue
            if start > at:
                put(page[at:start])
            at = look = after
            continue
        tag = scan.tag(start)
        if tag is None:
            look = start + 1
            continue
        if start > at:
            put(page[at:start])
        ending, name, rest, at = tag
        look = at
        if name == "br":
            put(" ")
            continue
        block = name not in INLINE
        if ending:
            i = len(stack) - 1 if opened[name] else -1
            while i >= 0 and stack[i][0] != name:
                i -= 1
            if block and (hidden < 0 or 0 <= i <= hidden):
                flush()
            if i >= 0:
                close(i)
            continue
        if hidden >= 0:
            outer = stack[hidden][0]
            if outer == "head" and name not in IN_HEAD and not opened["template"]:
                leave_head()
            elif outer == "svg" and name in _ENDS_SVG and not (opened["foreignobject"] or opened["desc"]):
                close(hidden)
        if name in _RAW:
            end = scan.raw_end(name, at)
            if end >= 0 or name in _RAW_TO_THE_END:
                at = look = end if end >= 0 else len(page)
            continue
        if block and hidden < 0:
            flush()
        if name in VOID:
            continue
        if block and solid and solid[-1] > hidden and (stack[solid[-1]][0] == "p" or stack[solid[-1]][0] in _CLOSES.get(name, ())):
            close(solid[-1])
        if not rest.endswith("/") or name == "a":
            stack.append((name, _words(rest) if rest else ()))
            opened[name] += 1
            if block:
                solid.append(len(stack) - 1)
            if hidden < 0 and name in HIDDEN:
                hidden = len(stack) - 1
    if at < len(page):
        put(page[at:])
    flush()
    return blocks
