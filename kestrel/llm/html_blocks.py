"""Text blocks of an HTML page, in page order, each with its tag path."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

# fixed values: how HTML elements behave
DROPPED = ("script", "style", "noscript", "template", "svg", "iframe", "object")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr b bdi bdo big br button cite code data del dfn em font i img input ins kbd label mark q s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
# an opening tag ends an open element of the listed kinds, up to the listed containers
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table", "tbody", "thead", "tfoot")),
    "td": (("td", "th"), ("tr",)),
    "th": (("td", "th"), ("tr",)),
    "option": (("option",), ("select",)),
}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(DROPPED) + r")\b[^>]*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z][^>]*+(?:>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|(?P<text>[^<]++|<)",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Block(NamedTuple):
    text: str  # references decoded, white space turned into single blanks, trimmed
    path: tuple[str, ...]  # tags from the root, each with the words of its class, id and role as ``.word``, once each; the innermost tag and its words again at the end
    linked: float  # share of the text that stands in links


def _names(attrs: str) -> tuple[str, ...]:
    if "=" not in attrs:
        return ()
    return tuple(f".{w.lower()}" for m in _NAMES.finditer(attrs) for w in _PART.findall(m[1] or m[2] or m[3] or ""))


def blocks(page: str) -> list[Block]:
    """Leaf blocks: runs of text that no block-level tag interrupts. Unclosed and misnested tags are tolerated.

    Work per tag does not grow with the depth of nesting: the open tags and names are counted as they open and close.
    """
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    block_tags: list[tuple[str, tuple[str, ...]]] = []  # those of the stack that are no inline tags
    opened: dict[str, int] = {}  # open tags, inline ones too
    on_path: dict[str, int] = {}  # block tags and their names, in the order of opening
    parts: list[str] = []
    where: tuple[str, ...] | None = None
    links = total = 0

    def flush():
        nonlocal where, links, total
        if where is not None:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, where, links / max(total, 1)))
        parts.clear()
        where, links, total = None, 0, 0

    def count(counts, name, step) -> None:
        counts[name] = counts.get(name, 0) + step
        if not counts[name]:
            del counts[name]

    def enter(tag, names, step) -> None:
        count(opened, tag, step)
        if tag not in INLINE:
            for x in (tag, *names):
                count(on_path, x, step)

    def close(kinds, stops) -> None:
        if not any(x in opened for x in kinds):
            return
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in kinds:
                for tag, names in reversed(stack[k:]):
                    enter(tag, names, -1)
                    if tag not in INLINE:
                        block_tags.pop()
                del stack[k:]
                return
            if stack[k][0] in stops:
                return

    for m in _TOKEN.finditer(page):
        text = m["text"]
        if text is not None:
            if where is None and not text.isspace():
                where = (*on_path, *(x for tag, names in block_tags[-1:] for x in (tag, *names)))
            parts.append(text)
            n = len(text.strip())
            total += n
            links += n if "a" in opened else 0
            continue
        tag = m["tag"]
        if tag is None:
            if m["raw"]:
                parts.append(" ")
            continue
        tag = tag.lower()
        if tag not in INLINE:
            flush()
        elif tag == "br":
            parts.append(" ")
        if m["end"]:
            # an inline end tag does not reach beyond its block
            close((tag,), tuple(t for t, _ in block_tags[-1:]) if tag in INLINE else ())
        elif tag not in VOID:
            if tag not in INLINE:
                close(("p",), ("table", "td", "button", "li", "div", "section", "article"))
            if tag in ENDS:
                close(*ENDS[tag])
            stack.append((tag, _names(m["attrs"])))
            enter(*stack[-1], 1)
            if tag not in INLINE:
                block_tags.append(stack[-1])
    flush()
    return out
