"""Leaf blocks of web pages, in page order, with their ancestors and texts."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

#: A comment, a declaration, or a tag with its attributes; anything else is text.
MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|style|aria-hidden|itemprop)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
NAME_PART = re.compile(r"[a-z]+|[A-Z][a-z]*")

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript iframe template svg math object textarea title noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header "
    "hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul button label".split()
)
#: An opening tag ends open elements of these kinds, up to the nearest of the second set.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select", "optgroup"}),
}
INLINE_KEPT = BLOCK | RAW | {"a"}


class Node:
    """An open element: its tag, its tag with its names, and the element around it. Blocks share them."""

    __slots__ = ("above", "name", "score", "seen", "tag")

    def __init__(self, above: Node | None, tag: str, name: str):
        self.above, self.tag, self.name = above, tag, name
        self.score = self.seen = None  # of whoever weighs the path


@dataclass
class Block:
    """Text of one leaf block with the innermost element around it."""

    node: Node | None
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""

    @property
    def path(self) -> tuple[str, ...]:
        """The elements around the block, outermost first."""
        out, node = [], self.node
        while node is not None:
            out.append(node.name)
            node = node.above
        return tuple(reversed(out))


def _names(attributes: str) -> str:
    """An element's class, id and role words, and whether it is hidden, as one string of features."""
    out = []
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("hidden", "aria-hidden") and value.lower() != "false" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            out.append("hidden")
        elif name in ("class", "id", "role", "itemprop"):
            out += [w.lower() for w in NAME_PART.findall(value)]
    return " ".join(out)


def leaf_blocks(page: str) -> list[Block]:
    """All blocks with text, in page order.

    Block-level tags end a block, other tags do not; a line break is white
    space. Unclosed elements end as the element kinds above say. Scripts,
    styles and the like have no text. The work is linear in the page, however
    deep its elements nest.
    """
    stack: list[Node] = []
    open_tags: Counter[str] = Counter()
    blocks: list[Block] = []
    current: Block | None = None
    at, size = 0, len(page)

    def cut(k: int) -> None:
        """End the elements from place ``k`` on."""
        for node in stack[k:]:
            open_tags[node.tag] -= 1
        del stack[k:]

    def close(tag: str) -> None:
        if open_tags[tag]:
            k = len(stack) - 1
            while stack[k].tag != tag:
                k -= 1
            cut(k)

    while at < size:
        found = MARKUP.search(page, at)
        stop = found.start() if found else size
        if stop > at:
            piece = page[at:stop]
            if current is None and not piece.isspace():
                current = Block(stack[-1] if stack else None)
                blocks.append(current)
            if current is not None:
                text = html.unescape(piece) if "&" in piece else piece
                current.parts.append(text)
                if open_tags["a"]:
                    current.linked += len(text)
        if found is None:
            break
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        if found[1] or found[4]:
            if tag in BLOCK:
                current = None
            close(tag)
            continue
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>]|\\Z)", re.I).search(page, at)
            at = page.find(">", end.end()) + 1 or size if end else size
            continue
        if tag == "br" and current is not None:
            current.parts.append(" ")
        if tag in BLOCK:
            current = None
            if open_tags["p"]:
                close("p")
            elif tag in ENDS and any(open_tags[t] for t in ENDS[tag][0]):
                own, limit = ENDS[tag]
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k].tag in own:
                        cut(k)
                        break
                    if stack[k].tag in limit:
                        break
        if tag not in VOID and tag in INLINE_KEPT:
            stack.append(Node(stack[-1] if stack else None, tag, f"{tag} {_names(found[3] or found[6] or '')}".strip()))
            open_tags[tag] += 1
    out = []
    for block in blocks:
        block.text = " ".join("".join(block.parts).split())
        if block.text:
            out.append(block)
    return out
