"""A lenient HTML reader: block elements as a tree, and the runs of text in them."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

# What may stand in a tag before its end: quoted values, and anything else but ">". Each
# part is taken once and never given back.
_INSIDE = re.compile(r"(?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+")
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(
    r"[\s\"'/](class|id|role|hidden|aria-hidden|style|data-main)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?",
    re.I,
)
# Elements by how they are read.
BLOCKS = frozenset(
    "html body main article section div nav header footer aside form fieldset p h1 h2 h3 h4 h5 "
    "h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure "
    "figcaption address details summary dialog center menu hgroup search head legend".split()
)
RAW = frozenset("script style title textarea xmp iframe noembed noframes template".split())
HIDDEN = frozenset(
    "noscript svg math select button object video audio canvas datalist map label".split()
)
# An open element of the key ends where one of the values starts.
_ENDS = {
    "p": BLOCKS - {"html", "body"},
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot", "thead"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "head": frozenset(["body"]),
}
_SCOPES = frozenset("table ul ol dl".split())
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I) for name in RAW}


@dataclass
class Node:
    tag: str
    parent: int
    hints: str
    hidden: bool
    label: int | None = None
    runs: list[str] = field(default_factory=list)
    chars: int = 0
    linked: int = 0


@dataclass
class Tree:
    """Nodes in page order, so a parent comes before its children; runs likewise."""

    nodes: list[Node]
    runs: list[tuple[int, str]]


def _attributes(tag: str) -> tuple[str, bool, int | None]:
    hints, hidden, label = [], False, None
    for name, value in _ATTRIBUTE.findall(tag):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            hidden = True
        elif name == "style":
            hidden |= "display:none" in value.replace(" ", "")
        elif name == "data-main":
            label = int(value)
        else:
            hints.append(value)
    return " ".join(hints), hidden, label


class _Tags:
    """Finds tags, comments and declarations, from the front of a page to its end.

    A comment or declaration that is not ended goes on to the end of the page. What
    begins like a tag is none if no ">" follows. A quote that is never closed does not
    count, and neither do the quotes in tags before it, from the one on that ran into it.
    So nothing is read over and over again, whatever the page.
    """

    def __init__(self, page: str) -> None:
        self.page = page
        self.unclosed = -1

    def after(self, at: int) -> tuple[int, int] | None:
        """Begin and end of the first one from ``at`` on."""
        page = self.page
        while (begin := page.find("<", at)) >= 0:
            if page.startswith("<!--", begin):
                end = page.find("-->", begin + 4)
                return begin, len(page) if end < 0 else end + 3
            if page.startswith(("<!", "<?"), begin):
                end = page.find(">", begin)
                return begin, len(page) if end < 0 else end + 1
            if _NAME.match(page, begin):
                end = len(page)
                if begin > self.unclosed:
                    end = _INSIDE.match(page, begin).end()
                    if end < len(page) and page[end] != ">":
                        self.unclosed, end = end, len(page)
                if end == len(page):
                    end = page.find(">", begin)
                return None if end < 0 else (begin, end + 1)
            at = begin + 1
        return None


def read(page: str) -> Tree:
    """The tree of a page; whatever the page, it has a root."""
    nodes = [Node("html", -1, "", False)]
    runs: list[tuple[int, str]] = []
    stack = [0]
    open_now: Counter[str] = Counter()  # open elements but the root, by tag
    parts: list[str] = []
    links = hidden_depth = 0
    hidden_tag = ""

    def flush() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                nodes[stack[-1]].runs.append(text)
                runs.append((stack[-1], text))

    def add(text: str) -> None:
        if text and not hidden_depth:
            text = html.unescape(text)
            parts.append(text)
            size = len(text.strip())
            nodes[stack[-1]].chars += size
            if links:
                nodes[stack[-1]].linked += size

    def pop(depth: int) -> None:
        for i in stack[depth:]:
            open_now[nodes[i].tag] -= 1
        del stack[depth:]

    def close(tag: str) -> None:
        if not open_now[tag]:
            return
        depth = len(stack) - 1
        while nodes[stack[depth]].tag != tag:
            depth -= 1
        pop(depth)

    at, tags = 0, _Tags(page)
    while found := tags.after(at):
        begin, end = found
        add(page[at:begin])
        at = end
        whole = page[begin:end]
        name = _NAME.match(whole)
        if name is None:
            continue  # a comment or a declaration
        tag, ending = name[1].lower(), whole[1] == "/"
        if tag in RAW and not ending:
            end = _RAW_END[tag].search(page, at)
            at = end.end() if end else len(page)
        elif tag in HIDDEN:
            if hidden_depth and tag == hidden_tag:
                hidden_depth += -1 if ending else 1
            elif not hidden_depth and not ending and not whole.endswith("/>"):
                hidden_tag, hidden_depth = tag, 1
        elif hidden_depth and tag not in BLOCKS:
            continue
        elif tag == "a":
            links = 0 if ending else 1
        elif tag in BLOCKS:
            if hidden_depth and hidden_tag not in ("noscript", "object"):
                hidden_depth = 0  # an element like a button holds no blocks: it was not closed
            flush()
            links = 0
            if ending:
                close(tag)
                continue
            for depth in range(len(stack) - 1, 0, -1):
                own = nodes[stack[depth]].tag
                if tag in _ENDS.get(own, ()):
                    pop(depth)
                    break
                if own in _SCOPES or own not in ("p", "li", "dt", "dd", "td", "th", "tr"):
                    break
            hints, hidden, label = _attributes(whole)
            if tag == "html":
                nodes[0].label = label
                continue
            nodes.append(Node(tag, stack[-1], hints, hidden, label))
            stack.append(len(nodes) - 1)
            open_now[tag] += 1
        elif tag == "br":
            parts.append(" ")
        elif tag == "hr":
            flush()
    add(page[at:])
    flush()
    return Tree(nodes, runs)
