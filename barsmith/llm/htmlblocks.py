"""Leaf blocks of an HTML page, with their tag paths.

A block is the text between two block-level boundaries. Inline markup does not
break a block and ``br`` is white space. Omitted end tags are implied as in
HTML: a block-level start tag ends an open ``p``, a list item or table cell
ends its sibling, and an end tag closes whatever is open inside its element.
Of the hidden elements only raw text runs to the end of the page if unclosed;
an unclosed button, list of choices, object or drawing ends at the next
block-level tag.
Scripts, styles, comments, the head's title and the choices and contents of
form controls are not text.

Work and memory grow with the page's length: open elements are found by their
name, an end tag that a hidden element lacks is looked for once, and a path of
more than ``PATH_HEAD + PATH_TAIL`` parts keeps the outermost and innermost.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

#: Element kinds of the HTML standard.
HIDDEN = {"script", "style", "template", "textarea", "select", "title", "svg", "math", "iframe",
          "object", "noframes", "datalist", "button"}
#: Hidden elements that hold markup, and those of them that cannot hold themselves.
MARKUP = {"button", "select", "datalist", "object", "svg", "math"}
SINGLE = {"button", "select", "datalist"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details",
         "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
         "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li",
         "main", "menu", "nav", "noscript", "ol", "p", "pre", "section", "summary", "table", "tbody",
         "td", "tfoot", "th", "thead", "tr", "ul"}
#: A start tag ends an open sibling of these names, looking no further than the last set.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}),
            "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
            "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
            "option": ({"option"}, {"select"})}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?([A-Za-z][^\s/>]*)"
                    r"((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_MARK = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_BLOCK_TAG = re.compile(rf"</?(?:{'|'.join(sorted(BLOCK))})(?=[\s/>])", re.I)
_PART = re.compile(r"[A-Za-z]+")

#: Parts of a long path that are kept: from its outer and from its inner end.
PATH_HEAD, PATH_TAIL = 16, 48


@dataclass
class Block:
    text: str
    path: tuple[str, ...]
    linked: int       # characters inside links


def _marks(attrs: str) -> tuple[str, ...]:
    """Words of an element's class, id and role."""
    if "=" not in attrs:
        return ()
    return tuple("." + w.lower() for m in _MARK.finditer(attrs)
                 for w in _PART.findall(m[2] or m[3] or m[4] or ""))


def _path(stack: list[tuple[str, tuple[str, ...]]]) -> tuple[str, ...]:
    """Tags and marks of the open elements, outermost first."""
    if len(stack) + sum(len(marks) for _, marks in stack[:PATH_HEAD + PATH_TAIL]) <= PATH_HEAD + PATH_TAIL:
        return tuple(x for tag, marks in stack for x in (tag, *marks))
    outer = [x for tag, marks in stack[:PATH_HEAD] for x in (tag, *marks)][:PATH_HEAD]
    inner = [x for tag, marks in stack[-PATH_TAIL:] for x in (tag, *marks)][-PATH_TAIL:]
    return tuple(outer + inner)


def _end_tag(page: str, tag: str, at: int, known: dict[str, tuple[int, int]]) -> tuple[int, int] | None:
    """Begin and end of the next end tag of this name. ``known`` has the last answer by name."""
    if tag not in known or known[tag][0] < at:
        m = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
        known[tag] = m.span() if m else (len(page) + 1, len(page))
    return known[tag] if known[tag][0] <= len(page) else None


def _hidden_end(page: str, tag: str, at: int, known: dict[str, tuple[int, int]]) -> int:
    """Where a hidden element ends whose start tag ends at ``at``."""
    done = _end_tag(page, tag, at, known)
    end = done[1] if done else len(page)
    if tag not in MARKUP:
        return end
    again = re.compile(rf"<{re.escape(tag)}(?=[\s/>])", re.I).search(page, at, end) if tag in SINGLE else None
    if done and not again:
        return end
    block = _BLOCK_TAG.search(page, at, again.start() if again else end)
    return block.start() if block else again.start() if again else end


def blocks_of(page: str | None) -> list[Block]:
    """The page's blocks with text, in order."""
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    places: dict[str, list[int]] = {}    # where in the stack each name is open
    blocks: list[int] = []               # where block-level elements are
    known: dict[str, tuple[int, int]] = {}
    pieces: list[str] = []
    linked = links = at = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                out.append(Block(text, _path(stack), min(linked, len(text))))
            pieces.clear()
        linked = 0

    def close(i: int) -> None:
        nonlocal links
        while len(stack) > i:
            tag, _ = stack.pop()
            places[tag].pop()
            links -= tag == "a"
            if blocks and blocks[-1] == len(stack):
                blocks.pop()

    def last(names: set[str]) -> int:
        return max((places[x][-1] for x in names if places.get(x)), default=-1)

    def find(names: set[str], stop: set[str]) -> int | None:
        i = last(names)
        return i if i >= 0 and i >= last(stop) else None

    while at < len(page):
        m = _TOKEN.search(page, at)
        end = m.start() if m else len(page)
        if end > at:
            pieces.append(page[at:end])
            if links:
                linked += end - at
        if not m:
            break
        at = m.end()
        if m[1] is None:
            continue
        tag = m[1].lower()
        block = tag in BLOCK
        if page[m.start() + 1] == "/":
            i = find({tag}, set())
            if block:
                flush()
            if i is not None and (block or not blocks or blocks[-1] < i):
                close(i)
            continue
        if tag in HIDDEN and not m[2].rstrip().endswith("/"):
            at = _hidden_end(page, tag, at, known)
            pieces.append(" ")
            continue
        if block:
            flush()
            i = find({"p"}, {"table", "button", "div", "section", "article", "td", "li"})
            if i is not None:
                close(i)
            if tag in SIBLINGS and (i := find(*SIBLINGS[tag])) is not None:
                close(i)
        if tag == "br":
            pieces.append(" ")
        if tag not in VOID and not m[2].endswith("/"):
            places.setdefault(tag, []).append(len(stack))
            if block:
                blocks.append(len(stack))
            stack.append((tag, _marks(m[2])))
            links += tag == "a"
    flush()
    return out
