"""Leaf blocks of an html page: their text and the path of elements above them.

A small tolerant reader: comments, scripts and styles are skipped, unclosed
paragraphs and list items end where html says, inline elements do not cut a
block, character references are decoded, white space becomes one space.
"""

from __future__ import annotations

import html as html_entities
import re
from typing import NamedTuple

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']+|"[^"]*"|'[^']*')*+)>"""
    r"""|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)""", re.S)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Fixed values of html.
SKIPPED = frozenset("script style template svg math".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe ins label legend li main menu nav noscript "
    "object ol optgroup option p pre section select summary table tbody td textarea tfoot th thead title tr ul".split())
# A start tag on the left ends an open element on the right, up to the barrier.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"})}


class Block(NamedTuple):
    path: tuple[str, ...]
    text: str
    linked: float


def names_of(tag: str, attrs: str) -> str:
    """An element as its tag and the word parts of its class, id and role."""
    found = [p.lower() for v in NAMES.findall(attrs) for p in PARTS.findall(v)] if attrs else []
    return " ".join([tag, *found])


def blocks_of(page: str | None) -> list[Block]:
    """Blocks with a text, in page order."""
    out: list[Block] = []
    if not page:
        return out
    stack: list[tuple[str, str]] = []
    held: list[str] = []
    links = linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            held.append(html_entities.unescape(raw) if "&" in raw else raw)
            if links:
                linked += len(raw)

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join("".join(held).split())
            if text:
                out.append(Block(tuple(n for _, n in stack), text, min(1.0, linked / len(text))))
            held.clear()
        linked = 0

    def close(tags: set, barrier: set) -> None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in tags:
                del stack[k:]
                return
            if stack[k][0] in barrier:
                return

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        if m["end"] or m["end2"]:
            if tag == "a":
                links = 0
            elif tag in BLOCKS:
                flush()
                if any(t == tag for t, _ in stack):
                    close({tag}, set())
            continue
        attrs = m["attrs"] or m["attrs2"] or ""
        if tag in SKIPPED:
            if not attrs.endswith("/"):
                stop = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = stop.end() if stop else end
        elif tag == "br":
            held.append(" ")
        elif tag == "a":
            links = 1
        elif tag in BLOCKS:
            flush()
            close({"p"}, BLOCKS - {"p"})
            if tag in ENDS:
                close(*ENDS[tag])
            if tag not in VOID:
                stack.append((tag, names_of(tag, attrs)))
    flush()
    return out
