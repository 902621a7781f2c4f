"""HTML to leaf blocks: text runs between block-level tags, with their tag path."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<svg(?=[\s/])(?:[^>\"']|\"[^\"]*\"|'[^']*')*/>"
    r"|<(script|style|noscript|template|svg|iframe|textarea|select|title)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][\w:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|[^<]+|<", re.S | re.I)
NAMES = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
PARTS = re.compile(r"[A-Za-z]+|\d+")
# fixed values of HTML: elements inside a line of text, and elements without an end tag
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby "
                   "s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: a start tag of the key ends an open element of the values that is nearer than the nearest of STOPS
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 "
                   "h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
P = frozenset("p")
STOPS = frozenset("ul ol dl table body html article section div td th main aside nav form".split())


class Block(NamedTuple):
    path: tuple[str, ...]      # labels of the open elements, outermost first
    text: str
    link_chars: int            # characters inside links


def _labels(name: str, attributes: str) -> tuple[str, ...]:
    if "=" not in attributes:
        return (name,)
    return (name, *(f"{kind[0].lower()}.{part.lower()}" for kind, *values in NAMES.findall(attributes)
                    for part in PARTS.findall(" ".join(values))))


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks of a page in order; head, scripts, styles, form fields and comments have none."""
    out: list[Block] = []
    stack: list[str] = []                    # names of the open elements
    paths: list[tuple[str, ...]] = [()]      # their labels, all the way down
    run: list[str] = []
    links = 0
    anchors = 0
    path: tuple[str, ...] = ()

    def flush() -> None:
        nonlocal links
        if run:
            text = "".join(run)
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text:
                out.append(Block(path, text, min(links, len(text))))
            run.clear()
        links = 0

    def close(at: int) -> None:
        nonlocal anchors
        closed = stack[at:]
        if not INLINE.issuperset(closed):
            flush()
        anchors -= closed.count("a")
        del stack[at:], paths[at + 1:]

    for m in TOKEN.finditer(page or ""):
        name = m[3]
        if name is None:
            token = m[0]
            if token[0] == "<" and len(token) > 1:
                continue
            if not run:
                if token.isspace() or "head" in stack:
                    continue
                path = paths[-1]
            run.append(token)
            if anchors:
                links += len(token)
            continue
        name = name.lower()
        if m[2]:
            for at in range(len(stack) - 1, -1, -1):
                if stack[at] == name:
                    close(at)
                    break
                if name in INLINE and stack[at] not in INLINE:
                    break
            else:
                if name not in INLINE:
                    flush()
            continue
        if name == "br":
            if run:
                run.append(" ")
            continue
        if name not in INLINE:
            flush()
            if name == "body":
                close(stack.index("head") if "head" in stack else len(stack))
            ended = CLOSES.get(name, P if name in ENDS_P else ())
            for at in range(len(stack) - 1, -1, -1) if ended else ():
                if stack[at] in ended:
                    close(at)
                    break
                if stack[at] in STOPS:
                    break
        if name not in VOID and not m[4].endswith("/"):
            stack.append(name)
            paths.append(paths[-1] + _labels(name, m[4]))
            anchors += name == "a"
    flush()
    return out
