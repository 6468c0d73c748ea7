"""Text lines of an HTML page, each with what its markup says about it."""

from __future__ import annotations

import html
import re
from typing import NamedTuple
from urllib.parse import urlsplit


class Line(NamedTuple):
    text: str
    # inside menus, headers, footers, sidebars, notices, adverts, forms or comments by tag, role or class
    aside: bool
    # inside an article, or inside main: 2, 1, 0
    body: int


# HTML's elements by what they do to text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
UNSEEN = frozenset("head svg math canvas object audio video select datalist button map".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody "
    "tfoot thead tr ul".split()
)
CELLS = frozenset(("td", "th"))
# a start tag closes these open ones, up to the nearest element that holds them
CLOSES = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu", "dir"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "tr": (frozenset(("tr", "td", "th")), frozenset(("table",))),
    "td": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "th": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "option": (frozenset(("option",)), frozenset(("select", "datalist"))),
}
# p ends at any block, but not across these
_P_HOLDERS = frozenset("article aside blockquote body button caption dd details div dl fieldset figcaption figure footer form header li main nav section table td th".split())
ASIDE_TAGS = frozenset("nav footer aside form dialog menu search fieldset".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar note".split())
# words in a class or id
LAYOUT_WORDS = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs header masthead topbar footer bottombar sidebar aside rail "
    "toolbar pagination pager toc skip".split()
)
EXTRA_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent "
    "gdpr notice notices popup modal overlay newsletter subscribe subscription signup login search share sharing social "
    "related recommended recommendations widget comment comments disqus reply replies respond copyright disclaimer".split()
)
# such a word too makes a layout word part of a name like "content-with-sidebar"
BODY_WORDS = frozenset("content main article post entry story wrapper container layout page body site".split())
_KEEPS_CLASS = frozenset(("html", "body", "main"))

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?", re.S)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _is_aside(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in ASIDE_TAGS or (tag == "header" and not in_article):
        return True
    if not attributes.strip():
        return False
    values = {n.lower(): html.unescape(a or b or c) for n, a, b, c in _ATTRIBUTE.findall(attributes)}
    if values.get("role", "").lower() in ASIDE_ROLES or "hidden" in values or values.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none", values.get("style", ""), re.I):
        return True
    if tag in _KEEPS_CLASS:
        return False
    words = {w.lower() for w in _WORD.findall(f"{values.get('class', '')} {values.get('id', '')}")}
    if words & EXTRA_WORDS:
        return True
    return bool(words & LAYOUT_WORDS) and not words & BODY_WORDS and not (tag in ("article", "header") or tag[0] == "h" and tag[1:].isdigit())


def lines_of(page: str) -> list[Line]:
    """The page's blocks in order, references decoded, white space inside a block made one space; empty ones left out.

    Markup in any state is read: unclosed, misnested and cut-off tags included.  A line break inside a block is white space.
    """
    out: list[Line] = []
    # open elements: name, aside, article or main
    stack: list[tuple[str, bool, int]] = [("", False, 0)]
    parts: list[str] = []

    def end_block() -> None:
        text = " ".join("".join(parts).split())
        if text:
            out.append(Line(text, stack[-1][1], stack[-1][2]))
        parts.clear()

    def pop_to(i: int) -> None:
        if any(e[0] in BLOCKS for e in stack[i:]):
            end_block()
        del stack[i:]

    def close_open(names: frozenset, holders: frozenset) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                return pop_to(i)
            if stack[i][0] in holders:
                return None
        return None

    at, size = 0, len(page)
    unseen = 0
    while at < size:
        opened = page.find("<", at)
        found = _MARKUP.match(page, opened) if opened >= 0 else None
        while opened >= 0 and found is None:
            opened = page.find("<", opened + 1)
            found = _MARKUP.match(page, opened) if opened >= 0 else None
        text = page[at:] if found is None else page[at:opened]
        if text and not unseen:
            parts.append(html.unescape(text))
        if found is None:
            break
        at = found.end()
        if found[2] is None:
            continue
        name = found[2].lower()
        if found[1]:
            if name == "p" and not any(e[0] == "p" for e in stack):
                end_block()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name:
                    unseen -= sum(e[0] in UNSEEN for e in stack[i:])
                    pop_to(i)
                    break
            continue
        if name in RAW:
            closing = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = closing.end() if closing else size
            continue
        if name == "br" or name in CELLS or name in ("img", "input", "wbr"):
            parts.append("" if name == "wbr" else " ")
        if name in VOID:
            if name == "hr":
                close_open(frozenset(("p",)), _P_HOLDERS)
                end_block()
            continue
        if name in CLOSES:
            close_open(*CLOSES[name])
        if name == "body":
            # an unclosed head ends here
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == "head":
                    unseen -= sum(e[0] in UNSEEN for e in stack[i:])
                    pop_to(i)
                    break
        if name in BLOCKS:
            close_open(frozenset(("p",)), _P_HOLDERS)
            end_block()
        if found[3].endswith("/") and name not in BLOCKS:
            continue
        _, aside, body = stack[-1]
        aside = aside or _is_aside(name, found[3], body == 2)
        body = 2 if name == "article" else max(body, 1) if name == "main" or 'role="main"' in found[3] else body
        stack.append((name, aside, body))
        unseen += name in UNSEEN
    end_block()
    return out


def place_of(url: str | None) -> tuple[str, str]:
    """Host in lower case and path of a URL; what cannot be read as one has the empty host."""
    try:
        parts = urlsplit((url or "").strip())
        return (parts.hostname or "").lower(), parts.path.rstrip("/")
    except ValueError:
        return "", url or ""
