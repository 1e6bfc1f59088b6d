"""Blocks of text in an HTML page, each with the zone of the page that it lies in."""

from __future__ import annotations

import re
from html import unescape

# Element names and the words in class names, ids and roles that tell their part.
BLOCK = set(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary "
    "table tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CHROME_TAGS = set("aside dialog footer form head menu nav button".split())
CHROME_ROLES = set(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
CHROME_WORDS = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "commentlist consent cookie cookies disqus footer gdpr login masthead menu menus modal nav navbar "
    "navigation newsletter notice overlay pager pagination popup promo promotion recommended related "
    "replies reply respond share sharing sidebar signup social sponsor sponsored subscribe subscription "
    "toolbar topbar widget widgets".split()
)
CONTENT_WORDS = set("article content entry post story".split())
READER_WORDS = set("comment comments reply replies".split())
NEGATIONS = ("has-", "no-", "with-", "without-", "has_", "no_", "with_", "is-", "js-")

ARTICLE, MAIN, CONTENT, NEUTRAL, CHROME = range(5)

#: What is left out with its contents: text without markup, and elements that may nest.
RAW = set("script style textarea title iframe".split())
NESTED = set("noscript template svg select object math audio video canvas".split())

# Quotes count after = only, as browsers have it; a tag whose quote never ends is cut at the first >.
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)"
    r"((?:[\s/]++|=?[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'>][^\s>]*+)?+)?+|=)*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
_RAW_TAG = {tag: re.compile(rf"<(/?){tag}(?=[\s/>])[^>]*>", re.I) for tag in RAW}
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in RAW}
#: A slash that is no part of a value.
_SELF_CLOSED = re.compile(r"(?:^|[\s\"'])[^\s\"'=/]*/+\s*$")
#: A whole attribute: what stands inside a value is not looked at.
_ATTRIBUTE = re.compile(r"([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?")
#: Words that make a class name a phrase of the page's own topic.
_SMALL_WORDS = set("a an and at by for from in of on or the to with".split())
_LONGEST_NAME = 4
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


def _zone(tag: str, attributes: str, outer: int) -> int:
    """The zone of an element within one of zone `outer`."""
    if outer == CHROME or tag in CHROME_TAGS:
        return CHROME
    names: list[str] = []
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), "".join(values)
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return CHROME
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return CHROME
        if name == "role":
            if value.lower() in CHROME_ROLES:
                return CHROME
            if value.lower() in ("main", "article"):
                outer = min(outer, MAIN)
        if name in ("class", "id"):
            names += [n for n in value.split() if not n.lower().startswith(NEGATIONS)]
    words: set[str] = set()
    for n in names:
        own = [w.lower() for w in _WORD.findall(n)]
        if len(own) <= _LONGEST_NAME and _SMALL_WORDS.isdisjoint(own):
            words.update(own)
    if tag == "article":
        return CHROME if words & READER_WORDS else ARTICLE
    if tag == "main":
        return min(outer, MAIN)
    if tag in ("html", "body"):
        return outer
    if tag == "header" and outer > CONTENT:
        return CHROME
    if words & CHROME_WORDS or ("header" in words and outer > CONTENT):
        return CHROME
    return min(outer, CONTENT) if words & CONTENT_WORDS else outer


def _raw_end(html: str, tag: str, attributes: str, at: int) -> int:
    """Where an element of raw text ends whose opening tag ends at `at`; there, if it is empty or never closed."""
    closed = bool(_SELF_CLOSED.search(attributes))
    if tag in ("script", "style") and not closed:
        end = _RAW_END[tag].search(html, at)
        return end.end() if end else len(html)
    if closed and tag not in ("script", "style"):
        return at
    following = _RAW_TAG[tag].search(html, at)
    return following.end() if following and following[1] else at


def _tags(html: str) -> list[tuple[int, int, str, str, str]]:
    """(start, end, slash, name, attributes) of all markup; elements left out are one piece without a name."""
    found: list[tuple[int, int, str, str, str]] = []
    opened: dict[str, list[int]] = {}
    ends: dict[int, int] = {}
    at = 0
    while match := _MARKUP.search(html, at):
        at = match.end()
        tag = (match[2] or match[5] or "").lower()
        closing, attributes = match[1] or match[4] or "", match[3] or match[6] or ""
        if tag in RAW | NESTED and attributes[:1].strip("/ \t\n\r\f"):
            tag += "-"  # a longer name
        if tag in RAW:
            at = at if closing else _raw_end(html, tag, attributes, at)
            tag = ""
        elif tag in NESTED:
            if closing:
                if opened.get(tag):
                    ends[opened[tag].pop()] = len(found)
            elif not _SELF_CLOSED.search(attributes):
                opened.setdefault(tag, []).append(len(found))
            tag = ""
        found.append((match.start(), at, closing, tag, attributes))
    pieces, i = [], 0
    while i < len(found):
        last = ends.get(i, i)
        pieces.append((found[i][0], found[last][1], *found[i][2:]))
        i = last + 1
    return pieces


def _is_closed(tags: list[tuple[int, int, str, str, str]], after: int, name: str) -> bool:
    """Whether an element of this name that is open at tag number `after` has an end tag further on."""
    depth = 1
    for _, _, closing, tag, _ in tags[after + 1 :]:
        if tag == name:
            depth += -1 if closing else 1
            if not depth:
                return True
    return False


def blocks(html: str) -> list[tuple[int, str]]:
    """(zone, text) of every block with text, in page order; references decoded, spaces single.

    An article in chrome is chrome, such as a related card in a sidebar, unless the chrome element was
    left open, or the page has no other text.
    """
    tags = _tags(html)
    found = _blocks(html, tags, False)
    if found and all(zone == CHROME for zone, _ in found):
        found = _blocks(html, tags, True)
    return found


def _blocks(
    html: str, tags: list[tuple[int, int, str, str, str]], articles_count: bool
) -> list[tuple[int, str]]:
    found: list[tuple[int, str]] = []
    parts: list[str] = []
    stack: list[tuple[str, int]] = [("", NEUTRAL)]

    def flush() -> None:
        text = " ".join(unescape("".join(parts)).split())
        if text:
            found.append((stack[-1][1], text))
        parts.clear()

    at = 0
    for number, (start, end, closing, tag, attributes) in enumerate(tags):
        if start > at:
            parts.append(html[at:start])
        at = end
        if not tag:
            continue
        if tag == "br":
            parts.append(" ")
            continue
        is_block = tag in BLOCK
        if closing:
            if not is_block and tag != stack[-1][0]:
                continue
            flush()
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    del stack[depth:]
                    break
                if stack[depth][0] in ("article", "main") and tag not in ("article", "main", "body", "html"):
                    break
            continue
        if is_block:
            flush()
            if stack[-1][0] in ("p", "li", "td", "th", "dd", "dt", "button", "span", "a"):
                if stack[-1][0] != "li" or tag == "li":
                    stack.pop()
        outer = stack[-1][1]
        if tag in ("article", "main") and outer == CHROME:
            around = next(name for name, zone in stack if zone == CHROME)
            if articles_count or not _is_closed(tags, number, around):
                outer = NEUTRAL
        zone = _zone(tag, attributes, outer)
        if tag in VOID:
            continue
        if is_block and tag not in ("p", "li", "td", "th", "dd", "dt", "tr"):
            stack.append((tag, zone))
        elif zone != outer:  # a small element counts only where it differs
            flush()
            stack.append((tag, zone))
    if at < len(html):
        parts.append(html[at:])
    flush()
    return found


def best_zone(found: list[tuple[int, str]]) -> int:
    """The innermost zone that the page has text in; NEUTRAL if it names none."""
    return min((zone for zone, _ in found if zone < NEUTRAL), default=NEUTRAL)
