"""Main text of HTML pages by line-block distribution.

Markup is stripped into lines, one per block element. A line's length counts
its visible characters outside links; lines inside menus, headers, footers,
sidebars, notices, adverts, forms, comments and the like are taken out first.
Lengths are summed over sliding windows of ``WINDOW`` lines: the text surges at
the first line whose sum reaches a bound (a share of the largest one) and
dives after the last such line; from there both points move on over adjoining
lines until the length falls to zero. Everything visible between the two points
is kept. Where the page marks an ``article`` or ``main`` with text in it, that
mark only weighs the lines: a character in it counts ``MARKED`` times, a line
of links in it as one character, and a line outside it not at all. On other
pages the surge point moves to the only ``h1`` if that stands in the first half
of the text it would keep.

A class, id or role marks a part as outside if one of its names is, or starts
with, a word of ``HINTS``; names of several words such as ``with-sidebar`` or
``long-form`` do not. Such a mark is void on an element that holds a marked
article, or most of the page's text.

The scan is linear in the page, whatever is left open. Defined cases: a null
or empty page gives an empty text; unclosed elements end with their parent,
unclosed scripts, styles and comments with the page; a quoted value that is
not closed ends with its tag, an unfinished last tag is no text; repeated pages
are extracted alike; other columns pass through untouched.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

WINDOW = 3
BOUND_SHARE, BOUND_CHARS = 0.1, 80
#: Open elements that an end tag or a block looks back over.
DEEPEST = 256
MARKED = 8

# Fixed values of HTML: elements that end a line, elements without content,
# elements whose content is not text.
BLOCKS = set(
    "address article aside blockquote body br caption center col colgroup dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main "
    "menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea iframe noembed noframes xmp svg math canvas object audio video".split())
# Elements that never belong to an article.
OUTSIDE = set("nav footer aside form head title button select dialog menu search option datalist".split())
# Words in class, id or role that mark such parts.
HINTS = set(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promoted promotion "
    "sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs footer footers masthead topbar toolbar "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "social share sharing related recommended newsletter subscribe subscription signup "
    "login widget widgets pagination pager skip contentinfo complementary search form".split()
)
# Whole names that mark reader comments, however much text they hold.
COMMENTS = set("comment comments comment-list commentlist disqus reply replies respond".split())
# These mark a part only outside an article (it may have a heading of its own).
PAGE_HINTS = {"header", "headers"}
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_ATTRIBUTE = re.compile(r"""[\s/]*+(?:(=?[^\s/>=]*+)(?:\s*+=\s*+(?:(["'])|([^\s>"'][^\s>]*+))?)?)""")
_FIRST_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_SPACE = re.compile(r"\s+")


class _Scanner:
    """Tags and texts of a page, each character looked at a bounded number of times."""

    def __init__(self, html: str):
        self.html = html
        # Whether a quote or an end tag has been searched in vain: it is not further on either.
        self.absent: set[str] = set()
        self.lower = None

    def find(self, what: str, at: int, folded: bool = False) -> int:
        if what in self.absent:
            return -1
        if folded and self.lower is None:
            # Only ASCII letters change, so places stay the same.
            self.lower = self.html.translate(_ASCII_LOWER)
        found = (self.lower if folded else self.html).find(what, at)
        if found < 0:
            self.absent.add(what)
        return found

    def attributes(self, at: int) -> tuple[dict[str, str], int, bool]:
        """Attributes from ``at`` on, the place behind the tag (-1: the page
        ends in it), and whether it closes itself."""
        html, out = self.html, {}
        while True:
            m = _ATTRIBUTE.match(html, at)
            key, quote, value = m.groups()
            at = m.end()
            if quote:
                end = self.find(quote, at)
                if end < 0:
                    # An open value: it ends with the tag.
                    end = self.find(">", at)
                    if end < 0:
                        return out, -1, False
                    value, at = html[at:end], end
                else:
                    value, at = html[at:end], end + 1
            if key:
                out.setdefault(key.lower(), value or "")
            if at >= len(html):
                return out, -1, False
            if html[at] == ">":
                return out, at + 1, html[at - 1] == "/" and not value
            if m.end() == m.start():
                at += 1

    def events(self):
        """``("text", data)``, ``("open", name, attributes, closed)``,
        ``("close", name)`` and ``("raw",)`` for content that is not text."""
        html, at, size = self.html, 0, len(self.html)
        while at < size:
            start = html.find("<", at)
            if start < 0:
                yield "text", html[at:]
                return
            if start > at:
                yield "text", html[at:start]
            if html.startswith("<!--", start):
                end = self.find("-->", start + 4)
                yield "text", " "
                at = size if end < 0 else end + 3
                continue
            m = _NAME.match(html, start)
            if not m:
                if html[start + 1:start + 2] in ("!", "?", "/"):
                    end = self.find(">", start)
                    at = size if end < 0 else end + 1
                else:
                    yield "text", "<"
                    at = start + 1
                continue
            name = m.group(2).lower()
            attributes, at, closed = self.attributes(m.end())
            if at < 0:
                return
            if m.group(1):
                yield "close", name
            elif name in RAW:
                yield ("raw",)
                if not closed:
                    end = self.find(f"</{name}", at, folded=True)
                    end = end if end < 0 else self.find(">", end)
                    at = size if end < 0 else end + 1
            else:
                yield "open", name, attributes, closed


_ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def _marked_by_tag(name: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether an element is no part of an article whatever it holds."""
    if name in OUTSIDE or (name == "header" and not in_article):
        return True
    if name in ("html", "body", "main"):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or _HIDDEN.search(attributes.get("style", "")):
        return True
    names = {n for key in ("class", "id", "role") for n in attributes.get(key, "").lower().split()}
    return bool(names & COMMENTS)


def _marked_by_name(name: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether a class, id or role takes an element out of the article."""
    if name in ("html", "body", "main", "article"):
        return False
    for key in ("class", "id", "role"):
        for part in attributes.get(key, "").split():
            first = _FIRST_WORD.search(part)
            words = {part.lower(), first.group().lower() if first and first.start() == 0 else ""}
            if words & HINTS or (not in_article and words & PAGE_HINTS):
                return True
    return False


def lines_of(html: str) -> list[tuple[str, int, bool, bool]]:
    """``(text, length, in article, is h1)`` of the lines that are in no outside part."""
    # Lines with the named marks that they stand in.
    found: list[tuple[str, int, bool, bool, tuple[int, ...]]] = []
    # Of each named mark: plain characters and whether it holds a marked article.
    chars: list[int] = []
    holds: list[bool] = []
    # Open elements: name, outside by tag, in an article, in a link, in an h1, named marks.
    stack: list[tuple] = []
    none = (False, False, False, False, ())
    state = line_state = none
    pieces: list[str] = []
    plain = 0

    def close_line():
        nonlocal plain
        if pieces:
            text = _SPACE.sub(" ", "".join(pieces)).strip()
            if text and not line_state[0]:
                found.append((text, plain, line_state[1], line_state[3], line_state[4]))
                for mark in line_state[4]:
                    chars[mark] += plain
            pieces.clear()
        plain = 0

    for event in _Scanner(html).events():
        if event[0] == "text":
            if pieces and (state[0], state[4]) != (line_state[0], line_state[4]):
                close_line()
            data = unescape(event[1])
            if not pieces:
                line_state = state
            pieces.append(data)
            if not state[2]:
                plain += len(data.strip())
            continue
        if event[0] == "raw":
            close_line()
            continue
        name = event[1]
        if name in BLOCKS:
            close_line()
        if event[0] == "close":
            for k in range(len(stack) - 1, max(-1, len(stack) - 1 - DEEPEST), -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
        elif name not in VOID and not event[3]:
            while stack and stack[-1][0] in _CLOSES.get(name, ()):
                stack.pop()
            if name in BLOCKS:
                # A block ends an open paragraph and what is open inside it.
                for k in range(len(stack) - 1, max(-1, len(stack) - 1 - DEEPEST), -1):
                    if stack[k][0] == "p":
                        del stack[k:]
                        break
                    if stack[k][0] in BLOCKS:
                        break
            outside, article, link, heading, marks = stack[-1][1:] if stack else none
            if not outside:
                outside = _marked_by_tag(name, event[2], article)
                if not outside and _marked_by_name(name, event[2], article):
                    marks = (*marks, len(chars))
                    chars.append(0)
                    holds.append(False)
            if name in ("article", "main") and not outside:
                article = True
                for mark in marks:
                    holds[mark] = True
            stack.append((name, outside, article, link or name == "a", heading or name == "h1", marks))
        state = stack[-1][1:] if stack else none
    close_line()
    total = sum(length for _, length, *_ in found)
    void = [h or 2 * n > total for h, n in zip(holds, chars)]
    return [(text, n, inside, h1) for text, n, inside, h1, marks in found if all(void[m] for m in marks)]


def _weights(lines: list[tuple[str, int, bool, bool]]) -> list[int]:
    if not any(length for _, length, inside, _ in lines if inside):
        return [length for _, length, _, _ in lines]
    return [max(MARKED * length, 1) if inside else 0 for _, length, inside, _ in lines]


def main_text(html: str | None) -> str:
    lines = lines_of(html or "")
    weights = _weights(lines)
    if not any(weights):
        return ""
    after = [sum(weights[i:i + WINDOW]) for i in range(len(weights))]
    before = [sum(weights[max(0, i - WINDOW + 1):i + 1]) for i in range(len(weights))]
    bound = max(1, min(BOUND_CHARS, BOUND_SHARE * max(after)))
    surge = next(i for i, n in enumerate(weights) if n and after[i] >= bound)
    dive = max(i for i, n in enumerate(weights) if n and before[i] >= bound)
    while surge and weights[surge - 1]:
        surge -= 1
    while dive + 1 < len(weights) and weights[dive + 1]:
        dive += 1
    titles = [i for i, line in enumerate(lines) if line[3]]
    if len(titles) == 1 and surge < titles[0] <= dive and not any(line[2] for line in lines):
        if 2 * sum(weights[surge:titles[0]]) < sum(weights[surge:dive + 1]):
            surge = titles[0]
    return " ".join(line[0] for line in lines[surge:dive + 1])


@F.arrow_udf(StringType())
def extract_main_text(html: pa.Array) -> pa.Array:
    return pa.array([main_text(page) for page in html.to_pylist()], pa.string())
