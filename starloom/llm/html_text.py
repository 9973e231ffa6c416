"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block. What stands in menus, headers, footers,
sidebars, forms, notices, adverts, comments, scripts and the like leaves a gap of
empty lines, as in a page's own source, and so do the bounds of an ``article`` or ``main``.
Every line weighs its characters outside links less those in links, at least 0; a heading's
links are its text. The weights over a sliding window of lines form a curve: it *surges* where
a window rises to the threshold and *dives* where a window is empty again; text between a
surge and the next dive is kept, lines of links too. So a list of links alone is a menu, links
amid text are text.

A page that marks its content with ``article`` or ``main`` has it raised: lines inside weigh
all their characters and the threshold more, which is ``lift`` times the highest window
inside (of ``crowd`` characters at least). Lines outside surge only where they are denser than
that, as where the marked elements are teasers beside the text.

Cases: a null or empty page, or one without text, has the empty string; elements
that are never closed end with the page, chrome also where the article begins, and chrome whose
end tag may be left out (``p``, ``li``, ``td``, ``head`` ...) where HTML ends it; repeated
rows are read one by one.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stage import fresh_name

# Elements by their part in a page.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt"
    " fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main"
    " menu nav ol p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
RAW = frozenset(
    "script style textarea title noscript template iframe noembed noframes svg math xmp".split()
)
CHROME = frozenset(
    "nav header footer aside form menu button select dialog object canvas audio video map"
    " search datalist head".split()
)
CONTENT = frozenset("article main".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Words of classes and ids. A name says what it is by its last word, as English compounds do, once words
#: for containers are off its end: ``cookie-notice`` and ``ad-slot`` are chrome, ``side-effects`` is not.
CHROME_NOUNS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising banner banners breadcrumb"
    " breadcrumbs comments commentform commentlist cookie cookies disqus footer gdpr header login"
    " masthead menu menus modal nav navbar navigation newsletter notice notices overlay pager"
    " pagination popup promo promos promoted promotion promotions recommended recommendations related"
    " replies share sharing sidebar sidebars signup social sponsor sponsored sponsors subscribe"
    " toolbar widget widgets".split()
)
#: These are chrome as whole names only, as in ``tag-list``: they qualify other words in articles.
CHROME_WHOLE = frozenset(
    "alert comment consent copyright discussion hidden reply respond side skip tag tags".split()
)
CONTAINERS = frozenset(
    "area articles bar block body bottom box button buttons col column container content form group"
    " holder icons inner item items left link links list outer panel placeholder posts region right"
    " section slot stories text thread top unit wrap wrapper zone".split()
)
#: A header of these is a part of the text.
HEADED = frozenset("article chapter content entry part post section story table".split())
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CHROME_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar"
    " toolbar".split()
)
_SCOPE = (BLOCKS | {"button", "object", "select"}) - {"address", "div", "p"}
_ROWS = frozenset("tr tbody thead tfoot".split())
#: Elements whose end tag may be left out: the start tags that end them, and the elements
#: that keep a start tag inside from doing so.
OMITTED = {
    "p": (BLOCKS - {"html", "legend", "title"}, frozenset({"button", "object"})),
    "li": (frozenset({"li"}), _SCOPE - {"li"}),
    "dt": (frozenset({"dt", "dd"}), _SCOPE - {"dt", "dd"}),
    "dd": (frozenset({"dt", "dd"}), _SCOPE - {"dt", "dd"}),
    "td": (_ROWS | {"td", "th"}, frozenset({"table"})),
    "th": (_ROWS | {"td", "th"}, frozenset({"table"})),
    "tr": (_ROWS, frozenset({"table"})),
    "tbody": (_ROWS - {"tr"}, frozenset({"table"})),
    "thead": (_ROWS - {"tr"}, frozenset({"table"})),
    "tfoot": (_ROWS - {"tr"}, frozenset({"table"})),
    "caption": (_ROWS | {"td", "th", "col", "colgroup"}, frozenset({"table"})),
    "option": (frozenset({"option", "optgroup"}), frozenset()),
    "optgroup": (frozenset({"optgroup"}), frozenset()),
    "rt": (frozenset({"rt", "rp"}), frozenset({"ruby"})),
    "rp": (frozenset({"rt", "rp"}), frozenset({"ruby"})),
}
_IN_HEAD = frozenset("html head base basefont bgsound link meta".split())
_PARENTS = (BLOCKS | {"body", "ruby"}) - {"p"}  # their end tags end what is open within
_REPLIES = re.compile(r"comment|repl(?:y|ies)|discuss|disqus|respond|related|recommend", re.I)
_GAP = 3  # empty lines that chrome leaves, as many as a window has

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",  # a quote that is never closed
    re.DOTALL,
)
_NAMED = re.compile(
    r"(?:^|[\s\"'/])(class|id|role|hidden|aria-hidden|itemprop)"
    r"(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?(?=[\s/]|\Z|[\"'])",
    re.IGNORECASE,
)


@dataclass(frozen=True)
class Spec:
    window: int = 3
    least: int = 1  # weight that a window surges at, on pages without article or main
    lift: int = 4  # how much denser than the marked content text outside of it must be
    crowd: int = 100  # characters of a window that marked content counts for at least


@lru_cache(maxsize=4096)
def _names_chrome(name: str, heading: bool) -> bool:
    """Whether a class or id names a part of a page that is not its text."""
    words = [w.lower() for w in _WORDS.findall(name)]
    while words and words[-1] in CONTAINERS:
        words.pop()
    if not words:
        return False
    if words[-1] == "header" and (heading or HEADED.intersection(words)):
        return False
    return words[-1] in CHROME_NOUNS or (len(words) == 1 and words[0] in CHROME_WHOLE)


def _is_chrome(name: str, attributes: str) -> bool:
    if name in CHROME:
        return True
    if not attributes or name in ("html", "body"):
        return False
    for found in _NAMED.finditer(attributes):
        what, value = found.group(1).lower(), (found.group(2) or "").strip("\"'")
        if what in ("class", "id") and any(_names_chrome(c, name in HEADINGS) for c in value.split()):
            return True
        if what == "role" and value.lower() in CHROME_ROLES:
            return True
        if what == "hidden" or (what == "aria-hidden" and value.lower() == "true"):
            return True
    return False


class _Omitted:
    """An element being skipped whose end tag may be left out: what is open in it."""

    def __init__(self, name: str):
        self.name = name
        self.starts, self.barriers = OMITTED.get(name, (frozenset(), frozenset()))
        self.stack: list[str] = []
        self.n_open: Counter[str] = Counter()
        self.barred = 0

    def ends(self, name: str, closing: bool, empty: bool, outer: Counter[str]) -> bool:
        """Whether this tag ends the element; takes note of it if not."""
        if not closing:
            if self.name == "head":
                return name not in _IN_HEAD
            if name in self.starts and not self.barred:
                return True
            if not empty:
                self.stack.append(name)
                self.n_open[name] += 1
                self.barred += name in self.barriers
            return False
        if self.n_open[name]:
            inner = None
            while inner != name:
                inner = self.stack.pop()
                self.n_open[inner] -= 1
                self.barred -= inner in self.barriers
            return False
        return name == self.name or (name in _PARENTS and outer[name] > 0)


def lines(page: str) -> tuple[list[tuple[str, int, bool]], bool]:
    """``(text, weight, inside content)`` of each line of a page, and whether the page marks its
    content. Chrome and the bounds of content leave ``_GAP`` empty lines."""
    out: list[tuple[str, int, bool]] = []
    parts: list[str] = []
    linked = 0
    link_depth = 0
    heading = False
    content = 0
    marked = False
    chrome: str | None = None  # the element we are skipping, and how often it is open
    replies = False  # it holds articles of its own
    depth = 0
    omitted: _Omitted | None = None  # the same element, if its end tag may be left out
    outer: Counter[str] = Counter()  # blocks open outside of it
    at = 0

    def text(piece: str) -> None:
        nonlocal linked
        if piece and chrome is None:
            parts.append(piece)
            if link_depth and not heading:
                linked += len(piece)

    def end_line() -> None:
        nonlocal linked
        if parts:
            whole = " ".join(html.unescape("".join(parts)).split())
            if whole:
                out.append((whole, max(0, len(whole) - 2 * linked), content > 0))
            parts.clear()
        linked = 0

    def gap() -> None:
        out.extend([("", 0, False)] * _GAP)

    n = len(page)
    while at < n:
        found = _TOKEN.search(page, at)
        if found is None:
            text(page[at:])
            break
        text(page[at : found.start()])
        at = found.end()
        name = (found.group(2) or found.group(5) or "").lower()
        if not name:
            continue  # a comment, a declaration
        closing = bool(found.group(1) or found.group(4))
        attributes = found.group(3) or found.group(6) or ""
        empty = name in VOID or attributes.endswith("/")
        if omitted is not None and name not in RAW and omitted.ends(name, closing, empty, outer):
            ended, chrome, omitted = chrome, None, None
            if closing and name == ended:
                continue
        if chrome is not None and name not in RAW:
            if omitted is None and name == chrome and not attributes.endswith("/"):
                depth += -1 if closing else 1
                if depth == 0:
                    chrome = None
                continue
            # an article inside a menu that was never closed is still the article
            if closing or replies or name not in CONTENT or _is_chrome(name, attributes):
                if not (name == "body" and chrome == "head"):
                    continue
            chrome = omitted = None
        if name in RAW:
            if not closing and not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.IGNORECASE)
                close = end.search(page, at)
                at = close.end() if close else n
                if chrome is None and name in BLOCKS:
                    end_line()
            continue
        if name in BLOCKS:
            end_line()
        elif name == "br":
            text(" ")
        if name == "a":
            link_depth = max(0, link_depth + (-1 if closing else 1))
        if closing or empty:
            if name in HEADINGS:
                heading = False
            if closing and name in CONTENT and content:
                content -= 1
                if not content:
                    gap()
            if closing and outer[name]:
                outer[name] -= 1
            continue
        if _is_chrome(name, attributes):
            end_line()
            gap()
            chrome, depth = name, 1
            omitted = _Omitted(name) if name in OMITTED or name == "head" else None
            replies = name == "aside" or bool(_REPLIES.search(attributes))
            continue
        if name in _PARENTS:
            outer[name] += 1
        heading = name in HEADINGS or (heading and name not in BLOCKS)
        if name in CONTENT:
            if not content:
                gap()
            content += 1
            marked = True
    end_line()
    return out, marked


def _curve(weights: list[int], width: int) -> list[int]:
    """The sums of the windows that end with each line."""
    sums, total = [], 0
    for i, weight in enumerate(weights):
        total += weight - (weights[i - width] if i >= width else 0)
        sums.append(total)
    return sums


def kept_lines(rows: list[tuple[str, int, bool]], marked: bool, spec: Spec) -> list[str]:
    """The lines between surges and dives of the curve of window sums."""
    surge = spec.least
    weights = [weight for _, weight, _ in rows]
    if marked:
        dense = max(_curve([len(text) * inside for text, _, inside in rows], spec.window), default=0)
        surge = spec.lift * max(dense, spec.crowd)
        weights = [
            len(text) + surge if inside and text else weight
            for (text, _, inside), weight in zip(rows, weights, strict=True)
        ]
    sums = _curve(weights, spec.window)
    out: list[str] = []
    start = 0
    while start < len(rows):
        if not weights[start]:
            start += 1
            continue
        end = start  # the dive: the next window without weight
        while end < len(rows) and sums[end] > 0:
            end += 1
        if max(sums[start:end]) >= surge:
            out += [text for text, _, _ in rows[start:end] if text]
        start = end
    return out


def main_text(page: str | None, spec: Spec = Spec()) -> str:
    if not page:
        return ""
    rows, marked = lines(page)
    return "\n".join(kept_lines(rows, marked, spec))


def extract(pages: DataFrame, *, page: str = "html", spec: Spec = Spec()) -> DataFrame:
    """The pages without their markup, with ``text`` and ``n_chars`` (its code points).

    Columns of the input with these names are replaced.
    """

    @F.pandas_udf("text string, n_chars long")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(p, spec) for p in batch]
            yield pd.DataFrame({"text": texts, "n_chars": [len(t) for t in texts]})

    kept = [c for c in pages.columns if c.lower() not in ("text", "n_chars", page.lower())]
    both = fresh_name(kept, "_found")
    return pages.select(*kept, found(F.col(page)).alias(both)).select(
        *kept, f"{both}.text", f"{both}.n_chars"
    )
