"""Main text of web pages: parser events, text-to-tag ratios, Gaussian smoothing, threshold clustering.

One pass of the standard-library parser turns a page into lines, one per block (paragraph, heading, list
item, cell, ...).  A line knows its text, the tags seen since the line before, the element that holds it and
whether it lies in something that is never an article: menus, page headers, footers, sidebars, notices,
adverts, forms, reader comments (by element, role, or the class or id of a container), scripts and styles.
A container is judged by the words of its class tokens and ids: a name alone, one at the end (``user-comments``), or one followed
by words that only say what kind of box it is (``comment-list``, ``ad-slot``), but not ``has-sidebar``.  Names that
may also be part of an article (``header``, ``discussion``, ``related``) count less inside one; ids of sections count
only if every word is a name or a kind of box.  Headings are never judged, nor what holds the first article or main.  A
``header`` in ``main`` stays only if it holds a heading.

Lines outside those are ranked by text length per tag, smoothed with a Gaussian along the page; lines at or
above one standard deviation of the smoothed ratios are content.  A region is then completed: where content
lies in an ``article`` (or, without one, in ``main``), all lines of that element belong to it; elsewhere all
lines directly in the same element do (headings, quotations and cells as if they were paragraphs).  So short paragraphs between long ones are not lost.

Rows: NULL, empty and tag-only pages give an empty text; broken markup (unclosed or crossed tags) is read as
far as it goes; repeated pages are computed alike; an empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import per_batch

_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q ruby rb rt rp s "
                    "samp small span strike strong sub sup time tt u var".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HIDDEN = frozenset("head script style noscript template iframe object svg math canvas audio video map".split())
_ASIDE = frozenset("nav footer aside form menu dialog button select textarea fieldset datalist".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
_BOXES = frozenset("div section ul ol li dl table tbody tr td header figure details center".split())  # judged by name
_HEADINGS = frozenset("h1 h2 h3".split())
_LEAVES = frozenset("p li h1 h2 h3 h4 h5 h6 blockquote pre caption figcaption".split())
_CELLS = frozenset("td th dt dd".split())
_GRIDS = frozenset("tr tbody thead tfoot table dl".split())
# words of class or id that name something beside the article, whatever they are combined with ...
_BESIDE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar widget widgets cookie cookies consent gdpr popup modal overlay newsletter subscribe "
    "subscription signup login share sharing comment comments commentlist disqus pagination pager toolbar".split())
# ... and those that may also name a part of one
_NAMES = _BESIDE | frozenset("banner header masthead footer aside notice notices notification alert social related recommended "
                             "replies respond discussion".split())
# words that say only what kind of box it is
_PARTS = frozenset("area articles bar block body bottom box button buttons container content count entry form frame group holder icons "
                   "inner item items left link links list main news panel posts right row section slot stories text thread "
                   "title top unit videos wrap wrapper".split())
_NOT = frozenset("has have no not non with without is hide hidden".split())  # before a name: says something of a layout
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_BLANK = re.compile(r"\s+")


class _Lines(HTMLParser):
    """Collects lines: [text parts, tags, holder, root, boilerplate]."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int]] = []
        self.open: list[tuple[str, int, int, bool]] = []  # name, hides (2: by name only), id, is a root
        self.named: dict[str, int] = {}
        self.hides, self.tags, self.count = 0, 0, 0
        self.parts: list[str] = []
        self.roots: list[tuple[int, int]] = []  # id, rank (2 article, 1 main)
        self.met = 0  # the highest rank met so far
        self.headings, self.headers = 0, {}  # headings met; open headers of main: lines and headings before them

    def _flush(self) -> None:
        if self.parts:
            text = _BLANK.sub(" ", "".join(self.parts)).strip()
            self.parts = []
            if text and not self.hides:
                holder = self._holder()
                articles = [r for r in self.roots if r[1] == 2] or self.roots
                self.lines.append((text, self.tags, holder, articles[0][0] if articles else -1))
                self.tags = 0

    def _holder(self) -> int:
        """The block container of a line; of a cell's own text, that of its table."""
        inner, cell = True, False
        for name, _, number, _ in reversed(self.open):
            if name in _INLINE:
                continue
            if inner and name in _CELLS:
                cell = True
            elif name not in _LEAVES and not (cell and name in _GRIDS):
                return number
            inner = False
        return 0

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in _VOID:
            if tag in ("br", "hr"):
                self.parts.append(" ")
            return
        if tag not in _INLINE:
            self._flush()
            if tag in _HEADINGS:
                self.headings += 1
            if tag in ("p", "li", "tr", "td", "th", "dt", "dd", "option") and self.named.get(tag):
                self._implied(tag)
        self.count += 1
        hides = int(tag in _HIDDEN or tag in _ASIDE or self._beside(tag, attrs))
        if tag == "header" and not self.roots:
            hides = 1
        if not hides and self._named(tag, attrs):
            hides = 2
        rank = 2 if tag == "article" else 1 if tag == "main" or ("role", "main") in attrs else 0
        if hides:
            rank = 0
        if tag == "header" and not hides and not any(r == 2 for _, r in self.roots):
            self.headers[self.count] = (len(self.lines), self.headings)
        self.open.append((tag, hides, self.count, bool(rank)))
        self.named[tag] = self.named.get(tag, 0) + 1
        self.hides += hides > 0
        if rank > self.met:  # what holds the first article or main is not beside it
            self.met = rank
            self.hides -= sum(e[1] == 2 for e in self.open)
            self.open = [(name, 0 if how == 2 else how, *rest) for name, how, *rest in self.open]
        if rank:
            self.roots.append((self.count, rank))

    @staticmethod
    def _beside(tag, attrs) -> bool:
        for name, value in attrs:
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return True
            if name == "role" and (value or "").strip().lower() in _ROLES:
                return True
            if name == "style" and value and "display:none" in value.replace(" ", "").lower():
                return True
            if name in ("class", "id") and value and tag == "article" and "comment" in value.lower():
                return True
        return False

    def _named(self, tag, attrs) -> bool:
        """Whether class or id name a container as something beside the article."""
        if tag not in _BOXES:
            return False
        inside = any(rank == 2 for _, rank in self.roots)
        for name, value in attrs:
            if name in ("class", "id") and value:
                for token in value.split():
                    words = [w.lower() for w in _WORD.findall(token)]
                    if words and words[0] not in _NOT and self._foreign(words, name, tag, inside):
                        return True
        return False

    @staticmethod
    def _foreign(words: list[str], name: str, tag: str, inside: bool) -> bool:
        first, last = words[0], words[-1]
        rest = all(w in _PARTS or w in _NAMES for w in words[1:])
        if name == "id" and tag == "section":  # ids of sections are mostly slugs of their headings
            return first in _BESIDE and rest
        if len(words) == 1:
            return first in _BESIDE or (first in _NAMES and name == "class" and not (inside and first == "header")) or (
                first in _NAMES and not inside)
        known = first in _BESIDE if inside and name == "id" else first in _NAMES - {"header"}
        return known and rest or last in (_BESIDE if inside else _NAMES)

    def _implied(self, tag) -> None:
        """A new item ends an open one of its kind, unless a container was opened within it."""
        for name, *_ in reversed(self.open):
            if name == tag:
                self._close(tag)
                return
            if name not in _INLINE and name not in ("p", "td", "th", "dd", "dt"):
                return

    def _close(self, tag) -> None:
        while self.open:
            name, hides, number, is_root = self.open.pop()
            self.named[name] -= 1
            self.hides -= hides > 0
            if is_root:
                self.roots.pop()
            if number in self.headers:  # a page's header, unless it holds the heading
                since, headings = self.headers.pop(number)
                if headings == self.headings:
                    self._flush()
                    del self.lines[since:]
            if name == tag:
                return

    def handle_endtag(self, tag):
        self.tags += 1
        if tag not in _INLINE:
            self._flush()
        if self.named.get(tag):
            self._close(tag)

    def handle_startendtag(self, tag, attrs):
        self.tags += 1
        if tag not in _INLINE:
            self.parts.append(" ") if tag in _VOID else self._flush()

    def handle_data(self, data):
        if not self.hides:
            self.parts.append(data)

    def end(self) -> None:
        self.close()
        self._flush()


def smoothed(ratios: np.ndarray, sigma: float = 1.5) -> np.ndarray:
    """Gaussian moving average with weights renormalised at the ends."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return (np.convolve(ratios, kernel)[reach:reach + len(ratios)]
            / np.convolve(np.ones(len(ratios)), kernel)[reach:reach + len(ratios)])


def main_text(html: str | None) -> str:
    parser = _Lines()
    parser.feed(html or "")
    parser.end()
    if not parser.lines:
        return ""
    lines = parser.lines
    ratio = smoothed(np.array([len(text) / max(1, tags) for text, tags, _, _ in lines]))
    content = np.flatnonzero(ratio >= min(ratio.std(), ratio.max()))
    roots = {lines[i][3] for i in content} - {-1}
    holders = {lines[i][2] for i in content if lines[i][3] == -1} if not roots else set()
    return "\n\n".join(t for t, _, holder, root in lines if root in roots or holder in holders)


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(h) for h in batch["html"].to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(
        per_batch(work), "page_id long, url string, text string, n_chars long")
