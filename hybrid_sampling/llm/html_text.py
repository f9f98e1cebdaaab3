"""Main text of web pages by tree scoring.

A page becomes a tree of its elements (end tags left out are supplied as browsers do for
paragraphs, list items and cells; an end tag without a start counts for nothing). Menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are set aside by
element, role, or a word of the class or id. Every paragraph of the rest passes points for its length and
its commas, discounted by the share of its text that stands in links, to the containers above it,
half as many at each step. The container with most points is taken, or the article (else
main element) that it stands in, with those of its siblings that score alike and the
headings before it; lists and boxes inside that are nearly all links are left out. All other text
of these subtrees is kept, whole and in page order: character references decoded, white space inside a block
made one space, blocks joined by one line feed.

Defined cases: a null or empty page has an empty text, and so has a page that
is all markup; a page without tags is one block; a tag or comment that the page ends in is dropped; equal points go
to the first container in page order; repeated rows are judged alike; an empty table gives no rows;
a very long page is held whole in the memory of its task, with a tree of its elements.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ATTRIBUTES = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)?+)*+"""
_TOKEN = re.compile(
    rf"""<!--(?:-?>|.*?(?:--!?>|\Z))
    |<(?P<raw>script|style|title|textarea|xmp|iframe|noembed|noframes|noscript)(?=[\s/>]){_ATTRIBUTES}>.*?(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)
    |<(?P<end>/?)(?P<name>[a-z][^\s/>]*+)(?P<attributes>{_ATTRIBUTES})>
    |</?[a-z][^>]*+\Z
    |<[!?/][^>]*+>?""",
    re.I | re.S | re.X,
)
_ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_NAME_PART = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")


def _set(text: str) -> frozenset[str]:
    return frozenset(text.split())


# Elements by their part in a page.
VOID = _set("area base br col embed hr img input link meta param source track wbr basefont bgsound frame keygen")
HEADINGS = _set("h1 h2 h3 h4 h5 h6")
#: Elements that begin and end a block of text.
BLOCKS = HEADINGS | _set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form header hgroup hr html "
    "legend li listing main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul caption"
)
INLINE = _set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q s samp small span strike strong sub sup time tt u var")
#: Blocks that points pass through to the next container.
CONTAINERS = _set("article body center div form main section td th details fieldset")
#: Start tags that end an open paragraph.
ENDS_PARAGRAPH = BLOCKS - _set("body html option legend caption tbody td tfoot th thead tr table") | {"table"}
#: An open element of the key's tag ends at a start tag of the same set, unless one of the second set stands between.
SUPPLIED_ENDS = {
    "li": (_set("li"), _set("ul ol menu dir")), "dt": (_set("dt dd"), _set("dl")), "dd": (_set("dt dd"), _set("dl")),
    "option": (_set("option"), _set("select datalist")), "tr": (_set("tr"), _set("table")), "td": (_set("td th"), _set("tr table")), "th": (_set("td th"), _set("tr table")),
    "tbody": (_set("tbody thead tfoot"), _set("table")), "thead": (_set("tbody thead tfoot"), _set("table")), "tfoot": (_set("tbody thead tfoot"), _set("table")),
}
TABLE_PARTS = _set("table caption thead tbody tfoot tr td th")
SCOPE = _set("html table td th caption object button template")
HEAD_ONLY = _set("meta title link style script base noscript template")
#: Elements that never hold main text.
APART = _set("head nav aside footer dialog menu select datalist button textarea template noscript object embed canvas audio video svg map")
FORMS = _set("form fieldset label")
ROLES = _set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist")
#: Words of a class or id that set an element apart, unless the article stands in it.
NAMES = _set(
    "ad ads adsense adslot adbox advert adverts advertisement advertising advertorial banner banners sponsor sponsored sponsors promo promos promotion "
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager topbar toolbar masthead sidebar sidebars rail aside widget widgets "
    "footer foot colophon copyright disclaimer legal notice notices cookie cookies consent gdpr popup popups modal overlay alert paywall "
    "newsletter subscribe subscription signup login search searchbox form share sharing social follow related recommended recommendations trending skip "
    "announcement notification notifications cta taboola outbrain captcha"
)
#: Words that end so are such words, too (subnav, sitefooter).
NAME_ENDS = ("nav", "menu", "sidebar", "banner", "footer", "advert", "comments")
#: Beside the word header these tell that it is the article's own.
OWN_HEADER = _set("article post entry story content section card title")
COMMENTS = _set("comment comments commentlist respond reply replies disqus discussion")
NEGATIONS = _set("has with without no is")


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), html.unescape(value.strip("\"'")))
    return out


class Page:
    """The tree of a page: its elements by number, parents before children, and its pieces of text in order."""

    def __init__(self, source: str):
        self.tag, self.parent = ["body"], [-1]
        self.marks: list[dict[str, str]] = [{}]
        self.pieces: list[tuple[int, str | None]] = []  # (element, text); text None where a block begins or ends
        self._open, self._count = [0], Counter(["body"])
        at = 0
        for m in _TOKEN.finditer(source):
            self._text(source[at : m.start()])
            at = m.end()
            if m["name"]:
                name = m["name"].lower()
                if m["end"]:
                    self._close(name)
                else:
                    self._begin(name, m["attributes"])
        self._text(source[at:])

    def _text(self, text: str) -> None:
        if text:
            if self._count["head"] and not text.isspace():
                self._leave("head")
            self.pieces.append((self._open[-1], html.unescape(text) if "&" in text else text))

    def _break(self) -> None:
        self.pieces.append((self._open[-1], None))

    def _leave(self, name: str, stop: frozenset[str] = frozenset()) -> None:
        """End the innermost open element of that name and all within, unless one of ``stop`` stands between."""
        if not self._count[name]:
            return
        k = len(self._open) - 1
        while self.tag[self._open[k]] != name:
            if self.tag[self._open[k]] in stop:
                return
            k -= 1
        if k == 0:
            return
        for i in self._open[k:]:
            self._count[self.tag[i]] -= 1
        if any(self.tag[i] in BLOCKS for i in self._open[k:]):
            self._break()
        del self._open[k:]

    def _begin(self, name: str, attributes: str) -> None:
        if self._count["head"] and name not in HEAD_ONLY:
            self._leave("head")
        if name == "br":
            self.pieces.append((self._open[-1], " "))
            return
        if name in ("html", "body"):  # one body; its marks say nothing of a part of the page
            return
        if name in ENDS_PARAGRAPH:
            self._leave("p", SCOPE)
        if name in HEADINGS and self.tag[self._open[-1]] in HEADINGS:
            self._leave(self.tag[self._open[-1]])
        if name in SUPPLIED_ENDS:
            ended, stop = SUPPLIED_ENDS[name]
            for other in ended:
                self._leave(other, stop | SCOPE - ended)
        if name in BLOCKS:
            self._break()
        if name in VOID:
            return
        self.tag.append(name)
        self.parent.append(self._open[-1])
        self.marks.append(_attributes(attributes) if attributes else {})
        self._open.append(len(self.tag) - 1)
        self._count[name] += 1

    def _close(self, name: str) -> None:
        if name == "p" and not self._count["p"]:
            self._break()
        elif name == "br":
            self.pieces.append((self._open[-1], " "))
        elif name in TABLE_PARTS:
            self._leave(name, _set("table") - {name})
        elif name not in ("html", "body"):  # an inline end tag leaves the blocks begun since open, a block's end stays in its cell
            self._leave(name, BLOCKS if name in INLINE else SCOPE)


_PAGE_HEADER = "#header"


def _apart_by_name(names: set[str], inside: bool) -> bool:
    return bool(names & NAMES) or any(w.endswith(NAME_ENDS) for w in names) or _PAGE_HEADER in names and not inside


def _names(marks: dict[str, str]) -> set[str]:
    out: set[str] = set()
    for name in f"{marks.get('class', '')} {marks.get('id', '')}".split():
        words = [w.lower() for w in _NAME_PART.findall(name)]
        if words and words[0] not in NEGATIONS:
            out.update(words)
            if "header" in words and OWN_HEADER.isdisjoint(words):
                out.add(_PAGE_HEADER)
    return out


def _is_main(tag: str, marks: dict[str, str]) -> bool:
    return tag in ("article", "main") or marks.get("role", "").lower() in ("main", "article") or marks.get("itemprop") == "articleBody"


def set_apart(page: Page) -> list[bool]:
    """For each element whether it, or one that it stands in, is no part of the main text."""
    n = len(page.tag)
    names = [_names(m) if m else set() for m in page.marks]
    comments = [bool(names[i] & COMMENTS) for i in range(n)]
    mains = [_is_main(page.tag[i], page.marks[i]) and not comments[i] for i in range(n)]
    holds_main, holds_heading = [False] * n, [False] * n
    out, inside = [False] * n, [False] * n
    for i in range(1, n):
        comments[i] |= comments[page.parent[i]]
    for i in range(n - 1, 0, -1):
        up = page.parent[i]
        holds_main[up] |= holds_main[i] or mains[i] and not comments[i]
        holds_heading[up] |= holds_heading[i] or page.tag[i] in HEADINGS
    for i in range(1, n):
        up, tag, marks = page.parent[i], page.tag[i], page.marks[i]
        inside[i] = inside[up] or mains[i]
        if out[up] or comments[i]:
            out[i] = True
        elif holds_main[i] or mains[i]:
            out[i] = tag in APART
        elif tag == "header":
            out[i] = not (inside[up] and holds_heading[i])
        else:
            style = marks.get("style", "").replace(" ", "").lower()
            out[i] = (
                tag in APART or tag in FORMS or _apart_by_name(names[i], inside[up]) or marks.get("role", "").lower() in ROLES
                or "hidden" in marks or marks.get("aria-hidden", "").lower() == "true" or "display:none" in style
            )
    return out


def _blocks(page: Page, apart: list[bool]) -> Iterator[tuple[int, str, int]]:
    """Each block of text outside what is set apart: the block element it stands in, its text, its characters in links."""
    linked = [False] * len(page.tag)
    owner = [0] * len(page.tag)
    for i in range(1, len(page.tag)):
        linked[i] = linked[page.parent[i]] or page.tag[i] == "a"
        owner[i] = i if page.tag[i] in BLOCKS else owner[page.parent[i]]
    held: list[str] = []
    of, links = 0, 0
    for i, text in [*page.pieces, (0, None)]:
        if text is None:
            block = " ".join("".join(held).split())
            if block:
                yield of, block, links
            held, links = [], 0
        elif not apart[i]:
            if not held or not text.isspace():
                of = owner[i]
            held.append(text)
            links += len(" ".join(text.split())) if linked[i] else 0


def main_text(source: str | None) -> str:
    """The main text of one page."""
    if not source:
        return ""
    page = Page(source)
    apart = set_apart(page)
    blocks = list(_blocks(page, apart))
    n = len(page.tag)
    points, chars, link_chars, links = [0.0] * n, [0] * n, [0] * n, [0] * n
    for of, text, linked in blocks:
        chars[of] += len(text)
        link_chars[of] += min(linked, len(text))
        score = (min(1.0, len(text) / 25) + text.count(",") + len(text) / 100) * (1 - min(1.0, linked / len(text)))
        i = of
        while score > 0.001 and i >= 0:
            if page.tag[i] in CONTAINERS:
                points[i] += score
                score /= 2
            i = page.parent[i]
    for i in range(n - 1, 0, -1):  # parents have the smaller numbers
        links[i] += page.tag[i] == "a" and not apart[i]
        for of_all in (chars, link_chars, links):
            of_all[page.parent[i]] += of_all[i]
    density = [link_chars[i] / chars[i] if chars[i] else 0.0 for i in range(n)]

    best = max(range(n), key=lambda i: (points[i], -i))
    above = [best]
    while above[-1]:
        above.append(page.parent[above[-1]])
    of_kind = {kind: next((i for i in above if i and _is_main(page.tag[i], page.marks[i]) and (page.tag[i] == "article") == kind), None) for kind in (True, False)}
    semantic = of_kind[True] if of_kind[True] is not None else of_kind[False]
    top = best if semantic is None else semantic

    chosen = [False] * n
    chosen[top] = True
    if top:
        for i in range(1, n):
            if page.parent[i] != page.parent[top] or apart[i] or i == top:
                continue
            tag = page.tag[i]
            if tag in HEADINGS:
                chosen[i] = i < top and density[i] == 0
            elif semantic is not None:
                chosen[i] = tag == page.tag[top] and points[i] >= 0.2 * points[top] and density[i] < 0.5
            elif tag in CONTAINERS:
                chosen[i] = points[i] >= 0.2 * points[top] and density[i] < 0.5
            else:
                chosen[i] = chars[i] >= 80 and density[i] < 0.25 or chars[i] > 0 and links[i] == 0 and tag in ("p", "blockquote", "pre")
    kept = [False] * n
    for i in range(n):
        up = page.parent[i]
        inner = i != top and page.tag[i] in ("ul", "ol", "dl", "div", "section", "table") and links[i] >= 3 and density[i] > 0.8  # a menu by its links
        kept[i] = not apart[i] and (chosen[i] or up >= 0 and kept[up] and not inner)
    return "\n".join(text for _, text, _ in _blocks(page, [not k for k in kept]))


def main_text_udf():
    @F.pandas_udf("string")
    def extracted(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in pages:
            yield part.map(main_text)

    return extracted


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row of ``pages``: id, url, text and n_chars (its code points)."""
    out = pages.select(pages[id_col].alias("id"), pages[url_col].alias("url"), main_text_udf()(F.coalesce(pages[html_col], F.lit(""))).alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
