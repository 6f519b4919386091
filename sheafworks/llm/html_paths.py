"""Main text of web pages by consensus on container paths.

Each page's containers are scored, and the page votes for the path of the one that holds its
article: tags with their classes from the root down, digits and places among siblings left out, so
that pages of one template agree. Spark counts the votes of each host. Every page is then extracted
again from the containers on its host's winning path; a page that has none there (a page of another
kind, or of an unknown host) is extracted from its own.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafworks.session import scratch_path

from .common import slices, write_once

#: Host paths are broadcast up to so many bytes and rows; beyond, pages are dealt out to meet them.
BROADCAST_BYTES = 16 << 20
BROADCAST_ROWS = 100_000
#: Parts into which the pages of each host are dealt where paths are joined by shuffle.
SALTS = 64

#: A child container that holds this share of its parent's text stands for it.
DOMINANT = 0.75
#: An article element with this share of the page's text is its article.
ARTICLE_SHARE = 0.3
#: Of several containers on the winning path those with this share of the largest one's text count.
ALONGSIDE = 0.3

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter nobr output "
    "progress q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
CONTAINERS = frozenset("html body main article section div td center".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: What a start tag of these ends, if it is open in the same block.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table ul dt dd".split()
)
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
SCOPE = frozenset("table td th caption button article section main body html object template".split())

#: Elements that are never part of an article.
OUTSIDE = frozenset(
    "head nav aside footer form script style textarea title noscript template button select datalist iframe svg math "
    "canvas object audio video dialog menu noembed noframes fieldset".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form status".split()
)
#: Words of class and id names that mark menus, headers, footers, sidebars, notices, adverts, forms and comments.
MARKS = frozenset(
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs masthead banner header topbar footer foot colophon "
    "sidebar aside rail widget widgets ad ads adv advert adverts advertisement advertising advertorial sponsor sponsors "
    "sponsored promo promos promotion promoted banners cookie cookies consent gdpr notice notices notification "
    "notifications alert alerts popup modal overlay paywall newsletter subscribe subscription signup login signin "
    "search searchbox share sharing sharebar social comment comments commentlist disqus replies respond "
    "related recommended recommendations pagination pager skip toolbar copyright disclaimer".split()
)
#: Marks that are no sign where one of these words stands before them: `no-sidebar`, `with-ads`.
NOT_MARKED = frozenset("no has with without hide non".split())
#: A header of one of these is part of the article: `entry-header`.
ARTICLE_WORDS = frozenset("article entry post story content section".split())

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*(?:>|\Z)", re.DOTALL
)
_TAG_OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.DOTALL)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


def marked(names: str) -> bool:
    """Do class or id names mark a part that is no article?"""
    for name in names.split():
        before = ""
        for word in _WORD.findall(name):
            word = word.lower()
            own_header = word == "header" and before in ARTICLE_WORDS
            if word in MARKS and before not in NOT_MARKED and not own_header:
                return True
            before = word
    return False


class Page:
    """Elements and text blocks of one page.

    Element k has `tag[k]`, `parent[k]` (smaller than k), `step[k]` of its path, and `outside[k]`: 2 if
    its element or role is never part of an article, 1 if its name says so. A block is (element, text,
    letters, letters in links) with character references decoded and white space made one space.
    """

    def __init__(self, html: str):
        self.tag, self.parent, self.step, self.outside = ["#"], [-1], [""], [0]
        self.open: dict[str, int] = defaultdict(int)
        self.blocks: list[tuple[int, str, int, int]] = []
        self.stack = [0]
        self.pieces: list[str] = []
        self.linked = 0
        self.links = 0
        self._read(html)
        self._end_block()

    def _read(self, html: str) -> None:
        at, size = 0, len(html)
        while at < size:
            begin = html.find("<", at)
            if begin < 0:
                return self._text(html[at:])
            hit = _TAG.match(html, begin) or _TAG_OPEN.match(html, begin)
            if not hit:  # a bare "<" is text
                self._text(html[at : begin + 1])
                at = begin + 1
                continue
            if begin > at:
                self._text(html[at:begin])
            at = hit.end()
            if not hit.lastindex or not hit.group(2):
                continue  # comment or declaration
            name = hit.group(2).lower()
            if hit.group(1):
                self._end(name)
                continue
            if not html.startswith(">", at - 1):
                return  # the page stops inside a tag
            self._start(name, hit.group(3))
            if name in RAW and self.tag[self.stack[-1]] == name:
                close = re.compile(rf"</{name}(?=[\s/>])[^>]*>|\Z", re.IGNORECASE).search(html, at)
                at = close.end()
                self._pop_to(len(self.stack) - 1)

    def _text(self, text: str) -> None:
        self.pieces.append(entities.unescape(text) if "&" in text else text)
        if self.links:
            self.linked += len(text)

    def _end_block(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self.blocks.append((self.stack[-1], text, len(text), min(self.linked, len(text))))
            self.pieces, self.linked = [], 0

    def _pop_to(self, place: int) -> None:
        self._end_block()
        self._drop_from(place)

    def _drop_from(self, place: int) -> None:
        for k in self.stack[place:]:
            self.open[self.tag[k]] -= 1
            self.links -= self.tag[k] == "a"
        del self.stack[place:]

    def _open(self, names, until) -> int | None:
        """Place in the stack of the innermost open element of these names, not looking beyond `until`."""
        for name in names:
            if self.open[name]:
                break
        else:
            return None
        for place in range(len(self.stack) - 1, 0, -1):
            tag = self.tag[self.stack[place]]
            if tag in names:
                return place
            if tag in until:
                return None
        return None

    def _start(self, name: str, rest: str) -> None:
        if name == "br" or name == "hr":
            self._end_block() if name == "hr" else self.pieces.append(" ")
            return
        if name in VOID:
            return
        if self.open["p"] and name in ENDS_P and (place := self._open({"p"}, SCOPE)) is not None:
            self._pop_to(place)
        if name in CLOSES:
            names, until = CLOSES[name]
            while (place := self._open(names, until)) is not None:
                self._pop_to(place)
        if name in ("html", "body") and self._open({name}, ()) is not None:
            return
        if name == "body" and (place := self._open({"head"}, ())) is not None:
            self._pop_to(place)
        if name not in INLINE:
            self._end_block()
        above = self.stack[-1]
        step, outside = name, 2 * (name in OUTSIDE)
        if rest and not rest.isspace():
            found = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(rest)}
            classes = entities.unescape(found.get("class", ""))
            general = sorted({re.sub(r"[\d_-]*\d[\w-]*|[>.]", "", c) for c in classes.split()} - {""})
            step = ".".join([name, *general])
            hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true"
            if hidden or found.get("role", "").lower() in ROLES or _HIDDEN.search(found.get("style", "")):
                outside = 2
            elif name not in ("html", "body", "main") and not outside:
                outside = int(marked(f"{classes} {found.get('id', '')}"))
        if name == "header":
            outside = 0 if self.open["article"] or self.open["main"] else 2
        k = len(self.tag)
        self.tag.append(name)
        self.parent.append(above)
        self.step.append("" if name in INLINE else step)
        self.outside.append(outside)
        self.stack.append(k)
        self.open[name] += 1
        self.links += name == "a"

    def _end(self, name: str) -> None:
        if name == "br":
            self.pieces.append(" ")
            return
        if name in ("body", "html"):
            return self._end_block()  # what follows still belongs to the body
        if not self.open[name]:
            return
        until = SCOPE - {name} if name in ("p", "li", "dt", "dd") else ()
        inline = name in INLINE
        for place in range(len(self.stack) - 1, 0, -1):
            tag = self.tag[self.stack[place]]
            if tag == name:
                if inline:
                    self._drop_from(place)
                else:
                    self._pop_to(place)
                return
            if tag in until or (inline and tag not in INLINE):
                return

    def letters(self) -> tuple[list[int], list[bool]]:
        """Article letters below each element, and which elements are outside an article.

        Letters in links do not count, nor do blocks with more of them than others. An element marked
        by its name that holds the page's article or main element is a wrapper and stays. If nothing
        is left, names do not count, then letters in links do.
        """
        n = len(self.tag)
        holds = [False] * n
        for k in range(n - 1, 0, -1):
            holds[k] = holds[k] or (self.tag[k] in ("article", "main") and not self.outside[k])
            holds[self.parent[k]] = holds[self.parent[k]] or holds[k]
        for names, links in ((True, False), (False, False), (True, True), (False, True)):
            gone, letters = [False] * n, [0] * n
            for k in range(1, n):
                own = self.outside[k] == 2 or (names and self.outside[k] == 1 and not holds[k])
                gone[k] = own or gone[self.parent[k]]
            for k, _, size, linked in self.blocks:
                if not gone[k] and (links or 2 * linked <= size):
                    letters[k] += size if links else size - linked
            for k in range(n - 1, 0, -1):
                letters[self.parent[k]] += letters[k]
            if letters[0]:
                break
        return letters, gone

    def choice(self, letters: list[int], gone: list[bool]) -> int | None:
        """The container of the article as this page alone shows it."""
        if not letters[0]:
            return None
        live = [k for k in range(1, len(self.tag)) if letters[k] and not gone[k]]
        for names in (("article",), ("main",)):
            best = max((k for k in live if self.tag[k] in names), key=lambda k: (letters[k], -k), default=None)
            if best is not None and letters[best] >= ARTICLE_SHARE * letters[0]:
                return best
        below: dict[int, list[int]] = {}
        for k in live:
            if self.tag[k] not in INLINE:
                below.setdefault(self._block_parent(k), []).append(k)
        at = 0
        while at in below:
            best = max(below[at], key=lambda k: (letters[k], -k))
            if letters[best] < DOMINANT * letters[at] or (at and self.tag[best] not in CONTAINERS):
                break
            at = best
        return at

    def _block_parent(self, k: int) -> int:
        k = self.parent[k]
        while k and self.tag[k] in INLINE:
            k = self.parent[k]
        return k

    def path(self, k: int) -> str:
        """Tags and general class names from the root to an element."""
        steps = []
        while k > 0:
            steps.append(self.step[k])
            k = self.parent[k]
        return ">".join(step for step in reversed(steps) if step)

    def on_path(self, path: str) -> list[int]:
        """The elements on a path, in page order."""
        steps = path.split(">")
        met, found = [0] * len(self.tag), []
        for k in range(1, len(self.tag)):
            above = met[self.parent[k]]
            if self.step[k] == "":
                met[k] = above if above < len(steps) else -1
            else:
                met[k] = above + 1 if 0 <= above < len(steps) and steps[above] == self.step[k] else -1
                if met[k] == len(steps):
                    found.append(k)
        return found

    def text(self, inside: list[bool], gone: list[bool]) -> str:
        return " ".join(text for k, text, *_ in self.blocks if inside[k] and not gone[k])


def vote(html: str) -> str | None:
    """The path of the page's article container; none where it has no text."""
    page = Page(html)
    best = page.choice(*page.letters())
    return page.path(best) if best else None


def extract(html: str, path: str | None) -> str:
    """The article's text, from the containers on `path` or else from the page's own choice."""
    page = Page(html)
    letters, gone = page.letters()
    on = [k for k in page.on_path(path) if letters[k] and not gone[k]] if path else []
    if not on:
        own = page.choice(letters, gone)
        on = [] if own is None else [own]
    most = max((letters[k] for k in on), default=0)
    inside = [False] * len(page.tag)
    for k in on:
        inside[k] = letters[k] >= ALONGSIDE * most
    for k in range(1, len(inside)):
        inside[k] = inside[k] or inside[page.parent[k]]
    return page.text(inside, gone)


def host(url="url"):
    """The host of an address in lower case without port; null where there is none."""
    found = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(found, F.lit(""))


def page_votes(pages: DataFrame) -> DataFrame:
    """(host, path): one row for each page with a host and text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            paths = [vote(t) for t in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("host"), pa.array(paths, pa.string())], ["host", "path"])

    rows = pages.select(host().alias("host"), "html").where("host is not null and html is not null")
    return rows.mapInArrow(work, "host string, path string").where("path is not null")


def host_paths(pages: DataFrame) -> DataFrame:
    """The path with most votes of each host; of equal ones the first by name."""
    count = page_votes(pages).groupBy("host", "path").agg(F.count("*").alias("n"))
    ranked = count.groupBy("host").agg(F.min(F.struct((-F.col("n")).alias("less"), "path")).alias("best"))
    return ranked.select("host", F.col("best.path").alias("path"))


def extract_pages(pages: DataFrame, winners: DataFrame | None = None) -> DataFrame:
    """page_id, url and text of each page.

    `winners` are the host paths to go by (`host_paths` of the same pages if not given). Decoded text
    of a block has single spaces and blocks are joined by one. Menus, headers, footers, sidebars,
    notices, adverts, forms, scripts, styles and reader comments are left out by element, role and
    class names; headings of the article stay. Null and empty pages, and pages without text, give ''.
    Rows with the same id are pages of their own; other columns are not read; no page, host or block
    is capped. Hosts may be hot: votes are counted before they are shuffled, and the table of winners
    goes to the tasks as long as it is small (measured), else pages are dealt out by host and salt.
    """
    if winners is None:
        winners = write_once(host_paths(pages), scratch_path(pages.sparkSession, "host-paths"))
    kind = dict(pages.dtypes)["page_id"]
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("host", host())
    size = winners.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("host") + F.length("path")), F.lit(0)).alias("b"))
    size = size.first()
    if size["n"] <= BROADCAST_ROWS and size["b"] <= BROADCAST_BYTES:
        met = rows.join(F.broadcast(winners), "host", "left")
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        dealt = rows.withColumn("salt", F.pmod(F.xxhash64("url", "page_id"), F.lit(SALTS)).cast("int"))
        met = dealt.join(winners.select("*", salts.alias("salt")), ["host", "salt"], "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            pairs = zip(part.column("html").to_pylist(), part.column("path").to_pylist(), strict=True)
            texts = [extract(t, path) for t, path in pairs]
            columns = [part.column("page_id"), part.column("url"), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text"])

    return met.select("page_id", "url", "html", "path").mapInArrow(work, f"page_id {kind}, url string, text string")
