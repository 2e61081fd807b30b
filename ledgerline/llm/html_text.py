"""Main text of web pages: parser events, text-to-tag ratios, Gaussian smoothing and a threshold between two clusters.

The standard library's parser is fed a page in pieces and sends events. Text gathers in lines, one to each block element.
Tags, roles and hidden attributes that can hold no article (menus, footers, forms, scripts, styles) exclude what is in
them. Names in class and id exclude nothing: an element that has one is a zone of its own, in which a character counts
for a thousandth, unless it holds an article, main or most of the text outside links.

What is content is decided by ratios. Each line has a ratio of its characters, those in links at a tenth, to the tags met
with it. Ratios are smoothed along the page by a Gaussian that does not reach across the border of a zone, and split in
two clusters by a threshold at their standard deviation; the upper one is the seeds, but for lines that owe their place to
their neighbours alone: links, and what is under the threshold itself and no heading, unless it has a quarter of it and the
same parent as a line above it. A zone without a seed goes. The text is
the region from the first to the last line that is a seed or stands in an article or main that has one, or in one beside
it, with the lines around it that share a parent with those, or a block around a list, and the heading of a list; all lines of
the region are kept, short ones included. So names in class and id do decide what becomes of a zone that is neither an
article nor most of the page.
"""

from __future__ import annotations

import re
from collections import defaultdict
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from . import common

PIECE = 1 << 16
SIGMA = 1.0
IN_LINKS, IN_ZONES, OWN_SHARE = 0.1, 0.001, 0.25

BLOCKS = frozenset("address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUTSIDE = frozenset("nav header footer aside button select textarea script style noscript template iframe svg head title dialog object canvas audio video".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
#: Parts of class and id values, split at anything but letters, that name what is no article.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement adbox adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification alert "
    "sidebar side nav navbar navigation menu breadcrumb breadcrumbs pagination pager header masthead footer share sharing social related recommended newsletter subscribe "
    "signup login popup modal overlay comment comments disqus replies reply respond widget toolbar skip copyright disclaimer".split()
)
#: Beside one of these a name tells of something elsewhere, as in no-sidebar.
MODIFIERS = frozenset("with without no not non has".split())
#: Inside an article, on headings, and beside what names an article's own parts, these are the text's own heading.
HEADINGS = frozenset("header masthead banner".split())
OWNERS = frozenset("article post entry story content".split())
OF_ARTICLES = frozenset("ad ads advert advertisement sponsored promo promotion related recommended comment comments reply replies".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
HEADING_TAGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LISTS, TABLES = ("ul", "ol", "dl", "menu", "table", "select"), ("table", "select")
#: Blocks that only arrange others, and blocks of running text.
LISTING = frozenset("ul ol dl menu li dt dd table thead tbody tfoot tr td th".split())
PARAGRAPHS = HEADING_TAGS | frozenset("p pre blockquote address li dt dd body html".split())

_part = re.compile(r"[a-z]+")
_camel = re.compile(r"(?<=[a-z])(?=[A-Z])")
_white = re.compile(r"\s+")


def _outside(tag: str, attrs: list) -> bool:
    if tag in OUTSIDE:
        return True
    for key, value in attrs:
        if key == "role" and value and not ROLES.isdisjoint(value.lower().split()):
            return True
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and value and "display:none" in value.replace(" ", "").lower()):
            return True
    return False


def _hints(tag: str, attrs: list, in_article: bool) -> set[str]:
    """The names in class and id, or a form, that hint at what is no article."""
    found: set[str] = {"form"} if tag == "form" else set()
    if tag in ("html", "body", "main"):
        return found
    for key, value in attrs:
        if key in ("class", "id") and value:
            for name in value.split():
                parts = set(_part.findall(_camel.sub(" ", name).lower()))
                if MODIFIERS.isdisjoint(parts):
                    hints = parts & (OF_ARTICLES if tag == "article" else NAMES)
                    own = in_article or tag in HEADING_TAGS or not OWNERS.isdisjoint(parts)
                    found |= hints - HEADINGS if own else hints
    return found


class Lines(HTMLParser):
    """Gathers lines from events: (parts, tags, article, group, parent, around, heading).

    A part is (text, the innermost hinted element around it, whether in a link); ``parts`` is empty for what is excluded.
    ``article`` numbers the innermost article or main, ``group`` the block around the outermost one, -1 for none, 
    ``parent`` the block around the line's own, ``around`` the nearest that is no list or table, and ``heading`` is whether its own is one.
    The page itself is a parent, 0, of paragraphs only: other blocks in it have nothing to do with each other. Open elements
    are also listed by tag, so no event walks the stack.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, int, int, int, int, bool]] = []  # tag, outside, article, group, number, hinted, in a link
        self.open: dict[str, list[int]] = defaultdict(list)  # where each tag is in the stack
        self.blocks: list[int] = []  # where blocks are
        self.arounds: list[int] = []  # for each of them the nearest one that is no list, itself included
        self.lines: list[tuple[list, int, int, int, int, int, bool]] = []
        self.parts: list[tuple[str, int, bool]] = []
        self.hinted: list[tuple[int, bool, bool]] = [(0, False, False)]  # the one around it, in an article, names of OF_ARTICLES only
        self.free: list[int] = [0]  # characters outside links, directly in each of hinted
        self.articles: dict[int, tuple[int, bool]] = {}  # the hinted around it, whether main
        self.filled: set[int] = set()  # articles that have text
        self.tags, self.count, self.dark, self.spot, self.menu = 0, 0, False, (0, -1, 0, 0, False), False

    def innermost(self, tags) -> int:
        """Where the innermost open element of one of ``tags`` is in the stack, -1 if there is none."""
        return max((self.open[t][-1] for t in tags if self.open.get(t)), default=-1)

    def parent(self, up: int) -> int:
        """The number of the ``up``-th open block from within; 0 for the body, the page or none."""
        if len(self.blocks) < up:
            return 0
        tag, *_, number, _, _ = self.stack[self.blocks[-up]]
        return 0 if tag in ("html", "body") else number

    def place(self) -> tuple[int, int, bool]:
        """parent, around and heading of a line that begins here."""
        tag, *_, number, _, _ = self.stack[self.blocks[-1]] if self.blocks else ("body", 0, 0, 0)
        parent = self.parent(2)
        return parent if parent or tag in PARAGRAPHS else -number, self.arounds[-2] if len(self.blocks) > 1 else 0, tag in HEADING_TAGS

    def flush(self) -> None:
        if self.menu and all(link for *_, link in self.parts):  # a menu that leads elsewhere
            self.dark, self.parts = self.dark or bool(self.parts), []
        if self.parts or self.dark:
            self.lines.append((self.parts, self.tags, *self.spot))
            self.tags, self.dark = 0, False
        self.parts = []

    def close(self) -> None:
        super().close()
        self.flush()

    def zones(self) -> list[int]:
        """The zone of each hinted element: itself, or that of the one around it if it holds an article or most of the text."""
        n = len(self.hinted)
        free, holds, main = list(self.free), [0] * n, [False] * n
        for number, (around, is_main) in self.articles.items():
            if number in self.filled:
                holds[around] += 1
                main[around] |= is_main
        total, articles, apart = sum(free), sum(holds), [False] * n
        left = total
        for k in range(n - 1, 0, -1):  # innermost first: what is inside comes after
            around, in_article, of_articles = self.hinted[k]
            most = free[k] > 0 and 2 * free[k] >= (total if of_articles else left) and not (in_article and of_articles)
            if main[k] or holds[k] and (most or not of_articles) or most and (in_article or not articles):
                free[around] += free[k]
                holds[around] += holds[k]
                main[around] |= main[k]
            else:
                apart[k] = True
                left -= free[k]
        zones = [0] * n
        for k in range(1, n):
            zones[k] = k if apart[k] else zones[self.hinted[k][0]]
        return zones

    def pop_to(self, k: int) -> None:
        while len(self.stack) > k:
            tag = self.stack.pop()[0]
            self.open[tag].pop()
            if tag in BLOCKS:
                self.blocks.pop()
                self.arounds.pop()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCKS:
            self.flush()
            if tag not in ("html", "body") and self.blocks and self.stack[self.blocks[-1]][0] == "p":
                self.pop_to(self.blocks[-1])  # a block ends the paragraph before it
        if tag in SIBLINGS:
            at = self.innermost(SIBLINGS[tag])
            if at > self.innermost(LISTS if tag in ("li", "dt", "dd") else TABLES):
                self.flush()
                self.pop_to(at)
        self.tags += 1
        if tag == "br":
            self.handle_data("\n")
        if tag in VOID:
            return
        _, outside, article, group, _, hinted, link = self.stack[-1] if self.stack else ("", False, 0, -1, 0, 0, False)
        self.count += 1
        # an article's own heading is not the page's
        outside = outside or (_outside(tag, attrs) and not (tag == "header" and article))
        hints = set() if outside else _hints(tag, attrs, article > 0)
        if hints:
            self.hinted.append((hinted, article > 0, hints <= OF_ARTICLES))
            self.free.append(0)
            hinted = len(self.hinted) - 1
        if tag in ("article", "main") and not outside:
            group = self.parent(1) if group < 0 else group
            article = self.count
            if not hints:
                self.articles[article] = hinted, tag == "main"
        self.open[tag].append(len(self.stack))
        if tag in BLOCKS:
            self.blocks.append(len(self.stack))
            self.arounds.append(0 if tag in ("html", "body") else self.count if tag not in LISTING else self.arounds[-1] if self.arounds else 0)
        self.stack.append((tag, outside, article, group, self.count, hinted, link or tag == "a"))

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
        at = self.innermost((tag,))
        if at >= 0 and (tag in BLOCKS or tag in OUTSIDE or not self.blocks or at > self.blocks[-1]):  # a stray inline end tag does not close blocks
            self.pop_to(at)

    def handle_data(self, data: str) -> None:
        _, outside, article, group, _, hinted, link = self.stack[-1] if self.stack else ("", False, 0, -1, 0, 0, False)
        blank = data.isspace()
        if outside:
            self.dark = self.dark or not blank
            return
        if not self.parts:
            if blank:
                return
            self.spot, self.menu = (article, group, *self.place()), bool(self.open["menu"])
        self.parts.append((data, hinted, link))
        if not link:
            self.free[hinted] += len(data.strip())
        if article and not blank:
            self.filled.add(article)


def smooth(ratios: np.ndarray, zones: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """``ratios`` smoothed by a Gaussian over their places; only those of the same zone, and excluded lines (-1), take part."""
    reach = max(1, int(3 * sigma))
    total, mass = np.zeros(len(ratios)), np.zeros(len(ratios))
    for d in range(-reach, reach + 1):
        to, at = slice(max(0, -d), len(ratios) - max(0, d)), slice(max(0, d), len(ratios) - max(0, -d))
        if abs(d) < len(ratios):
            weight = np.exp(-0.5 * (d / sigma) ** 2) * ((zones[at] == zones[to]) | (zones[at] < 0))
            total[to] += weight * ratios[at]
            mass[to] += weight
    return total / mass


def seeds(smoothed: np.ndarray, ratios: np.ndarray, zones: np.ndarray, headings: np.ndarray, linked: np.ndarray, parents: np.ndarray) -> np.ndarray:
    """Which are of the upper cluster, not below the standard deviation of all, and there not by their neighbours alone: smoothing carries over to
    what stands beside content, though not into another zone. What would not be there by its own ratio needs a quarter of the threshold and a
    line with the same parent that would, or is a heading."""
    cut = smoothed.std() * (1 - 1e-9)
    upper = (zones >= 0) & (smoothed >= cut)
    strong = upper & (ratios >= cut) & ~linked
    near = np.isin(parents, parents[strong]) | (not strong.any())
    upper &= (ratios >= cut) | headings | (zones > 0) | (near & (ratios >= OWN_SHARE * cut))
    return upper & ~linked if (upper & ~linked).any() else upper


def main_text(html: str, sigma: float = SIGMA) -> str:
    page = Lines()
    for k in range(0, len(html), PIECE):
        page.feed(html[k : k + PIECE])
    page.close()
    zones = page.zones()
    cells: list[tuple[int, int, float, bool, bool, int]] = []  # line, zone, ratio, heading, links only: a line's text in one zone
    for k, (parts, tags, _, _, parent, _, heading) in enumerate(page.lines):
        size: dict[int, float] = {}
        free: set[int] = set()
        for text, hinted, link in parts:
            zone, n = zones[hinted], len(text.strip())
            size[zone] = size.get(zone, 0.0) + n * (IN_LINKS if link else 1.0) * (IN_ZONES if zone else 1.0)
            if n and not link:
                free.add(zone)
        cells += [(k, zone, n / max(1, tags), heading, zone not in free, parent) for zone, n in size.items()] or [(k, -1, 0.0, False, True, 0)]
    if not cells:
        return ""
    of_line, of_zone, ratios, headings, linked, of_parent = (np.array(x) for x in zip(*cells))
    ratios = ratios.astype(float)
    seed = seeds(smooth(ratios, of_zone, sigma), ratios, of_zone, headings, linked, of_parent)
    kept_zones = {0} | set(of_zone[seed].tolist())
    seeded = set(of_line[seed].tolist())
    texts = ["".join(text for text, hinted, _ in parts if zones[hinted] in kept_zones) for parts, *_ in page.lines]
    inside = [(k, _white.sub(" ", t).strip()) for k, t in enumerate(texts) if t and not t.isspace()]
    groups = {page.lines[k][3] for k in seeded} - {-1}
    at = [n for n, (k, _) in enumerate(inside) if k in seeded or page.lines[k][3] in groups]
    if not at:
        return ""
    parents = {page.lines[k][4] for k in seeded if page.lines[k][3] < 0} | groups - {0}
    arounds = {page.lines[k][5] for k in seeded if page.lines[k][3] < 0} - {0}
    free = set(of_line[~linked].tolist())  # lines that are not links only

    def goes_on(n: int, beside: int) -> bool:
        """Whether a line next to the region belongs to it: by its parent, by the block around a list, or as the heading of one."""
        k = inside[n][0]
        *_, parent, around, heading = page.lines[k]
        return parent in parents or (around in arounds and k in free) or (heading and beside > n and parent == page.lines[inside[beside][0]][5])

    first, last = at[0], at[-1]
    while first and goes_on(first - 1, first):
        first -= 1
    while last + 1 < len(inside) and goes_on(last + 1, last):
        last += 1
    return "\n".join(t for _, t in inside[first : last + 1])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars.

    Null or empty html, and pages without a line of text outside menus and the like, give an empty text. Repeated rows give
    a row each; an empty table gives none; other columns are ignored. No shuffle.
    """
    view = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"), pages[html_col].cast("string").alias("html"))

    def batches(parts):
        for part in common.sliced(parts):
            texts = [main_text(x) if x else "" for x in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    schema = T.StructType([*view.schema.fields[:2], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return view.mapInArrow(batches, schema)


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(common.table(spark, sf_dir, "pages"))
