"""Main text of HTML pages by text-to-tag ratios.

The standard library's parser streams events; a line is the text between two
block boundaries, its ratio the text's length over the tags within. The ratios
are smoothed by a Gaussian over the neighbouring lines and split by a two-means
threshold. The lines above it that aren't in an element set apart (menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles, comments) elect the
content region: the lowest element that holds them all, raised to the main element
(else the article) it is in. In an article or main element every line counts that
isn't set apart; elsewhere in the region lines below the threshold that are mostly
links go too.

Defined results: null, empty and textless pages give "" and 0; broken and cut off
markup is read as far as it goes; repeated rows give equal texts; every further
column passes through.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_from_text, table

SIGMA, LINK_SHARE = 1.5, 0.5

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav "
    "ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split())
APART = frozenset(
    "aside button canvas dialog footer head header iframe input label menu nav noscript object "
    "script select style svg template textarea".split())
#: Elements that can be a content region.
REGIONS = frozenset("article body center div main section td".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag here ends an open element of these kinds, up to the element that bounds it.
IMPLIED = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)),
           "dd": (("dt", "dd"), ("dl",)), "td": (("td", "th"), ("tr", "table")),
           "th": (("td", "th"), ("tr", "table")), "tr": (("tr",), ("table",))}
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation "
                  "search toolbar".split())
#: Names, or first parts of them, that set an element apart wherever it is.
_NAMES = re.compile(
    r"(?:^|[-_\s])(?:ads?|advert\w*|breadcrumbs?|comment(?!ar)\w*|consent|cookie\w*|discussion|disqus|footer|"
    r"masthead|menu|modal|nav|navbar|navigation|newsletter|pagination|pager|popup|promo\w*|"
    r"replies|respond|sidebar|sponsor\w*|subscribe|toolbar)(?:$|[-_\s])", re.I)
#: Names that do so alone or with one of these parts; with others an element in an article is only suspect.
_LOOSE = re.compile(r"(?:^|[-_\s])(?:banner|notices?|related|share|sharing|social|widget)(?:$|[-_\s])", re.I)
_PARTS = frozenset("area articles bar box buttons content icons items links list news pages panel posts section stories "
                   "videos wrap wrapper banner notice notices related share sharing social widget".split())
FORM_SHARE = 0.5
#: The state outside of all elements.
NOWHERE = (False, 0, 0)


class Lines(HTMLParser):
    """The page's lines: text, tags, letters within links, number of the element, its state.

    A state is (set apart, numbers of the outermost form and the outermost suspect element around)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, tuple[bool, int, int]]] = []  # tag, number, state
        self.places: dict[str, list[int]] = {}  # of each tag's open elements in the stack
        self.blocks: list[int] = []  # places of the open blocks
        # by element: the one around it, tag, last number within, whether in an article or main element
        self.parent, self.tag, self.last, self.within = [-1], [""], [0], [False]
        self.lines: list[tuple[str, int, int, int, tuple[bool, int, int]]] = []
        self.text: list[str] = []
        self.tags = self.linked = 0

    def _where(self):
        return self.stack[-1][1:] if self.stack else (0, NOWHERE)

    def _open(self, tag) -> int:
        """The place of the innermost open element of a tag, -1 if there is none."""
        held = self.places.get(tag)
        return held[-1] if held else -1

    def _flush(self):
        text = " ".join("".join(self.text).split())
        if text:
            self.lines.append((text, self.tags, self.linked, *self._where()))
        self.text, self.tags, self.linked = [], 0, 0

    def _pop(self, at: int):
        left = self.stack[at - 1][2] if at else NOWHERE
        if any(t in BLOCK or x != left for t, _, x in self.stack[at:]):
            self._flush()
        for t, number, _ in self.stack[at:]:
            self.last[number] = len(self.tag) - 1
            self.places[t].pop()
            if t in BLOCK:
                self.blocks.pop()
        del self.stack[at:]

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self._flush()
            if self.blocks and self.stack[self.blocks[-1]][0] == "p" and tag not in ("html", "body"):
                self._pop(self.blocks[-1])
            ends, bounds = IMPLIED.get(tag, ((), ()))
            at = max(map(self._open, ends), default=-1)
            if at > max(map(self._open, bounds), default=-1):
                self._pop(at)
        self.tags += 1
        if tag == "br":
            self.text.append(" ")
        if tag in VOID:
            return
        number, state = self._where()
        inside = self.within[number]
        new = self._state(tag, dict(attrs), state, inside, len(self.tag))
        if new != state:
            self._flush()
        self.parent.append(number)
        self.tag.append(tag)
        self.last.append(0)
        self.within.append(inside or tag in ("article", "main"))
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag in BLOCK:
            self.blocks.append(len(self.stack))
        self.stack.append((tag, len(self.tag) - 1, new))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCK:
            self.handle_endtag(tag)

    def _state(self, tag, attrs, state, inside, number):
        apart, form, suspect = state
        if apart:
            return state
        if tag == "form":
            return False, form or number, suspect
        if tag in APART:
            return (tag != "header" or not inside), form, suspect
        if tag in ("html", "body", "article", "main") or tag in HEADINGS:
            return state
        style = (attrs.get("style") or "").replace(" ", "").lower()
        names = [attrs.get(a) or "" for a in ("class", "id")]
        if ("hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in style
                or (attrs.get("role") or "").lower() in ROLES or any(map(_NAMES.search, names))):
            return True, form, suspect
        loose = [n for x in names for n in x.split() if _LOOSE.search(n)]
        if any(all(part in _PARTS for part in re.split("[-_]", n.lower())) for n in loose) or loose and not inside:
            return True, form, suspect
        return False, form, suspect or (number if loose else 0)

    def handle_endtag(self, tag):
        if tag == "br":
            self.text.append(" ")
        at = self._open(tag)
        if at >= 0:
            self._pop(at)
        elif tag in BLOCK:
            self._flush()

    def handle_data(self, data):
        self.text.append(data)
        if self.places.get("a"):
            self.linked += len(data)

    def close(self):
        super().close()
        self._flush()
        for number in (0, *(n for _, n, _ in self.stack)):
            self.last[number] = len(self.tag) - 1


def smoothed(x: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian mean over neighbours, with weights that add up to 1 at the ends too."""
    r = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    return (np.convolve(x, kernel)[r:r + len(x)] / np.convolve(np.ones(len(x)), kernel)[r:r + len(x)])


def threshold(x: np.ndarray) -> float:
    """Border of two means of the values; with one value only, that value."""
    low, high = float(x.min()), float(x.max())
    while True:
        cut = (low + high) / 2
        above = x >= cut
        if above.all():
            return cut
        new = float(x[~above].mean()), float(x[above].mean())
        if new == (low, high):
            return cut
        low, high = new


def main_text(html: str) -> str:
    """The page's main text, a line for each block."""
    parser = Lines()
    parser.feed(html)
    parser.close()
    lines, parent, tag, end = parser.lines, parser.parent, parser.tag, parser.last
    letters: dict[int, int] = {}
    for text, _, _, _, (apart, form, _) in lines:
        if not apart:
            letters[form] = letters.get(form, 0) + len(text)
    total = sum(letters.values())
    out = {form for form, n in letters.items() if form and n < FORM_SHARE * total}  # forms that are set apart
    free = [i for i, x in enumerate(lines) if not x[4][0] and x[4][1] not in out]
    if not free:
        return ""
    ratios = np.zeros(len(lines))
    ratios[free] = [len(lines[i][0]) / max(1, lines[i][1]) for i in free]
    smooth = np.log1p(smoothed(ratios))
    content = smooth >= threshold(smooth[free])
    held = [lines[i][3] for i in free if content[i]]
    # the lowest element around all is that around the first and the last
    region, last = min(held), max(held)
    while end[region] < last or tag[region] not in REGIONS and region:
        region = parent[region]
    around, outer = region, {}
    while around >= 0:
        outer[tag[around]] = around
        around = parent[around]
    region = outer.get("main", outer.get("article", region))

    main: dict[int, list[int]] = {}  # of each suspect element: letters, those above the threshold, those in links
    for i in free:
        held = main.setdefault(lines[i][4][2], [0, 0, 0])
        held[0] += len(lines[i][0])
        held[1] += len(lines[i][0]) * int(content[i])
        held[2] += lines[i][2]

    def counts(i: int) -> bool:
        text, _, linked, at, (_, _, suspect) = lines[i]
        n, above, links = main[suspect]
        if suspect and (2 * above < n or links > LINK_SHARE * n):
            return False
        return region <= at <= end[region] and bool(content[i] or parser.within[at] or linked <= LINK_SHARE * len(text))

    return "\n".join(lines[i][0] for i in free if counts(i))


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``row`` (all columns of ``pages``) and ``main_text``."""
    def make():
        return lambda texts: [[main_text(t) for t in texts]]

    return add_from_text(pages, html, "main_text string", make)


def query(spark, sf_dir):
    """The main text of every page."""
    found = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select(F.col("row.page_id").alias("page_id"), F.col("row.url").alias("url"),
                        F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))
