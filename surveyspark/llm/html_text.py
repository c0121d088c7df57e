"""Main text of web pages: parser events, text-to-tag ratio per line, Gaussian smoothing and threshold clustering.

A page is fed to the standard library's event parser once. The events become lines (block elements), each with its text,
its number of tags and its innermost container; containers are numbered in page order, so one lies in another if its number
is in the other's stretch. The text-to-tag ratios of the lines, in page order, are smoothed with a Gaussian; the lines at or
above the mean ratio less a share of the deviation, and all of prose (``PLAIN`` letters a tag), form the content cluster. The
cluster only chooses the content region: the outermost article or main elements that hold it, or, if it lies elsewhere, the
smallest container that holds all of it. Every line of the region stays, short ones too. Menus, headers, footers, sidebars,
notices, adverts, forms and comments never become content: their elements (by tag, role, class or id) take part in the ratios
but not in the region; marked inline elements lose their text. A form, or a part left out by role, class or id, is content after
all if it holds the page's only articles, or the greater part of the text of a page that has no article beside or around it.

Defined cases: null, empty and text-free pages give an empty text; unclosed and stray tags are tolerated; declarations of an
unknown kind are comments, and comments and tags that nothing closes reach to the end; what the parser refuses ends the page
there; repeated pages each give their row; further columns of the input are ignored. Costs grow in proportion to a page.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_pandas

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody "
    "tfoot thead title tr ul".split()
)
CONTAINERS = frozenset(
    "article aside body center details dialog div fieldset figure footer form head header hgroup main menu nav "
    "noscript ol search section select svg table td template th ul button iframe object textarea".split()
)
NEVER = frozenset(
    "aside button dialog footer form head iframe menu nav noscript object search select svg template textarea".split()
)
RAW = frozenset("script style".split())
#: Elements without an end.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
MARKS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer header masthead menu modal nav navbar navigation newsletter notice popup promo promoted related "
    "share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
ROOTS = frozenset(("article", "main"))
#: Left out by tag, but as content when a page is built inside them.
SOFT = frozenset("dialog form".split())
#: Parts that may stand beside the marks in a class name; further parts, such as those of has-sidebar, make it no mark.
BESIDE = frozenset(
    "area bar block bottom box button buttons container content desktop form global icons inner item items left link links list "
    "main mobile posts primary right row secondary section signup site slot top unit wrapper".split()
)
COMMENT = frozenset("comment comments commentlist commentform replies respond".split())
STATES = frozenset("allow closed count disabled enabled has hide is no off on open show status with without".split())
SPACE = re.compile(r"\s+")
SPLIT = re.compile(r"[^a-z0-9]+")
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
SHORT_COMMENT, COMMENT_END = re.compile(r"<!---?>"), re.compile(r"--!?>")
#: Share of the content cluster's text that articles and mains must hold to be the region, smoothing width in lines, the
#: threshold's place below the mean in deviations, and letters a tag of what is prose in any case.
HOLDS, SIGMA, BELOW, PLAIN = 0.9, 1.0, 0.5, 40
#: Blocks that are containers when their class or id marks them; the next one of these ends an open one.
MARKABLE = frozenset("p h1 h2 h3 h4 h5 h6 li dl dt dd tr blockquote pre address figcaption".split())
#: Parts that an article ends when it starts in them, as if they were unclosed.
ENDED = frozenset("nav head header menu aside".split())
#: Marks that inside an article name its own heading.
HEADING = frozenset("header masthead".split())


def names_of(attrs: list[tuple[str, str | None]]) -> list[list[str]]:
    """The parts of each class name and id, also at changes of case."""
    whole = (w for k, v in attrs if v and k in ("class", "id") for w in CAMEL.sub("-", v).lower().split())
    return [[p for p in SPLIT.split(w) if p] for w in whole]


def is_mark(name: list[str]) -> bool:
    return not MARKS.isdisjoint(name) and all(p in MARKS or p in BESIDE for p in name)


def is_comment(name: list[str]) -> bool:
    return bool(name) and (name[0] in COMMENT or name[-1] in COMMENT) and STATES.isdisjoint(name)


class Lines(HTMLParser):
    """Collects (text, tags, container, outside) per line; outside: in a part to leave out.

    ``ends[c]`` is the last container inside container c, ``up[c]`` the one around it (0: none). Parts that may turn out to be content are in ``soft`` (container:
    whether of comments) instead.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, bool]] = []
        self.open: list[tuple[str, int, bool]] = []
        self.tag_count: Counter[str] = Counter()
        self.out_count = self.root_count = 0
        self.ended: list[int] = []
        self.parts: list[str] = []
        self.tags = 0
        self.raw = False
        self.ends: list[int] = [0]
        self.up: list[int] = [0]
        self.roots: set[int] = set()
        self.soft: dict[int, bool] = {}
        self.muted: list[str] = []

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else len(self.rawdata)

    def parse_comment(self, i: int, report: int = 1) -> int:
        if (short := SHORT_COMMENT.match(self.rawdata, i)) is not None:
            return short.end()
        end = COMMENT_END.search(self.rawdata, i + 4)
        return end.end() if end else len(self.rawdata)

    def parse_html_declaration(self, i: int) -> int:
        return self.parse_marked_section(i)

    def parse_pi(self, i: int) -> int:
        return self.parse_marked_section(i)

    def parse_endtag(self, i: int) -> int:
        return k if (k := super().parse_endtag(i)) >= 0 else len(self.rawdata)

    def parse_starttag(self, i: int) -> int:
        return k if (k := super().parse_starttag(i)) >= 0 else len(self.rawdata)

    def cut(self) -> None:
        self.muted.clear()  # an inline element ends with its block
        if self.parts:
            text = SPACE.sub(" ", "".join(self.parts)).strip()
            self.parts.clear()
            if text:
                self.lines.append((text, self.tags, self.open[-1][1] if self.open else 0, self.out_count > 0))
                self.tags = 0

    def enter(self, tag: str, left_out: bool) -> int:
        c = len(self.ends)
        self.ends.append(c)
        self.up.append(self.open[-1][1] if self.open else 0)
        if tag in ENDED and left_out:
            self.ended.append(len(self.open))
        self.open.append((tag, c, left_out))
        self.tag_count[tag] += 1
        self.out_count += left_out
        self.root_count += tag in ROOTS
        return c

    def leave_to(self, depth: int) -> None:
        last = len(self.ends) - 1
        while len(self.open) > depth:
            tag, c, left_out = self.open.pop()
            self.ends[c] = last
            self.tag_count[tag] -= 1
            self.out_count -= left_out
            self.root_count -= tag in ROOTS
        while self.ended and self.ended[-1] >= depth:
            self.ended.pop()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in RAW:
            self.raw = True
            return
        if tag in BLOCKS or tag in CONTAINERS:
            self.cut()
            if self.open and self.open[-1][0] in MARKABLE and (tag == self.open[-1][0] or self.open[-1][0] == "p"):
                self.leave_to(len(self.open) - 1)
        elif tag in ("br", "td", "th"):
            self.parts.append(" ")
        self.tags += 1
        if tag in CONTAINERS:
            names = names_of(attrs)
            comment = tag != "body" and any(map(is_comment, names))
            if tag in ROOTS and not comment:
                # a content root inside an unclosed menu or the like ends that part
                if self.ended:
                    self.leave_to(self.ended[0])
            elif tag == "body":
                self.leave_to(0)
            in_root = self.root_count > 0
            headline = tag == "header" and in_root
            c = self.enter(tag, tag in NEVER and tag not in SOFT and not headline or tag == "header" and not headline)
            if tag in ROOTS and not comment:
                self.roots.add(c)
            role = not headline and any(k == "role" and v in ROLES or k == "hidden" for k, v in attrs)
            marked = tag not in ROOTS and not headline and any(is_mark(x) and not (in_root and HEADING.issuperset(MARKS.intersection(x))) for x in names)
            if tag != "body" and (tag in SOFT or comment or marked or role):
                self.soft[c] = comment
        elif tag in MARKABLE and attrs and any(map(is_mark, names_of(attrs))):
            self.enter(tag, True)
        elif tag not in BLOCKS and tag not in VOID and (self.muted or attrs and any(map(is_mark, names_of(attrs)))):
            self.muted.append(tag)  # a marked inline element, or one in it

    def handle_endtag(self, tag: str) -> None:
        if tag in RAW:
            self.raw = False
            return
        if tag in BLOCKS or tag in CONTAINERS:
            self.cut()
        elif tag in self.muted:
            while self.muted.pop() != tag:
                pass
        if self.tag_count[tag]:
            depth = next(i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == tag)
            self.leave_to(depth)

    def handle_data(self, data: str) -> None:
        if not self.raw and not self.muted:
            self.parts.append(data)

    def finish(self) -> None:
        self.cut()
        self.leave_to(0)


def smooth(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; at the ends the weights inside the page are rescaled."""
    reach = max(1, round(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(ratios, kernel)[reach:-reach] / np.convolve(np.ones(len(ratios)), kernel)[reach:-reach]


Line = tuple[str, int, int, bool]


def marked(chosen: Iterable[int], ends: list[int]) -> np.ndarray:
    """Whether each container lies in one of the chosen."""
    steps = np.zeros(len(ends) + 1, np.int64)
    for c in chosen:
        steps[c] += 1
        steps[ends[c] + 1] -= 1
    return np.cumsum(steps[:-1]) > 0


def around(chosen: set[int], up: list[int], inmost: bool) -> np.ndarray:
    """The inmost or the outermost of the chosen containers around each (itself included), 0 without any."""
    out = [0] * len(up)
    for c in range(1, len(up)):
        above = out[up[c]]
        out[c] = c if c in chosen and (inmost or not above) else above
    return np.array(out)


def left_out(lines: list[Line], ends: list[int], up: list[int], roots: set[int], soft: dict[int, bool]) -> set[int]:
    """Those of the soft parts that are no content."""
    of_comments = marked((c for c, comment in soft.items() if comment), ends)
    rest = [x for x in lines if not x[3] and not of_comments[x[2]]]
    size, number = np.zeros((2, len(ends) + 1), np.int64)
    for text, _, c, _ in rest:
        size[c + 1] += len(text)
        number[c + 1] += 1
    size, number = np.cumsum(size), np.cumsum(number)  # before a container's number
    inmost, last = around(roots, up, True), np.array(ends)
    places = np.array([x[2] for x in rest], np.int64)
    # in an article that has text of its own, or with articles in it, a part's size doesn't matter
    own = np.zeros(len(ends) + 1, np.int64)
    np.add.at(own, places[~marked(soft, ends)[places] & (inmost[places] > 0)] + 1, 1)
    own = np.cumsum(own)
    spoken = lambda c: (r := int(inmost[up[c]])) > 0 and own[ends[r] + 1] > own[r]
    large = {c for c in soft if 2 * (size[ends[c] + 1] - size[c]) > size[-1] and not spoken(c)}
    out = soft.keys() - large
    clean = places[~marked(out, ends)[places] & (inmost[places] > 0)]
    root = inmost[clean]
    for c in large:
        # with articles only beside it, it is no content, however large (an advert longer than a short article)
        inside = (clean >= c) & (clean <= ends[c])
        beside = ~inside & ~((root < c) & (c <= last[root]))
        if beside.any() and not inside.any():
            out.add(c)
    # an article in a part to leave out is a teaser, unless there are none elsewhere
    if out and not (~marked(out, ends)[places] & (inmost[places] > 0)).any():
        full = np.zeros(len(ends) + 1, np.int64)
        for r in roots:
            full[r + 1] = number[ends[r] + 1] > number[r]
        full = np.cumsum(full)
        out = {c for c in out if full[ends[c] + 1] == full[c + 1]}
    return out


def content(lines: list[Line], ends: list[int], up: list[int], roots: set[int], soft: dict[int, bool]) -> list[str]:
    """The lines of the content region; roots: the article and main elements."""
    if soft and (out := left_out(lines, ends, up, roots, soft)):
        no = marked(out, ends)
        lines = [(text, tags, c, gone or bool(no[c])) for text, tags, c, gone in lines]
    inside = [x for x in lines if not x[3]]
    if not inside:
        return []
    ratio = smooth(np.array([len(text) / max(1, tags) for text, tags, _, _ in lines]))
    cut = min(ratio.mean() - BELOW * ratio.std(), PLAIN)
    chosen = [x for x, r in zip(lines, ratio, strict=True) if r >= cut and not x[3]] or inside
    outermost = around(roots, up, False)
    held: dict[int, int] = {}
    for text, _, c, _ in chosen:
        held[int(outermost[c])] = held.get(int(outermost[c]), 0) + len(text)
    if sum(held.values()) - held.get(0, 0) >= HOLDS * sum(held.values()):
        return [x[0] for x in inside if outermost[x[2]] and int(outermost[x[2]]) in held]
    low, high = min(x[2] for x in chosen), max(x[2] for x in chosen)
    # the last container that begins before all of it and ends after it
    region = next((c for c in range(low, 0, -1) if ends[c] >= high), 0)
    return [x[0] for x in inside if region <= x[2] <= ends[region] or not region]


def main_text(html: str | None) -> str:
    if not html:
        return ""
    parser = Lines()
    try:
        parser.feed(html)
        parser.close()
    except AssertionError:
        pass  # what the parser refuses; the lines so far count
    parser.finish()
    return "\n".join(content(parser.lines, parser.ends, parser.up, parser.roots, parser.soft))


def _texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        texts = [main_text(h) for h in pdf.pop("html")]
        yield pdf.assign(text=texts, n_chars=[len(t) for t in texts])


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text, n_chars."""
    rows = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"), F.col(html_col).alias("html"))
    schema = rows.drop("html").schema.add("text", "string").add("n_chars", "long")
    return map_pandas(rows, _texts, schema)
