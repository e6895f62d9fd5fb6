"""Main text of web pages: parser events, text-to-tag ratios, smoothed and clustered.

The standard library's parser streams over a page and yields its lines: the text
between two block boundaries, with the number of tags met since the line before.
Lines inside elements that never hold the article (menus, headers, footers,
sidebars, forms, scripts; or named so by class, id or role) are boilerplate.
The others have a ratio of characters to tags; the ratios, smoothed by a Gaussian
along the page, are cut at their standard deviation, as text clusters stand far
above it. The clusters name the content region: the article (or else the main)
element that holds most of their characters, or else the elements that hold lines
of a cluster with a high ratio of their own. Every line of the region counts,
short ones too, as a ratio alone would lose a one-word paragraph.

White space (Unicode's, a line-break element too) inside a line becomes one
space; lines are trimmed and joined by a line end. Of a header inside an article
only headings are kept. Null, empty, or text without any line outside boilerplate:
empty text. Broken markup is read as far as it goes; unclosed elements end with
what holds them. Repeated rows are extracted alike. A page is one task's work, in
time proportional to its length.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Width of the smoothing, in lines.
SIGMA = 1.0
#: Cut between clusters, in standard deviations of the smoothed ratios.
CUT = 1.0

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table"
    " tbody td tfoot th thead title tr ul".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_NEVER = frozenset(
    "head title script style noscript template nav aside footer form button select textarea datalist dialog menu iframe object svg"
    " math canvas audio video".split()
)
#: Words of a class, id or role that mark boilerplate, alone or in the plural.
_MARKED = frozenset(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies"
    " copyright disclaimer disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices pagination pager"
    " popup promo promotion related replies reply search share sharing sidebar sitemap social sponsor sponsored subscribe"
    " subscription toolbar complementary contentinfo".split()
)
_WHOLE = frozenset({"html", "body", "main", "article"})
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
#: An element that ends an open one of the same kind, and what it can't reach through.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}


def _left_out(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> str:
    """What an element leaves out: "all", "but headings" or nothing."""
    words = {w.lower() for k, v in attrs if k in ("class", "id", "role") and v for w in _WORD.findall(v)}
    if tag in _WHOLE:
        return "all" if tag == "article" and words & {"comment", "comments", "reply"} else ""
    if tag in _NEVER or words & _MARKED or any(k == "hidden" for k, _ in attrs):
        return "all"
    if tag == "header" or (tag in ("div", "section") and "header" in words):
        return "but headings" if in_article else "all"
    return ""


class _Element:
    __slots__ = ("tag", "number", "skip", "region", "heading")

    def __init__(self, tag: str, number: int, skip: str, region: int, heading: bool):
        self.tag, self.number, self.skip, self.region, self.heading = tag, number, skip, region, heading


class Lines(HTMLParser):
    """The lines of a page. Each is (text, tags, region, element): ``region`` is the
    number of the innermost article or main element around it (0: none), and
    ``element`` that of the block that holds it; ``above`` has each one's parent."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int]] = []
        self.kinds: dict[int, str] = {}
        self.above = {0: 0}
        self.open = [_Element("", 0, "", 0, False)]
        self.parts: list[str] = []
        self.tags = 0
        self.seen = 0

    def _end_line(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            self.parts = []
            if text:
                block = next(e for e in reversed(self.open) if e.tag in _BLOCK or not e.number)
                self.lines.append((text, max(self.tags, 1), self.open[-1].region, block.number))
                self.tags = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
        if tag in _BLOCK:
            self._end_line()
            if tag in _ENDS:
                self._close(*_ENDS[tag])
            self._close({"p"}, _BLOCK - {"p"})
        if tag in _VOID:
            return
        self.seen += 1
        around = self.open[-1]
        skip = around.skip if around.skip == "all" else _left_out(tag, attrs, bool(around.region)) or around.skip
        region = around.region
        if tag in ("article", "main") and skip != "all":
            region, self.kinds[self.seen] = self.seen, tag
        self.above[self.seen] = around.number
        self.open.append(_Element(tag, self.seen, skip, region, around.heading or tag in _HEADINGS))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in _BLOCK:
            self._end_line()
        self._close({tag}, set() if tag in _BLOCK else _BLOCK)

    def _close(self, tags: set[str], through: set[str] | frozenset[str]) -> None:
        """End the innermost open element of ``tags`` and all inside it, unless
        one of ``through`` is in between."""
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in tags:
                del self.open[k:]
                return
            if self.open[k].tag in through:
                return

    def handle_data(self, data: str) -> None:
        inside = self.open[-1]
        if not inside.skip or (inside.skip == "but headings" and inside.heading):
            self.parts.append(data)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i)

    def close(self) -> None:
        super().close()
        self._end_line()


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """A Gaussian along the lines; beyond the ends the values are mirrored."""
    reach = min(int(np.ceil(3 * sigma)), len(ratios))
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(np.pad(ratios, reach, "symmetric"), weights / weights.sum(), "valid")


def content_lines(lines: list[tuple[str, int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Whether each line is in a cluster of high ratios (the best ones are, if
    none stands out), and whether its own ratio is that high."""
    ratios = np.array([len(text) / tags for text, tags, _, _ in lines])
    smooth = smoothed(ratios)
    cut = min(CUT * smooth.std(), smooth.max())
    return smooth >= cut, ratios >= cut


def extract(html: str | None) -> str:
    parser = Lines()
    parser.feed(html or "")
    parser.close()
    lines = parser.lines
    if not lines:
        return ""
    content, high = content_lines(lines)
    chars: dict[int, int] = defaultdict(int)
    for (text, _, region, _), inside in zip(lines, content):
        chars[region] += len(text) * bool(inside)
    articles = [r for r, kind in parser.kinds.items() if kind == "article" and chars[r]]
    regions = articles or [r for r in parser.kinds if chars[r]]
    if regions:
        best = max(regions, key=lambda r: chars[r])
        kept = [text for text, _, region, _ in lines if region == best]
    else:
        # a block of one line stands for that line: its neighbours are its parent's
        held = Counter(block for _, _, _, block in lines)
        holders = [block if held[block] > 1 else parser.above[block] for _, _, _, block in lines]
        of_content = {h for h, *inside in zip(holders, content, high) if all(inside)} or {h for h, inside in zip(holders, content) if inside}
        kept = [text for (text, *_), h in zip(lines, holders) if h in of_content]
    return "\n".join(kept)


def _extracting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [extract(html) for html in batch.column("html").to_pylist()]
        kept = [c for c in batch.schema.names if c != "html"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in kept], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*kept, "text", "n_chars"]
        )


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row of ``pages``: its id and url, ``text`` and ``n_chars``."""
    taken = pages.select(id_col, url_col, F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    types = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return taken.mapInArrow(_extracting, f"`{id_col}` {types[id_col]}, `{url_col}` {types[url_col]}, text string, n_chars long")
