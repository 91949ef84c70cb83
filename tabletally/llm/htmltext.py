"""Main-text extraction from HTML by tag-path ratios.

A page is read into *blocks*: runs of text within one block-level element,
with the root-to-leaf tag path of that element (tags with their class names).
Parts that HTML itself names as no article text (menus, footers, asides, forms,
scripts, comments ...) are left out by tag or role. Class names and ids are a
hint only: an element all of whose name's parts stand for such a part (an
advert, a cookie notice, a left sidebar) is left out unless it holds the page's
article or nearly all of its text. Then:

1. Per tag path, text length and punctuation count are summed and divided by
   the number of its blocks: the text and punctuation ratios of the path.
   Blocks that are mostly links take no part.
2. Both ratio sequences, in page order, are smoothed with a Gaussian and fused
   by their product.
3. Paths whose fused ratio reaches the threshold (a part of the mean over the
   page's text, so it needs no page-wide constant) are content paths.
4. The smallest element that holds the blocks of all content paths is the
   content root: the article or main element around it, if there is one, and
   never a single block. All its blocks are the text. Where only the page's body
   holds them all, its divisions without a content path are boilerplate, and so
   are blocks that are mostly links.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from .common import table, with_text_columns

#: Fixed values of HTML and of the extraction, by kind.
BLOCK_TAGS = set(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption "
    "blockquote pre figure figcaption address details summary center hgroup header".split()
)
LEFT_OUT_TAGS = set(
    "head title script style noscript template nav footer aside form button select textarea iframe object svg menu "
    "dialog audio video canvas map search label fieldset".split()
)
VOID_TAGS = set("area base br col embed hr img input link meta param source track wbr".split())
ENDS_PARAGRAPH = BLOCK_TAGS | {"nav", "footer", "aside", "form", "hr", "menu", "fieldset", "dialog", "search"}
SAME_KIND_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
LEFT_OUT_ROLES = set("navigation banner contentinfo complementary search form dialog alert menu".split())
LEFT_OUT_NAMES = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent "
    "disclaimer footer menu modal nav navbar navigation newsletter notice notices notification pagination popup promo "
    "promoted promotion related share sharing sidebar skip social sponsor sponsored subscribe subscription toolbar widget".split()
)
OUTSIDE_ARTICLE_NAMES = {"header", "masthead"}
#: Parts of a name that say nothing about what the element is.
NEUTRAL_NAMES = set(
    "left right top bottom upper lower side site page main top outer inner box block container wrapper wrap list item items area "
    "section panel group row col column content bar link links button buttons icons text small large sticky fixed "
    "js div id class el module component".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CONTAINERS = {"html", "body", "main", "article", "section", "div"}
DIVISIONS = {"div", "section", "address", "details", "center"}
PUNCTUATION = re.compile(r"[.,;:!?¿¡…。，、；：！？]")
KERNEL = [math.exp(-(d * d) / 2) for d in (-2, -1, 0, 1, 2)]
THRESHOLD = 0.1  # of the text-weighted mean of the fused ratios
MOST_LINKS = 0.6  # of a block's characters
MOST_TEXT = 0.9  # of the page's characters: an element that holds as much is no boilerplate, whatever its name


def names_boilerplate(names: list[str], known: set[str]) -> bool:
    """Whether a class or id says, with all its parts, that the element is no article text."""
    for name in names:
        parts = [p for p in re.split(r"[^a-z]+", name) if p]
        if any(p in known for p in parts) and all(p in known or p in NEUTRAL_NAMES for p in parts):
            return True
    return False


@dataclass
class Element:
    tag: str
    name: str
    left_out: bool
    block: bool
    number: int
    suspect: bool = False  # by its name


@dataclass
class Block:
    text: str
    path: str
    tag: str
    elements: tuple[int, ...]
    links: int
    suspects: tuple[int, ...]  # the elements around it that their names speak against


@dataclass
class Reader(HTMLParser):
    """Collects the blocks of one page."""

    blocks: list[Block] = field(default_factory=list)
    stack: list[Element] = field(default_factory=list)
    pieces: list[str] = field(default_factory=list)
    links: int = 0
    in_link: int = 0
    count: int = 0
    #: suspect elements that hold an article, and those that stand in one
    around_article: set[int] = field(default_factory=set)
    in_article: set[int] = field(default_factory=set)

    def __post_init__(self) -> None:
        super().__init__(convert_charrefs=True)

    def flush(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text:
            self.blocks.append(Block(
                text, "/".join(e.name for e in self.stack), self.stack[-1].tag if self.stack else "",
                tuple(e.number for e in self.stack), self.links, tuple(e.number for e in self.stack if e.suspect),
            ))
        self.pieces, self.links = [], 0

    def close_to(self, at: int) -> None:
        if any(e.block for e in self.stack[at:]):
            self.flush()
        del self.stack[at:]

    def close_open(self, tags: set[str]) -> None:
        """Closes the innermost open element of ``tags`` unless a container stands between."""
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i].tag in tags:
                return self.close_to(i)
            if self.stack[i].tag in ("html", "article", "main", "section", "div", "body", "table", "ul", "ol", "dl", "blockquote") or self.stack[i].left_out:
                return None
        return None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID_TAGS:
            if tag == "hr":
                self.close_open({"p"})
                self.flush()
            elif tag == "br":
                self.handle_data(" ")
            return
        self.in_link += tag == "a"
        given = {k: v or "" for k, v in attrs}
        names = f"{given.get('class', '')} {given.get('id', '')}".lower().split()
        inside = any(e.tag in ("article", "main") for e in self.stack)
        left_out = (
            tag in LEFT_OUT_TAGS
            or given.get("role", "").lower() in LEFT_OUT_ROLES
            or "hidden" in given or given.get("aria-hidden") == "true"
            or re.search(r"display\s*:\s*none", given.get("style", "").lower()) is not None
            or not inside and tag == "header"
        )
        known = LEFT_OUT_NAMES if inside else LEFT_OUT_NAMES | OUTSIDE_ARTICLE_NAMES
        suspect = tag not in ("html", "body", "main", "article") and names_boilerplate(names, known)
        # within a block there is nothing to weigh the name against
        left_out = left_out or suspect and tag not in ENDS_PARAGRAPH or any(e.left_out and e.tag == tag for e in self.stack)
        block = tag in ENDS_PARAGRAPH
        if not block and not left_out:
            return
        if tag == "body":
            self.close_open({"head"})
        if block:
            self.close_open({"p"})
            self.close_open(SAME_KIND_ENDS.get(tag, set()))
            self.flush()
        self.count += 1
        if tag in ("article", "main"):
            self.around_article.update(e.number for e in self.stack if e.suspect)
        if suspect and inside:
            self.in_article.add(self.count)
        self.stack.append(Element(tag, ".".join([tag, *sorted(set(names))]), left_out, block, self.count, suspect))

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self.in_link = max(0, self.in_link - 1)
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i].tag == tag:
                return self.close_to(i)
        if tag in ENDS_PARAGRAPH:
            self.flush()
        return None

    def handle_data(self, data: str) -> None:
        if any(e.left_out for e in self.stack):
            return
        self.pieces.append(data)
        if self.in_link:
            self.links += len("".join(data.split()))


def blocks_of(html: str) -> list[Block]:
    """The blocks of a page, without those that their elements' names speak against."""
    for source in (html, html.replace("<![", "&lt;![")):
        reader = Reader()
        try:
            reader.feed(source)
            reader.close()
        except AssertionError:  # a marked section that the parser does not know: read it as text
            continue
        reader.flush()
        held: dict[int, int] = {}
        for b in reader.blocks:
            for number in b.suspects:
                held[number] = held.get(number, 0) + len(b.text)
        most = MOST_TEXT * sum(len(b.text) for b in reader.blocks)
        cleared = reader.around_article | {n for n, size in held.items() if size >= most and n not in reader.in_article}
        return [b for b in reader.blocks if cleared.issuperset(b.suspects)]
    return []


def smooth(values: list[float]) -> list[float]:
    n, half = len(values), len(KERNEL) // 2
    out = []
    for i in range(n):
        around = [(KERNEL[d + half], values[i + d]) for d in range(-half, half + 1) if 0 <= i + d < n]
        out.append(sum(k * v for k, v in around) / sum(k for k, _ in around))
    return out


def content_paths(blocks: list[Block]) -> set[str]:
    length: dict[str, int] = {}
    points: dict[str, int] = {}
    number: dict[str, int] = {}
    for b in blocks:
        length[b.path] = length.get(b.path, 0) + len(b.text)
        points[b.path] = points.get(b.path, 0) + len(PUNCTUATION.findall(b.text))
        number[b.path] = number.get(b.path, 0) + 1
    text = smooth([length[b.path] / number[b.path] for b in blocks])
    point = smooth([points[b.path] / number[b.path] for b in blocks])
    fused = [t * (1 + p) for t, p in zip(text, point, strict=True)]
    total = sum(len(b.text) for b in blocks)
    mean = sum(f * len(b.text) for f, b in zip(fused, blocks, strict=True)) / total
    # a path's ratio is the mean over its blocks, so that one block beside a long paragraph does not lift it
    sums: dict[str, float] = {}
    for b, f in zip(blocks, fused, strict=True):
        sums[b.path] = sums.get(b.path, 0.0) + f
    return {p for p, f in sums.items() if f >= THRESHOLD * mean * number[p]}


def main_text(html: str) -> str:
    """The main text of one page: its content blocks in page order, joined by an empty line."""
    every = blocks_of(html)
    blocks = [b for b in every if b.links <= MOST_LINKS * len("".join(b.text.split()))]
    if not blocks:
        return ""
    paths = content_paths(blocks)
    content = [b for b in blocks if b.path in paths]
    # smoothing lifts a short line beside a long paragraph: without punctuation it does not widen the root
    content = [b for b in content if PUNCTUATION.search(b.text)] or content
    low, high = min(b.elements for b in content), max(b.elements for b in content)
    common = next((i for i, (a, b) in enumerate(zip(low, high, strict=False)) if a != b), min(len(low), len(high)))
    tags = [n.partition(".")[0] for n in content[0].path.split("/")[:common]] if common else []
    depth = next((i + 1 for i, t in enumerate(tags) if t in ("article", "main")), 0)
    if not depth:
        depth = common
        while depth and (tags[depth - 1] not in CONTAINERS or all(len(b.elements) == depth for b in blocks if b.elements[:depth] == low[:depth])):
            depth -= 1
    if depth and tags[depth - 1] not in ("html", "body"):
        kept = [b for b in every if b.elements[:depth] == low[:depth]]
    else:
        kept = [b for b in blocks if b.elements[:depth] == low[:depth]]
        holding = {b.elements[depth] for b in content if len(b.elements) > depth}
        kept = [
            b for b in kept if b.tag in HEADINGS or len(b.elements) <= depth or b.elements[depth] in holding
            or b.path.split("/")[depth].partition(".")[0] not in DIVISIONS
        ]
    return "\n\n".join(b.text for b in kept)


def extract(df: DataFrame, html: str = "html", output: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``df`` with the main text of each page in column ``output``; no shuffle.

    Defined cases: a null or empty page, or one without article text, gives
    the empty text; broken markup is read as a browser would (open paragraphs
    end where the next begins); pages of any length are read whole; an input
    column named like the output is replaced.
    """

    def make() -> Callable[[list[str]], list]:
        return lambda pages: [[main_text(p) for p in pages]]

    return with_text_columns(df, html, StructType().add(output, StringType()), make, keep)


def op8_html(spark, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    texts = extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
