"""Main text of web pages: the marked article, without what the host's pages repeat.

A page is read as a stream of text blocks, each inside a marked article, inside furniture
(menus, headers, forms, advert boxes and the like) or in the open. The tokens of a page's
article and open blocks, put one behind the other, are its part of the host's text. The
suffixes of that text that begin where a block begins, and the prefixes that end where a block
ends, are compared over the block's length, LONG tokens at least: so a run may cross blocks,
and a menu of many short blocks is one. Runs end before a heading, which belongs to what
follows. A run that stands on MARKED_SHARE (in articles) or OPEN_SHARE (elsewhere) of the
host's distinct pages, MARKED_LEAST or OPEN_LEAST at least, covers the blocks that it holds whole.

Covered blocks are boilerplate and go whole; no words are cut out of a block that stays. A run
counts once for pages that are alike but for it. Where the covered blocks hold more than VERSION
of a page's words, the page is a version of others rather than one with boilerplate, and keeps
all. The article decides which blocks can be main text: those inside of it, or without one all
open blocks, or without those the blocks that only a class or id calls furniture.

Suffixes are compared by hashes of the tokens compared instead of being sorted in one place,
so that Spark shares out hosts of any size: pages of a run are made distinct before they are counted.

Defined cases: null and empty html give an empty text; a page cut off in the middle of a tag
loses that tag, and one cut off inside a script or comment the rest; a null url is a host of
its own; very long pages are read whole, one at a time in a task; repeated rows have a row each
and count as one page; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable
from hashlib import blake2b
from html import unescape
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import add_columns, table
from siltstone.llm.urls import host_of
from siltstone.sources.staging import stage

LONG = 8  # tokens of a run at least
# Distinct pages of a host that a run must stand on, at least and as a share of all.
MARKED_LEAST, MARKED_SHARE = 3, 0.8  # for a block of a marked article
OPEN_LEAST, OPEN_SHARE = 2, 0.5  # for any other block
VERSION = 0.8  # share of covered words beyond which a page is a version of others

OPEN, ARTICLE, FURNITURE, NAMED = 0, 1, 2, 3  # NAMED: furniture by a class or id alone

# Names fixed by the HTML standard.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe textarea svg math title xmp".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section select "
    "summary table tbody td tfoot th thead tr ul".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# What holds no main text, by element, by the words of its class and id, and by its role.
_FURNITURE = frozenset("nav header footer aside form head menu dialog button select option".split())
_MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice popup modal overlay newsletter subscribe signup comment comments reply replies disqus respond sidebar "
    "related recommended share sharing social nav navbar navigation menu breadcrumb breadcrumbs pagination pager header "
    "footer masthead toolbar widget".split()
)
# These can be part of an article's own class as well ("header-image"); the others never are.
_LOOSE_MARKS = frozenset(
    "banner header masthead promo promotion related recommended share sharing signup social subscribe toolbar widget".split()
)
_ARTICLE_CLASSES = frozenset("article content entry main post story".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*+)(?:>|\Z)|</?\Z""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORD = re.compile(r"[a-z0-9]+")


def _region(name: str, attributes: str) -> int | None:
    """FURNITURE, NAMED or, for any other element, None."""
    if name in _FURNITURE:
        return FURNITURE
    found = None
    for key, value in _ATTRIBUTE.findall(attributes) if attributes else ():
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or (key == "role" and value in _ROLES):
            return FURNITURE
        if key not in ("class", "id"):
            continue
        # An article may bear "comments-open"; a comment is one of class "comment".
        words = value.split() if name in ("article", "main") else _WORD.findall(value)
        marks = _MARKS.intersection(words)
        if marks - _LOOSE_MARKS:
            return FURNITURE
        if marks and _ARTICLE_CLASSES.isdisjoint(value.split()):
            found = NAMED
    return found


class _Page:
    """Reads a page's tags in order, with the elements that are open."""

    def __init__(self) -> None:
        self.elements: list[tuple[str, int]] = []
        self.blocks: list[tuple[int, str, bool]] = []  # region, text, whether a heading begins it
        self.pieces: list[str] = []
        self.region = OPEN
        self.has_article = False
        self.heading = False

    def end_block(self) -> None:
        if self.pieces:
            text = " ".join(unescape("".join(self.pieces)).split())
            if text:
                self.blocks.append((self.region, text, self.heading))
                self.heading = False
            self.pieces.clear()

    def inside(self) -> int:
        return self.elements[-1][1] if self.elements else OPEN

    def text(self, piece: str) -> None:
        region = self.inside()
        if region == FURNITURE:
            return
        if region != self.region:
            self.end_block()
            self.region = region
        self.pieces.append(piece)

    def start(self, name: str, attributes: str) -> None:
        if name in _BLOCKS:
            self.end_block()
            self.close_open("p" if name != "li" else "li")
            self.heading |= name in _HEADINGS
        elif name == "br":
            self.text(" ")
        if name in _VOID or attributes.endswith("/"):
            return
        region = self.inside()
        if region != FURNITURE:
            furniture = None if name in ("html", "body") else _region(name, attributes)
            if furniture is not None:
                region = furniture
            elif name in ("article", "main") and region != NAMED:
                region = ARTICLE
                self.has_article = True
        self.elements.append((name, region))

    def close_open(self, name: str) -> None:
        """Close an element that ends by itself, unless another block stands in between."""
        for i in range(len(self.elements) - 1, -1, -1):
            if self.elements[i][0] == name:
                del self.elements[i:]
                return
            if self.elements[i][0] in _BLOCKS:
                return

    def end(self, name: str) -> None:
        if name in _BLOCKS:
            self.end_block()
        for i in range(len(self.elements) - 1, -1, -1):
            if self.elements[i][0] == name:
                del self.elements[i:]
                return

    def read(self, html: str) -> None:
        at = 0
        while at < len(html):
            tag = _TAG.search(html, at)
            if tag is None:
                self.text(html[at:])
                break
            if tag.start() > at:
                self.text(html[at : tag.start()])
            at = tag.end()
            closing, name, attributes = tag.group(1, 2, 3) if tag[2] else tag.group(4, 5, 6)
            if not name:
                continue
            name = name.lower()
            if closing:
                self.end(name)
            elif name in _RAW and not attributes.endswith("/"):
                end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(html, at)
                at = end.end() if end else len(html)
                if name == "title":
                    self.end_block()
            else:
                self.start(name, attributes)
        self.end_block()


def page_blocks(html: str | None) -> tuple[list[str], list[str], bool]:
    """Blocks that can be main text, all blocks whose runs count, and whether an article is marked.

    The first are a part of the second, each in page order.
    """
    own, every, _, marked = _placed_blocks(html)
    return [every[i] for i in own], every, marked


def _placed_blocks(html: str | None) -> tuple[list[int], list[str], list[bool], bool]:
    page = _Page()
    page.read(html or "")
    shown = [b for b in page.blocks if b[0] != NAMED]
    if not shown and not page.has_article:
        shown = page.blocks
    wanted = [i for i, (region, _, _) in enumerate(shown) if region == ARTICLE or not page.has_article]
    return wanted, [text for _, text, _ in shown], [heading for _, _, heading in shown], page.has_article


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def page_runs(blocks: list[str], headings: list[bool], long: int = LONG) -> tuple[list[int], list[int], list[int]]:
    """The place of each block that a run covers, the run's hash and a hash of the rest of the page.

    A block of at least long tokens is its own run. A shorter one begins a run of long tokens
    and ends another, as far as its section has so many; they cover the blocks they hold whole.
    """
    sizes = [t.count(" ") + 1 for t in blocks]
    whole = [_hash(t) for t in blocks]
    total = sum(whole)
    places, runs, rests = [], [], []

    def add(run: int, held: range) -> None:
        rest = (total - sum(whole[held.start : held.stop]) + (1 << 63)) % (1 << 64) - (1 << 63)
        for k in held:
            places.append(k)
            runs.append(run)
            rests.append(rest)

    first = 0
    while first < len(blocks):
        last = next((k for k in range(first + 1, len(blocks)) if headings[k]), len(blocks))
        stream = " ".join(blocks[first:last]).split(" ")
        ends = list(accumulate(sizes[first:last]))
        for i in range(first, last):
            end = ends[i - first]
            at = end - sizes[i]
            if sizes[i] >= long:
                add(whole[i], range(i, i + 1))
                continue
            if at + long <= len(stream):
                add(_hash(" ".join(stream[at : at + long])), range(i, first + bisect_right(ends, at + long)))
            if end >= long:
                begin, left = i, long - sizes[i]
                while begin > first and sizes[begin - 1] <= left:  # at most long steps
                    begin, left = begin - 1, left - sizes[begin - 1]
                add(_hash(" ".join(stream[end - long : end])), range(begin, i + 1))
        first = last
    return places, runs, rests


def _split(long: int) -> Callable[[], Callable]:
    def make() -> Callable:
        def split(pages):
            out = []
            for html in pages:
                own, every, headings, marked = _placed_blocks(html)
                place = {i: k for k, i in enumerate(own)}
                places, runs, rests = page_runs(every, headings, long)
                body = _hash("\n".join(every))
                out.append(([every[i] for i in own], marked, body, [place.get(i, -1) for i in places], runs, rests))
            return list(zip(*out, strict=True)) if out else [()] * 6

        return split

    return make


def _boilerplate(pages: DataFrame) -> DataFrame:
    """_uid and _gone, the covered blocks of the pages that have any."""
    each = F.explode(F.arrays_zip("_place", "_run", "_rest")).alias("_r")
    at = pages.select("_uid", "_host", "_marked", each).select("_uid", "_host", "_marked", "_r.*")
    held = at.groupBy("_host", "_run", "_rest").agg(F.lit(1).alias("_one"))
    held = held.groupBy("_host", "_run").agg(F.count("*").alias("_pages")).where(F.col("_pages") >= OPEN_LEAST)
    hosts = pages.groupBy("_host", "_body").agg(F.lit(1).alias("_one"))
    hosts = hosts.groupBy("_host").agg(F.count("*").alias("_all"))
    often = held.join(hosts, "_host").where(F.col("_pages") >= OPEN_SHARE * F.col("_all"))
    covered = at.where("_place >= 0").join(often, ["_host", "_run"])
    enough = (F.col("_pages") >= MARKED_LEAST) & (F.col("_pages") >= MARKED_SHARE * F.col("_all"))
    covered = covered.where(~F.col("_marked") | enough)
    return covered.groupBy("_uid").agg(F.collect_set("_place").alias("_gone"))


def main_text(pages: DataFrame, long: int = LONG) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    host = F.xxhash64(host_of(F.col("url"))).alias("_host")
    own = pages.select("page_id", "url", host, "html")
    added = {"_blocks": "array<string>", "_marked": "boolean", "_body": "long"}
    added |= dict.fromkeys(("_place", "_run", "_rest"), "array<long>")
    rows = add_columns(own, ["page_id", "url", "_host"], [F.col("html")], _split(long), added)
    rows = stage(rows.withColumn("_uid", F.monotonically_increasing_id()), "blocks").df
    # Written first, so that Spark knows its size: texts are shuffled only where it is large.
    gone = stage(_boilerplate(rows), "gone").df
    every = rows.select("_uid", "page_id", "url", "_blocks").join(gone, "_uid", "left")
    kept = F.filter("_blocks", lambda _, i: ~F.array_contains("_gone", i.cast("long")))
    both = F.col("_blocks"), kept
    whole, rest = (F.aggregate(b, F.lit(0), lambda n, t: n + F.size(F.split(t, " ", -1))) for b in both)
    blocks = F.when(F.col("_gone").isNotNull() & (whole - rest <= VERSION * whole), kept).otherwise(F.col("_blocks"))
    text = F.array_join(blocks, "\n\n").alias("text")
    return every.select("page_id", "url", text).withColumn("n_chars", F.length("text").cast("long"))


def op9_host_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
