"""Main text of web pages: flat text blocks, classified by a decision tree.

A page becomes a flat list of text blocks. A block's features are its own words, link density and
last sign, those of its neighbours and the distance to the next long block on either side, and what
encloses it: an article, page furniture by tag, a container whose name marks it as furniture (and how
much of the page's plain words that container holds), a heading. A decision tree fitted by Spark on
the small table of labelled blocks below says which blocks are kept; its splits are read once and
applied where the pages are.

Defined results: a null or empty page has the empty text; a page without blocks that are kept too;
an unclosed script, style, title or textarea runs to the end of the page, an unclosed link or element
without page text to the next begin or end of a block, other unclosed tags end with what encloses
them; a `<` that begins another tag ends an unfinished one, which is text; formulas and the text of
objects are page text; repeated rows give equal results; an empty table gives an empty result; the
columns of the input are kept by ``with_main_text``, whose new column is named by the caller. The time
for a page grows with its length, whatever its tags.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkvigil.llm.columns import text_slices

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^<>]*+>"""
    r"""|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/<>]*+)([^<>]*+)>""",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")
NAME_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*")

# Fixed values of HTML: elements whose content is not page text (of RAW also no tags), and elements
# that end a block.
RAW = frozenset("script style title textarea".split())
SKIPPED = frozenset("noscript iframe noembed noframes template svg select button".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section"
    " summary table tbody td tfoot th thead tr ul".split()
)
FURNITURE = frozenset("nav header footer aside form menu dialog dir fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words of class, id and role names that mark page furniture. A name counts if its first or last word
# is one of them; a word of STATES in it says that it is about something else (no-sidebar, tag-promo,
# comments-open).
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsbygoogle banner sponsor sponsored promo promotion cookie"
    " cookies consent gdpr notice alert popup modal overlay sidebar nav navbar navigation menu breadcrumb breadcrumbs"
    " header masthead footer comment comments respond disqus reply replies discussion share sharing social"
    " related recommended newsletter subscribe signup login search widget widgets toolbar pagination copyright"
    " complementary contentinfo form".split()
)
STATES = frozenset(
    "no not non without has have with tag tags category cat topic label status format type layout theme template is"
    " open opened closed enabled disabled allowed off on count style color font".split()
)
DISCUSSION = frozenset("comment comments respond disqus reply replies discussion".split())
# Names that mark furniture of any length.
STRONG = DISCUSSION | frozenset(
    "ad ads advert adverts advertisement advertising adsbygoogle sponsor sponsored promo cookie cookies consent gdpr"
    " popup modal overlay newsletter sidebar copyright".split()
)

FEATURES = [
    "words", "links", "words_before", "links_before", "words_after", "links_after", "gap_before", "gap_after",
    "sentence", "furniture", "marked", "held", "inside", "outside", "heading",
]
# Words of a long block, its highest link density, and the gap where there is none on that side.
LONG, PLAIN, NO_LONG = 15, 0.35, 20
SENTENCE_ENDS = tuple('.!?…:;"”»)')

# The labelled table: the blocks of small pages in their order. A block is its number of words, its
# link density, whether it ends like a sentence, what encloses it (t: furniture by tag, m: by name,
# s: by a strong name, a: an article, h: a heading) and whether it is main text.
LABELLED_PAGES = {
    "an article between navigation, advert and footer": [
        (1, 1.0, 0, "t", 0), (2, 1.0, 0, "t", 0), (1, 1.0, 0, "t", 0), (9, 0.0, 1, "s", 0), (30, 0.0, 1, "s", 0),
        (7, 0.0, 0, "ah", 1), (60, 0.0, 1, "a", 1), (120, 0.05, 1, "a", 1), (1, 0.0, 1, "a", 1), (25, 0.1, 1, "a", 1),
        (8, 0.0, 0, "a", 1), (2, 0.0, 0, "a", 1), (300, 0.0, 1, "a", 1), (12, 0.0, 1, "t", 0), (5, 0.2, 0, "t", 0),
    ],
    "a short article": [
        (1, 1.0, 0, "t", 0), (40, 0.0, 1, "s", 0), (3, 0.0, 0, "ah", 1), (1, 0.0, 0, "a", 1), (2, 0.0, 1, "a", 1), (25, 0.0, 1, "t", 0),
    ],
    "an article with link lists, furniture and comments inside": [
        (5, 0.0, 0, "ah", 1), (50, 0.3, 1, "a", 1), (3, 1.0, 0, "a", 1), (70, 0.0, 1, "a", 1), (4, 0.0, 0, "as", 0),
        (30, 0.0, 1, "as", 0), (20, 0.0, 1, "a", 1), (2, 1.0, 0, "a", 0), (4, 1.0, 0, "a", 0), (3, 1.0, 0, "a", 0),
        (5, 1.0, 0, "a", 0), (2, 0.0, 0, "at", 0), (45, 0.0, 1, "at", 0), (3, 0.0, 0, "ash", 0), (60, 0.0, 1, "as", 0), (90, 0.1, 1, "as", 0),
    ],
    "text outside the article": [
        (4, 0.0, 0, "h", 0), (35, 0.0, 1, "", 0), (6, 0.0, 0, "ah", 1), (80, 0.0, 1, "a", 1), (40, 0.1, 1, "a", 1),
        (10, 0.0, 1, "", 0), (50, 0.0, 1, "", 0), (3, 0.0, 0, "h", 0), (150, 0.0, 1, "", 0), (2, 1.0, 0, "", 0), (1, 1.0, 0, "", 0),
    ],
    "no article: menu, title, paragraphs, footer": [
        (1, 0.0, 0, "", 0), (1, 1.0, 0, "", 0), (2, 1.0, 0, "", 0), (1, 1.0, 0, "", 0), (2, 1.0, 0, "", 0), (8, 0.0, 0, "h", 1),
        (3, 0.0, 0, "", 1), (60, 0.0, 1, "", 1), (45, 0.1, 1, "", 1), (5, 0.0, 0, "h", 1), (90, 0.0, 1, "", 1), (4, 0.0, 1, "", 1),
        (30, 0.0, 1, "", 1), (6, 0.0, 1, "", 1), (1, 1.0, 0, "", 0), (2, 1.0, 0, "", 0), (5, 0.0, 0, "", 0), (3, 0.0, 0, "", 0),
    ],
    "no article: links right before a long paragraph": [
        (1, 1.0, 0, "", 0), (2, 1.0, 0, "", 0), (1, 1.0, 0, "", 0), (100, 0.0, 1, "", 1), (55, 0.0, 1, "", 1), (1, 1.0, 0, "", 0),
        (48, 0.0, 1, "", 1), (2, 1.0, 0, "", 0), (70, 0.2, 1, "", 1), (2, 0.0, 0, "", 0), (4, 0.0, 0, "", 0),
    ],
    "no article: a list of short items and a dialogue": [
        (2, 0.0, 0, "", 0), (3, 1.0, 0, "", 0), (6, 0.0, 0, "h", 1), (40, 0.0, 1, "", 1), (3, 0.0, 0, "", 1), (5, 0.0, 0, "", 1),
        (2, 0.0, 0, "", 1), (4, 0.0, 0, "", 1), (33, 0.0, 1, "", 1), (5, 0.0, 1, "", 1), (3, 0.0, 1, "", 1), (8, 0.0, 1, "", 1),
        (20, 0.0, 1, "", 1), (9, 0.0, 1, "", 1), (2, 1.0, 0, "", 0), (6, 0.0, 0, "", 0), (3, 1.0, 0, "", 0),
    ],
    "no article: furniture by tag and name around": [
        (2, 1.0, 0, "t", 0), (10, 0.0, 1, "m", 0), (3, 0.0, 0, "th", 0), (22, 0.0, 1, "s", 0), (5, 0.0, 0, "h", 1), (75, 0.0, 1, "", 1),
        (65, 0.1, 1, "", 1), (80, 0.0, 1, "", 1), (3, 0.0, 0, "mh", 0), (20, 0.3, 1, "m", 0), (15, 0.8, 0, "m", 0), (4, 0.0, 0, "sh", 0),
        (90, 0.0, 1, "s", 0), (60, 0.0, 1, "s", 0), (40, 0.0, 1, "t", 0), (12, 0.1, 1, "t", 0),
    ],
    "no article: the whole text in a container with an unlucky name": [
        (2, 1.0, 0, "t", 0), (1, 1.0, 0, "t", 0), (6, 0.0, 0, "mh", 1), (80, 0.0, 1, "m", 1), (60, 0.1, 1, "m", 1), (4, 0.0, 1, "m", 1),
        (120, 0.0, 1, "m", 1), (5, 0.0, 0, "t", 0), (10, 0.0, 1, "t", 0),
    ],
    "no article: teasers and link lists": [
        (4, 1.0, 0, "", 0), (12, 0.6, 0, "", 0), (30, 0.7, 1, "", 0), (5, 1.0, 0, "h", 0), (25, 0.8, 0, "", 0), (3, 1.0, 0, "", 0),
        (7, 0.0, 0, "", 0), (2, 1.0, 0, "", 0), (10, 0.9, 0, "", 0), (1, 0.0, 0, "", 0),
    ],
    "no article: one paragraph": [
        (2, 1.0, 0, "", 0), (1, 0.0, 0, "", 0), (4, 0.0, 0, "h", 1), (28, 0.0, 1, "", 1), (3, 0.0, 0, "", 0), (1, 1.0, 0, "", 0),
    ],
    "an article that ends the page": [
        (2, 1.0, 0, "t", 0), (3, 0.0, 0, "ah", 1), (40, 0.0, 1, "a", 1), (18, 0.0, 1, "a", 1), (2, 0.0, 1, "a", 1),
    ],
    "an article of one long block that ends the page": [(1, 1.0, 0, "", 0), (2, 0.0, 0, "ah", 1), (70, 0.0, 1, "a", 1)],
    "an article of one short block": [(1, 1.0, 0, "t", 0), (2, 1.0, 0, "t", 0), (1, 0.0, 0, "a", 1), (3, 0.0, 0, "t", 0)],
    "an article of short blocks between links": [
        (1, 1.0, 0, "", 0), (2, 1.0, 0, "", 0), (1, 0.0, 0, "ah", 1), (2, 0.0, 0, "a", 1), (4, 0.0, 1, "a", 1), (1, 0.0, 0, "a", 1),
        (3, 0.0, 0, "a", 1), (9, 0.0, 0, "a", 1), (1, 1.0, 0, "", 0), (6, 0.0, 0, "", 0),
    ],
    "an article with single links among its blocks": [
        (4, 0.0, 0, "ah", 1), (5, 0.0, 0, "a", 1), (1, 1.0, 0, "a", 1), (4, 0.0, 1, "a", 1), (2, 0.5, 0, "a", 1), (30, 0.2, 1, "a", 1),
        (12, 0.5, 1, "a", 1), (3, 0.0, 0, "a", 1), (2, 1.0, 0, "a", 1), (1, 0.0, 0, "a", 1), (11, 1.0, 0, "a", 1), (80, 0.0, 0, "a", 1),
    ],
    "no article: short title after links, short last line": [
        (1, 1.0, 0, "", 0), (3, 1.0, 0, "", 0), (3, 0.0, 0, "h", 1), (50, 0.0, 1, "", 1), (2, 0.0, 1, "", 1),
    ],
    "no article: one-word title after links, long last block": [
        (2, 1.0, 0, "", 0), (1, 1.0, 0, "", 0), (1, 0.0, 0, "h", 1), (25, 0.0, 1, "", 1), (2, 0.0, 0, "h", 1), (40, 0.0, 1, "", 1),
    ],
    "no article: text alone": [(6, 0.0, 0, "h", 1), (20, 0.0, 1, "", 1), (33, 0.0, 0, "", 1), (17, 0.0, 1, "", 1)],
    "no article: a plain menu and a plain footer": [
        (1, 0.0, 0, "", 0), (2, 0.0, 0, "", 0), (1, 0.0, 0, "", 0), (2, 0.0, 0, "", 0), (7, 0.0, 0, "h", 1), (44, 0.0, 1, "", 1),
        (36, 0.0, 1, "", 1), (3, 0.0, 1, "", 1), (2, 0.0, 0, "", 0), (1, 0.0, 0, "", 0), (4, 0.0, 0, "", 0), (9, 0.0, 1, "", 0),
    ],
    "no article: long text between links, last line before links": [
        (1, 1.0, 0, "", 0), (1, 1.0, 0, "", 0), (90, 0.0, 1, "", 1), (1, 1.0, 0, "", 0), (4, 0.0, 0, "h", 1), (66, 0.0, 1, "", 1),
        (5, 0.0, 1, "", 1), (1, 1.0, 0, "", 0), (2, 1.0, 0, "", 0), (3, 0.0, 0, "", 0), (1, 1.0, 0, "", 0),
    ],
    "no article: headings of link lists": [
        (5, 0.0, 0, "h", 1), (50, 0.0, 1, "", 1), (28, 0.1, 0, "", 1), (2, 0.0, 0, "h", 0), (3, 1.0, 0, "", 0), (5, 1.0, 0, "", 0),
        (1, 0.0, 0, "h", 0), (4, 1.0, 0, "", 0), (2, 1.0, 0, "", 0), (7, 0.0, 1, "", 0),
    ],
    "no article: headings after long blocks and after a long notice": [
        (55, 0.0, 1, "s", 0), (3, 0.0, 0, "h", 1), (60, 0.0, 1, "", 1), (130, 0.0, 1, "", 1), (2, 0.0, 0, "h", 1), (45, 0.0, 1, "", 1),
        (200, 0.1, 1, "", 1), (6, 0.0, 0, "", 1), (150, 0.0, 1, "", 1), (4, 0.0, 0, "", 1), (35, 0.0, 0, "", 1), (90, 0.0, 1, "", 1),
        (1, 0.0, 0, "h", 1), (70, 0.0, 1, "", 1), (2, 1.0, 0, "t", 0),
    ],
    "no article: a long text with an unlucky name and short lines in it": [
        (1, 1.0, 0, "t", 0), (3, 0.0, 0, "mh", 1), (48, 0.0, 1, "m", 1), (48, 0.0, 1, "m", 1), (2, 0.0, 1, "m", 1), (5, 0.0, 0, "mh", 1),
        (100, 0.0, 1, "m", 1), (9, 0.0, 1, "m", 1), (30, 0.2, 0, "m", 1), (2, 0.0, 0, "t", 0),
    ],
    "no article: named furniture beside a longer text": [
        (12, 0.0, 1, "m", 0), (6, 0.0, 0, "m", 0), (8, 0.0, 0, "h", 1), (100, 0.0, 1, "", 1), (90, 0.0, 1, "", 1), (25, 0.0, 1, "m", 0),
        (40, 0.1, 1, "m", 0), (3, 0.0, 0, "mh", 0), (110, 0.0, 1, "", 1), (20, 0.0, 1, "m", 0), (2, 0.0, 0, "m", 0),
    ],
    "an article with named furniture in it": [
        (4, 0.0, 0, "ah", 1), (80, 0.0, 1, "a", 1), (10, 0.0, 1, "am", 0), (5, 0.0, 0, "am", 0), (60, 0.0, 1, "a", 1), (30, 0.0, 1, "am", 0),
        (100, 0.0, 1, "a", 1), (8, 0.0, 0, "a", 1), (3, 0.0, 0, "am", 0),
    ],
    "an article of two short sentences": [(1, 1.0, 0, "t", 0), (20, 0.0, 1, "s", 0), (6, 0.0, 1, "ah", 1), (6, 0.0, 1, "a", 1), (12, 0.0, 1, "t", 0)],
    "an article of short lines without sentences": [
        (1, 1.0, 0, "t", 0), (8, 0.0, 0, "ah", 1), (3, 0.0, 0, "a", 1), (5, 0.0, 0, "a", 1), (7, 0.0, 0, "a", 1), (13, 0.0, 0, "a", 1),
        (4, 0.0, 0, "a", 1), (10, 0.0, 0, "a", 1), (6, 0.0, 0, "t", 0),
    ],
    "an article of short sentences": [
        (2, 1.0, 0, "", 0), (5, 0.0, 1, "a", 1), (3, 0.0, 1, "a", 1), (8, 0.0, 1, "a", 1), (14, 0.0, 1, "a", 1), (9, 0.0, 1, "a", 1),
        (7, 0.0, 1, "a", 1), (3, 0.0, 0, "", 0),
    ],
    "an article that ends in short lines": [
        (70, 0.0, 1, "a", 1), (9, 0.0, 0, "a", 1), (3, 0.0, 0, "a", 1), (6, 0.0, 0, "a", 1), (4, 0.0, 0, "a", 1), (1, 0.0, 0, "a", 1),
        (7, 0.0, 0, "a", 1), (9, 0.0, 0, "a", 1), (2, 0.0, 0, "a", 1),
    ],
    "an article that begins with short lines": [
        (3, 0.0, 0, "ah", 1), (9, 0.0, 0, "a", 1), (4, 0.0, 1, "a", 1), (7, 0.0, 0, "a", 1), (5, 0.0, 0, "a", 1), (1, 0.0, 0, "a", 1),
        (8, 0.0, 0, "a", 1), (2, 0.0, 0, "a", 1), (50, 0.0, 1, "a", 1),
    ],
    "an article of one word": [(3, 1.0, 0, "t", 0), (1, 0.0, 0, "ah", 1)],
    "an article of four words": [(4, 0.0, 0, "t", 0), (4, 0.0, 0, "a", 1), (4, 0.0, 0, "t", 0)],
    "an article of nine words": [(10, 0.0, 1, "s", 0), (9, 0.0, 0, "a", 1), (9, 0.0, 0, "a", 1)],
    "no article: more comments than text": [
        (2, 1.0, 0, "t", 0), (4, 0.0, 0, "h", 1), (45, 0.0, 1, "", 1), (50, 0.0, 1, "", 1), (1, 0.0, 0, "sh", 0), (100, 0.0, 1, "s", 0),
        (120, 0.0, 1, "s", 0), (5, 0.0, 1, "s", 0), (80, 0.0, 1, "s", 0), (2, 0.0, 0, "s", 0), (60, 0.0, 1, "s", 0),
    ],
    "an article shorter than its comments": [
        (5, 0.0, 0, "ah", 1), (30, 0.0, 1, "a", 1), (2, 0.0, 0, "ash", 0), (90, 0.0, 1, "as", 0), (70, 0.0, 1, "as", 0), (9, 0.0, 1, "as", 0),
    ],
    "no article: only short lines": [(3, 0.0, 0, "h", 1), (9, 0.0, 1, "", 1), (8, 0.0, 1, "", 1), (1, 1.0, 0, "", 0), (2, 0.0, 0, "", 0)],
}

Tree = tuple  # (feature, threshold, left, right) or the decision


@dataclass
class Block:
    text: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    furniture: bool = False
    marked: int = 0
    # The outermost container with a marking name.
    container: int = 0
    article: bool = False
    main: bool = False
    heading: bool = False


class Place(NamedTuple):
    """What an open element hands to its blocks."""

    tag: str = ""
    furniture: bool = False
    marked: int = 0
    container: int = 0
    article: bool = False
    main: bool = False
    discussion: bool = False
    heading: bool = False


def marks(attributes: str) -> set[str]:
    """Marking words of an element's class, id and role; hidden elements are marked as such."""
    found: set[str] = set()
    if not attributes.strip():
        return found
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id", "role"):
            for token in value.split():
                parts = [part.lower() for part in NAME_PARTS.findall(token)]
                if parts and not STATES.intersection(parts):
                    found.update(MARKS.intersection((parts[0], parts[-1])))
        elif name == "hidden" or name == "aria-modal" or name == "style" and "display:none" in value.replace(" ", ""):
            found.add("overlay")
    return found


Token = tuple[int, int, str, str, str]  # begin, end, "/" of an end tag, tag, attributes


def tokens_of(page: str) -> list[Token]:
    """The tags of a page; that of a RAW element has its content and end with it."""
    found, at = [], 0
    while match := TOKEN.search(page, at):
        at = match.end()
        close, tag, attributes = match[1], match[2], match[3]
        if tag is None:
            close, tag, attributes = match[4], match[5], match[6]
        tag = (tag or "").lower()
        if tag in RAW and not close and not attributes.endswith("/"):
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
        found.append((match.start(), at, close or "", tag, attributes or ""))
    return found


def ends_of(tokens: list[Token]) -> dict[int, int]:
    """Begin and end tag, by number, of links and SKIPPED elements that end inside what encloses them."""
    ends: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    held: Counter[str] = Counter()
    link = 0  # where in the stack the open link is; there is one at most

    def leave(tag: str) -> int:
        while True:
            last, number = stack.pop()
            held[last] -= 1
            if last == tag:
                return number

    for i, (_, _, close, tag, attributes) in enumerate(tokens):
        inline = tag == "a" or tag in SKIPPED
        if not inline and tag not in BLOCK:
            continue
        if close:
            if held[tag]:
                number = leave(tag)
                if inline:
                    ends[number] = i
            continue
        if tag in SKIPPED and attributes.endswith("/") or tag == "hr":
            continue
        if tag == "a" and held["a"]:
            # A link ends where the next one begins.
            stack[link] = ("", -1)
            held["a"] -= 1
        elif not inline and stack and (stack[-1][0] == "p" or tag == "li" and stack[-1][0] == "li"):
            held[stack.pop()[0]] -= 1
        if tag == "a":
            link = len(stack)
        stack.append((tag, i))
        held[tag] += 1
    return ends


def blocks_of(page: str) -> list[Block]:
    """The flat blocks of a page, in page order, without empty ones."""
    stack = [Place()]
    held: Counter[str] = Counter()
    done: list[Block] = []
    tokens = tokens_of(page)
    ends = ends_of(tokens)
    block, linking, at, containers = Block(), False, 0, 0
    # Whether the link or the element without page text that is open ends at the next block.
    loose, dropping = False, False

    def cut() -> None:
        nonlocal block
        if any(t.strip() for t in block.text):
            done.append(block)
        p = stack[-1]
        block = Block([], [], p.furniture, p.marked, p.container, p.article, p.main, p.heading)

    def say(text: str) -> None:
        if dropping:
            return
        block.text.append(text)
        if linking:
            block.linked.append(text)

    for i, (begin, end, close, tag, attributes) in enumerate(tokens):
        if begin < at:
            continue
        if begin > at:
            say(page[at:begin])
        at = end
        if tag in BLOCK:
            linking, loose, dropping = linking and not loose, False, False
        if tag == "a":
            linking, loose = not close, not close and i not in ends
        elif tag == "br":
            say(" ")
        elif tag in SKIPPED:
            if not close and not attributes.endswith("/"):
                dropping = dropping or i not in ends
                at = tokens[ends[i]][1] if i in ends else end
        elif tag in BLOCK and close:
            if held[tag]:
                while (last := stack.pop().tag) != tag:
                    held[last] -= 1
                held[tag] -= 1
            cut()
        elif tag in BLOCK:
            if stack[-1].tag == "p" or tag == "li" and stack[-1].tag == "li":
                held[stack.pop().tag] -= 1
            above = stack[-1]
            names = marks(attributes) if tag not in ("body", "html") else set()
            discussion = above.discussion or bool(names & DISCUSSION)
            marked, container = above.marked, above.container
            if tag in ("article", "main"):
                # An article is one whatever encloses it, unless readers wrote it or it is an advert.
                marked, container = (marked, container) if above.discussion else (0, 0)
                names &= STRONG
            if names and not marked:
                containers += 1
                container = containers
            marked = max(marked, 2 if names & STRONG else int(bool(names)))
            own = not marked and not above.discussion
            if tag != "hr":
                stack.append(
                    Place(
                        tag, above.furniture or tag in FURNITURE, marked, container,
                        above.article or tag == "article" and own, above.main or tag == "main" and own,
                        discussion, tag in HEADINGS,
                    )
                )
                held[tag] += 1
            cut()
    if at < len(page):
        say(page[at:])
    cut()
    return done


class Seen(NamedTuple):
    """A block as the features see it."""

    words: int
    links: float
    sentence: bool
    furniture: bool
    marked: int
    container: int
    inside: bool
    heading: bool


def gaps(seen: list[Seen]) -> list[int]:
    """How many blocks before each one the nearest long plain one is, that is not furniture."""
    out, gap = [], NO_LONG
    for block in seen:
        out.append(min(gap, NO_LONG))
        long = block.words >= LONG and block.links <= PLAIN and not block.furniture and block.marked < 2
        gap = 1 if long else gap + 1
    return out


def features_of(seen: list[Seen]) -> list[tuple]:
    """The features of the blocks of a page, in the order of ``FEATURES``."""
    article = any(b.inside for b in seen)
    plain = [b.words * (1 - b.links) for b in seen]
    # Plain words by marked container, of those that no furniture tag encloses.
    kept = [0 if b.furniture else w for b, w in zip(seen, plain, strict=True)]
    held: Counter[int] = Counter()
    for b, w in zip(seen, kept, strict=True):
        held[b.container] += w
    total = max(1.0, sum(kept))
    nothing = (0, 0.0)
    sides = [nothing, *[(b.words, b.links) for b in seen], nothing]
    before, after = gaps(seen), gaps(seen[::-1])[::-1]
    return [
        (
            b.words, b.links, *sides[i], *sides[i + 2], before[i], after[i], b.sentence, b.furniture, b.marked,
            held[b.container] / total if b.marked else 0.0, b.inside, article and not b.inside, b.heading,
        )
        for i, b in enumerate(seen)
    ]


def rows_of(blocks: list[Block]) -> list[tuple[str, tuple]]:
    """(text, features) of every block that has text once references are decoded."""
    article = any(block.article for block in blocks)
    texts, seen = [], []
    for block in blocks:
        text = " ".join(html.unescape("".join(block.text)).split())
        if text:
            words = text.count(" ") + 1
            links = min(1.0, len(html.unescape("".join(block.linked)).split()) / words)
            inside = block.article if article else block.main
            texts.append(text)
            seen.append(
                Seen(words, links, text.endswith(SENTENCE_ENDS), block.furniture, block.marked, block.container, inside, block.heading)
            )
    return list(zip(texts, features_of(seen), strict=True))


def labelled_rows(pages: dict[str, list[tuple]] = LABELLED_PAGES) -> list[tuple]:
    """Features and label of every block of the labelled pages; neighbours with one name share a container."""
    rows = []
    for blocks in pages.values():
        seen, container, name = [], 0, ""
        for words, links, sentence, where, _ in blocks:
            own = "s" if "s" in where else "m" if "m" in where else ""
            container += own != name
            name = own
            marked = {"": 0, "m": 1, "s": 2}[own]
            seen.append(Seen(words, links, bool(sentence), "t" in where, marked, container if marked else 0, "a" in where, "h" in where))
        rows += [(*f, b[4]) for f, b in zip(features_of(seen), blocks, strict=True)]
    return rows


LABELLED = labelled_rows()


def fit_tree(spark: SparkSession, labelled: list[tuple] = LABELLED, depth: int = 16) -> Tree | bool:
    """The tree that Spark fits on the labelled table, as nested splits."""
    columns = ", ".join(f"{name} double" for name in [*FEATURES, "label"])
    table = spark.createDataFrame([tuple(map(float, row)) for row in labelled], columns).coalesce(1)
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(table)
    model = DecisionTreeClassifier(maxDepth=depth, maxBins=512, minInstancesPerNode=1, seed=1).fit(rows)

    def read(node):
        if node.subtreeDepth() == 0:
            return node.prediction() > 0.5
        split = node.split()
        return (split.featureIndex(), split.threshold(), read(node.leftChild()), read(node.rightChild()))

    return read(model._java_obj.rootNode())


def decide(tree: Tree | bool, features: tuple) -> bool:
    while not isinstance(tree, bool):
        tree = tree[2] if features[tree[0]] <= tree[1] else tree[3]
    return tree


def main_text(page: str | None, tree: Tree | bool) -> str:
    if not page:
        return ""
    return "\n\n".join(text for text, row in rows_of(blocks_of(page)) if decide(tree, row))


def with_main_text(pages: DataFrame, name: str, tree: Tree | bool | None = None) -> DataFrame:
    """``pages`` with the main text of the column ``html`` in the new column ``name``."""
    rules = fit_tree(pages.sparkSession) if tree is None else tree

    @F.arrow_udf("string")
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in (part for batch in batches for part in text_slices(batch)):
            yield pa.array([main_text(page, rules) for page in part.to_pylist()], pa.string())

    return pages.withColumn(name, extract(F.col("html")))


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url and main text of every page."""
    return with_main_text(pages.select("page_id", "url", "html"), "text").select("page_id", "url", "text")
