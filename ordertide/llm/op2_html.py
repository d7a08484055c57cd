"""Operator 2: main text of raw HTML by two-pass block rules.

A page is cut into blocks at block-level tags.  First pass: a block is
*boilerplate* inside a menu, header, footer, sidebar, notice, advert, form or
comment section, when most of its characters are link text, or when it is a
short call to the reader (accept, log in, subscribe); it is *text* when it is
long enough with a high density of stop words, or, in whatever language, is
made of sentences almost without links.  An article or main element around a
block is one vote: less length and density are asked of it there, and a
paragraph that is a single link stays undecided.  Other blocks, headings and
short ones above all, stay ambiguous.  A class, id or role marks an element by
its whole name (``sidebar``, ``cookie-notice``, not ``has-sidebar``); an
article or main element clears the mark of a form around it, and that of a
class unless inside another article or main element.  Second pass: an
ambiguous block takes the label of its nearest decided neighbours (both sides
text, or text on the nearer side; equally near: the one before), a heading
that of the block it heads.  Inside an article or main element the neighbours
are those inside one, and the vote decides between unlike ones, or where there
are none.

A loose name (``discussion``, ``teaser``, ...) can't take the whole page:
where no block is text, marks by such names are dropped and the rules run
again; where still none is, the ambiguous paragraphs and what heads them are
the text.  A reader's comment under a name that the lists don't hold is prose
like any other and stays.

Scripts, styles, comments and the head are dropped, character references
decoded, white space inside a block made one space, blocks joined by one
newline in page order.  Nothing else is dropped or cut, whatever the length.

Defined results: a null or empty page, or one without text, gives an empty
string and 0; truncated markup is read as far as it goes; repeated rows give
repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.llm import common as C

# Common words of the supported languages.
STOP_WORDS = frozenset(
    """
    the of and to in a is that it for on was be as with by at from this are or an not have has but they you he his her she we were which
    their there been its will would can if all one more when who what so no my me our out up do had about into than them then some
    der die das und zu den von mit ist im ein eine einen einem einer auf für nicht auch sich des dem als wie es an bei nach aus werden
    wird oder aber noch nur so wir sie er ich war sind hat haben dass um über vor zum zur durch kann
    le la les de des du et en un une est que qui dans pour pas sur au aux avec ce cette il elle ils on nous vous je ne se sa son ses
    par plus ou mais comme leur été être sont ont fait tout
    el los las una y por con no su para es al lo como más pero sus o este sí porque esta entre cuando muy sin sobre también me hasta
    hay donde quien desde todo nos durante todos ni contra otros ese eso ante ellos esto mí antes
    """.split()
)

# Elements whose content is no article text, block-level
# elements, and words of class, id and role attributes that mark boilerplate.
SKIPPED = frozenset("script style noscript template svg math head iframe object canvas select textarea button option".split())
ASIDE = frozenset("nav footer aside form menu dialog".split())
BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MARKS = frozenset(
    "ad ads advert advertisement advertising adbox adsbygoogle banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus"
    " disclaimer footer gdpr header masthead menu menubar modal nav navbar navigation newsletter notice overlay pagination pager popup promo"
    " promoted promotion reactions related replies reply search share sharing shoutbox sidebar signup skyscraper social sponsor sponsored"
    " subscribe subscription tagcloud teaser toolbar widget complementary contentinfo alert alertdialog"
    " responses discussion".split()
)
NAMES = frozenset("author-bio author-box about-author about-the-author post-meta entry-meta article-meta post-tags entry-tags more-stories read-next".split())
# What may stand beside such a word in a name.
BESIDE = frozenset("site page main top bottom left right primary secondary global bar box block links list section area unit slot post entry".split())
TITLES = frozenset(("header", "masthead", "banner"))  # no marks inside an article or main element
# Of the words above, those that an article's own wrapper may have.
LOOSE_WORDS = frozenset("discussion responses reactions replies reply promotion search social share teaser related".split())
FORM, LOOSE, NAMED, SURE = 1, 2, 3, 4  # how an element is marked; 0 is not at all
CONTENT = frozenset(("article", "main"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

PARAGRAPHS = frozenset("p blockquote figcaption dd pre".split())
# How short calls to the reader begin.
CALLS = re.compile(
    r"(?:please )?(?:accept (?:all|our|the|cookies)|agree to|log ?in|sign ?(?:in|up)|subscribe|register (?:now|for|to)|follow us|share (?:this|on|via)|click here"
    r"|read more|continue reading|load more|show (?:more|comments)|skip to|back to top|we use cookies|enable javascript)\b",
    re.I,
)

SHORT, LONG = 70, 200  # characters
STOP_LOW, STOP_HIGH = 0.25, 0.32  # share of words that are stop words
MAX_LINKS, FEW_LINKS = 0.5, 0.1  # share of characters inside links
ENDS = tuple(".!?…。！？।؟۔።")  # of a sentence

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|iframe|title|svg|math)\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")


class Block(NamedTuple):
    text: str
    tag: str
    links: int  # characters inside links
    content: bool  # inside an article or main element
    aside: int  # how it is marked as boilerplate, 0 is not at all
    anchors: int = 0  # links in it


def _named(value: str, content: bool) -> int:
    """How the names in an attribute's value mark boilerplate."""
    mark = 0
    for name in value.split():
        words = {w for w in _SPLIT.split(name) if w} - BESIDE
        if name.replace("_", "-") in NAMES:
            mark = NAMED
        elif words and words <= MARKS and not (content and words <= TITLES):
            mark = max(mark, LOOSE if words <= LOOSE_WORDS else NAMED)
    return mark


def _marked(name: str, attrs: str, content: bool) -> int:
    """How an element's tag or attributes mark it as no article text."""
    mark = 0
    if name == "form":
        mark = FORM
    elif name in ASIDE or (name == "header" and not content):
        return SURE
    for m in _ATTRIBUTE.finditer(attrs):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return SURE
        if key == "style":
            if "display:none" in value.replace(" ", ""):
                return SURE
        elif name not in ("body", "html", "main"):
            mark = max(mark, _named(value, content))
    return mark


def _inherited(name: str, mark: int, content: bool) -> int:
    """What an element keeps of the mark around it."""
    if name in CONTENT and (mark == FORM or mark in (LOOSE, NAMED) and not content):
        return 0
    return mark


def blocks(page: str) -> list[Block]:
    """The page's blocks in order, white space normalised, empty ones left out."""
    found: list[Block] = []
    parts: list[str] = []
    link_chars = anchors = 0
    # Open elements as (name, marked, content); marked and content are inherited.
    stack: list[tuple[str, int, bool]] = [("", 0, False)]
    in_link = skipped = 0
    tag = ""

    def flush() -> None:
        nonlocal link_chars, anchors
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            found.append(Block(text, tag, link_chars, stack[-1][2], stack[-1][1], anchors))
        parts.clear()
        link_chars = 0
        anchors = int(in_link > 0)

    def add(piece: str) -> None:
        nonlocal link_chars
        if piece and not skipped:
            parts.append(piece)
            if in_link:
                link_chars += len(piece.strip())

    at = 0
    for m in _TOKEN.finditer(page):
        add(page[at : m.start()])
        at = m.end()
        name = m["name"]
        if name is None:  # comments, declarations and raw text elements
            continue
        name = name.lower()
        if not m["end"]:
            if name in BLOCK:
                flush()
                tag = name
            attrs = m["attrs"]
            if name in VOID or attrs.endswith("/"):
                continue
            if name == "p" and stack[-1][0] == "p" or name == "li" and stack[-1][0] == "li":
                stack.pop()  # their end tags may be left out
            _, marked, content = stack[-1]
            stack.append((name, max(_inherited(name, marked, content), _marked(name, attrs, content)), content or name in CONTENT))
            in_link += name == "a"
            anchors += name == "a"
            skipped += name in SKIPPED
        else:
            if name in BLOCK:
                flush()
                tag = ""
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    for gone, _, _ in stack[k:]:
                        in_link -= gone == "a"
                        skipped -= gone in SKIPPED
                    del stack[k:]
                    break
    add(page[at:])
    flush()
    return found


def first_pass(b: Block, loose: bool = True) -> bool | None:
    """True text, False boilerplate, None ambiguous; without ``loose`` a mark
    by a name that an article's wrapper may have doesn't count."""
    if b.aside and (loose or b.aside != LOOSE):
        return False
    if b.links > MAX_LINKS * len(b.text):
        single = b.content and b.anchors == 1 and (b.tag in PARAGRAPHS or b.tag in HEADINGS)
        return None if single else False
    if b.text.startswith(("©", "&copy;")):
        return False
    if len(b.text) < SHORT and b.tag not in HEADINGS and CALLS.match(b.text):
        return False
    if len(b.text) < SHORT or b.tag in HEADINGS:
        return None
    if b.content and len(b.text) >= LONG:
        return True
    words = [w.strip(".,;:!?\"'()") for w in b.text.lower().split()]
    density = sum(w in STOP_WORDS for w in words) / len(words)
    # Few stop words may only mean another language.
    prose = b.links <= FEW_LINKS * len(b.text) and b.text.rstrip("\"')»”’」』").endswith(ENDS)
    if b.content:
        return True if density >= STOP_LOW or prose else None
    if density >= STOP_HIGH:
        return True if len(b.text) >= LONG or b.tag == "p" else None
    if density >= STOP_LOW and len(b.text) >= LONG:
        return True
    return True if prose and density < STOP_LOW and (b.tag == "p" or len(b.text) >= LONG) else None


def _nearest(labels: list[bool | None], counted: list[bool]) -> tuple[list[int], list[int]]:
    """Places of the nearest decided blocks before and after each block, among
    the ``counted`` ones; -1 and n where there is none."""
    n = len(labels)
    before, after = [-1] * n, [n] * n
    last = -1
    for i in range(n):
        before[i] = last
        last = i if counted[i] and labels[i] is not None else last
    last = n
    for i in range(n - 1, -1, -1):
        after[i] = last
        last = i if counted[i] and labels[i] is not None else last
    return before, after


def second_pass(labels: list[bool | None], headings: list[bool], content: list[bool] | None = None) -> list[bool]:
    """Ambiguous blocks take the label of their nearest decided neighbours."""
    n = len(labels)
    content = content or [False] * n
    everywhere, inside = _nearest(labels, [True] * n), _nearest(labels, content)
    out = []
    for i, label in enumerate(labels):
        if label is None:
            # No neighbour: as the article or main element votes.
            vote = content[i]
            before, after = (x[i] for x in (inside if vote else everywhere))
            left = labels[before] if before >= 0 else vote
            right = labels[after] if after < n else vote
            if headings[i]:
                label = right
            elif left == right:
                label = left
            else:
                label = vote or (left if i - before <= after - i else right)
        out.append(bool(label))
    return out


def _kept(found: list[Block]) -> list[bool]:
    headings = [b.tag in HEADINGS for b in found]
    content = [b.content for b in found]
    for loose in (True, False):
        labels = [first_pass(b, loose) for b in found]
        if any(labels) or any(label is None and inside for label, inside in zip(labels, content)):
            return second_pass(labels, headings, content)
    # No text anywhere: the prose that nothing speaks against, and its headings.
    prose = [label if label is not None else (True if b.tag in PARAGRAPHS else None) for b, label in zip(found, labels)]
    return second_pass([False if label is None and not h else label for label, h in zip(prose, headings)], headings, content)


def main_text(page: str) -> str:
    found = blocks(page)
    return "\n".join(b.text for b, keep in zip(found, _kept(found)) if keep)


def extract(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """``pages`` columns page_id, url plus text and n_chars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) if h else "" for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col(html_column).cast("string"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(C.table(spark, sf_dir, "pages"))
