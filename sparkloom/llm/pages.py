"""Main text of web pages, with boilerplate found by repeats within a host.

A page is parsed into blocks of visible text, each in one of three regions:

* ``main``: inside an article or main element. It is kept, whatever repeats: two
  pages may carry the same article or quote the same passage.
* ``out``: inside an element that is no text (script, style, ...) or that names
  itself a menu, header, footer, sidebar, notice, advert, form or comments, by
  its tag, role, class or id. It is removed, also where a page alone has it.
* ``open``: the markup does not say. Here repeats decide, on pages with an article
  and on others. So they do inside a main element for parts whose class or id has a
  word that may as well speak of the text, as in ``post-header`` or ``related-work``.

For these the token streams of a host's pages, their ``open`` and visible ``out``
blocks in order, are put together, and their suffixes are brought together that
share their first ``REPEAT`` tokens: the intervals of the host's suffix array whose
common prefixes are no shorter. Neither the order of the suffixes inside an
interval nor longer prefixes are made, as they would mark no token more: each
window of a longer repeat is an interval too. An interval that comes from streams
of two distinct contents is a repeated substring, and its tokens are boilerplate.
The text is what is left of the open blocks, the unique runs, and the main blocks,
in page order.

The suffixes are rows, grouped by a shuffle on (host, prefix) with partial
aggregates (the least and the greatest stream), so neither a host nor a repeated
line with a third of all rows is gathered in one place.

Defined results: null html is empty; a page without visible text has the empty
text; streams shorter than ``REPEAT`` tokens are one group key as a whole; pages
with one and the same stream count once, so a page stored twice does not erase
itself; a page cut off in the middle is parsed as far as it goes; a null url is
a host of its own name, the empty one. Repeated rows, also with one id, are pages
each; pages and attributes of any length are read whole; an empty table gives an
empty result; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.llm.shared import join_groups, keep, map_texts, ship

REPEAT = 8

# The vocabulary of HTML, and names that pages give to their parts.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style noscript template textarea title iframe xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp"
    " small span strike strong sub sup time tt u var wbr".split()
)
OUT_TAGS = frozenset(
    "script style noscript template textarea title iframe xmp head nav header footer aside form"
    " button select option svg object canvas dialog menu audio video map".split()
)
OUT_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar"
    " toolbar".split()
)
OUT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner"
    " cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe"
    " subscription signup sidebar side menu menus nav navbar navigation breadcrumb breadcrumbs"
    " header masthead footer share sharing social related recommended recommendations comment"
    " comments reply replies disqus widget widgets toolbar pagination pager hidden".split()
)
MAIN_TAGS = ("article", "main")
# An open element of these ends when another of its group starts.
CLOSES = {
    "p": frozenset(["p"]), "li": frozenset(["li"]), "dd": frozenset(["dd", "dt"]),
    "dt": frozenset(["dd", "dt"]), "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"]),
}

_TAG_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"([a-zA-Z_:-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[^A-Za-z0-9]+")
_HAS = re.compile(r"^(?:has|no|with|without|is)[-_]", re.I)


# Of these, words that inside a main element may as well speak of the text.
UNSURE_NAMES = frozenset(
    "header footer masthead side social related recommended recommendations notice notices notification"
    " banner promotion subscription signup toolbar pager menu menus sidebar hidden".split()
)


def _tag_at(page: str, at: int) -> tuple[bool, str, str, int] | None:
    """The tag that starts at ``at``: is it an end tag, name, attributes, where it ends.

    A quoted value may hold any character. Without its quote's end a value is taken
    to end with the tag, at the next ``>``. None if there is no tag, or no end.
    """
    name = _TAG_NAME.match(page, at)
    if not name:
        return None
    here = name.end()
    while True:
        end = page.find(">", here)
        if end < 0:
            return None
        # The first quote before the tag's end that opens a value.
        opened = _QUOTE.search(page, here, end)
        if not opened:
            return bool(name[1]), name[2].lower(), page[name.end() : end], end + 1
        closed = page.find(opened[1], opened.end())
        if closed < 0:
            return bool(name[1]), name[2].lower(), page[name.end() : end], end + 1
        here = closed + 1


_QUOTE = re.compile(r"=\s*([\"'])")


def _said(attributes: str, inside: bool) -> str | None:
    """What an element's attributes call it: "out", "open" if they leave it open, or None."""
    said = None
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "")
        if name in ("class", "id"):
            for word in value.split():
                parts = [] if _HAS.match(word) else [part.lower() for part in _NAME.split(word)]
                known = OUT_NAMES.intersection(parts)
                if known and (not inside or known - UNSURE_NAMES):
                    return "out"
                if known:
                    said = "open"
        elif name == "role" and value.lower().strip() in OUT_ROLES:
            return "out"
        elif name == "hidden" and (m[2] or m[3] or m[4] or "hidden").lower() != "false":
            return "out"
        elif name == "aria-hidden" and value.lower() == "true":
            return "out"
        elif name == "style" and "display:none" in value.replace(" ", "").lower():
            return "out"
    return said


def _is_main(tag: str, attributes: str) -> bool:
    """Whether an element holds the main text."""
    return (
        tag in MAIN_TAGS
        or "articlebody" in attributes.lower()
        or re.search(r"role\s*=\s*[\"']?main\b", attributes, re.I) is not None
    )


def blocks(page: str) -> list[tuple[str, str]]:
    """Visible blocks (region, text) in page order.

    Regions are "main", "out" and "open". White space in a block is one space.
    """
    found: list[tuple[str, str]] = []
    stack: list[tuple[str, str | None]] = []  # tag, and its region if it sets one

    def region() -> str:
        said = [r for _, r in stack if r]
        return "out" if "out" in said else said[-1] if said else "open"
    buffer: list[str] = []

    def flush() -> None:
        if buffer:
            text = " ".join(html.unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                found.append((region(), text))

    def pop_to(at: int) -> None:
        if any(t not in INLINE or r for t, r in stack[at:]):
            flush()
        del stack[at:]

    at, size = 0, len(page)
    while at < size:
        sign = page.find("<", at)
        if sign < 0:
            buffer.append(page[at:])
            break
        if sign > at:
            buffer.append(page[at:sign])
        if page.startswith("<!--", sign):
            end = page.find("-->", sign + 4)
            at = size if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), sign):
            end = page.find(">", sign)
            at = size if end < 0 else end + 1
            continue
        tag_match = _tag_at(page, sign)
        if not tag_match:
            if re.match(r"</?[a-zA-Z]", page[sign : sign + 3]):
                break  # cut off inside a tag
            buffer.append("<")
            at = sign + 1
            continue
        closing, tag, attributes, at = tag_match
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    pop_to(i)
                    break
                if stack[i][1] == "main" and tag not in ("body", "html", "main", "article", "div", "section"):
                    break  # a stray end tag does not close an article
            else:
                if tag not in INLINE:
                    flush()
            continue
        if tag in RAW:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else size
            flush()
            continue
        if tag not in INLINE:
            flush()
            if tag in CLOSES or tag not in VOID:
                ends = CLOSES.get(tag, CLOSES["p"])
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in ends:
                        pop_to(i)
                        break
                    if stack[i][0] not in INLINE:
                        break
        if tag in VOID or attributes.endswith("/") and tag not in INLINE:
            continue
        inside = any(r == "main" for _, r in stack)
        said = None if tag in ("html", "body") else _said(attributes, inside)
        if tag in OUT_TAGS and not (tag == "header" and inside):
            said = "out"
        elif said is None and _is_main(tag, attributes):
            said = "main"
        if said:
            flush()
        stack.append((tag, said))
    flush()
    return found


def main_text(page: str) -> str:
    """The text of the main blocks alone."""
    return " ".join(text for region, text in blocks(page) if region == "main")


def host_of(url: Column) -> Column:
    """The host in lower case without a port; the empty text where there is none."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#:]*)", 1)
    return F.lower(F.regexp_replace(host, r"^.*@", ""))


def _settled(texts: list[str]) -> tuple[list[int], dict]:
    """The pages without open blocks, with their text: their main blocks."""
    rows, found = [], []
    for i, page in enumerate(texts):
        parts = blocks(page)
        if all(region != "open" for region, _ in parts):
            rows.append(i)
            found.append(" ".join(text for region, text in parts if region == "main"))
    return rows, {"text": found}


def _streams(texts: list[str]) -> tuple[list[int], dict]:
    """Tokens outside of main blocks, and whether their block is open; where the page
    has open blocks, also its main blocks, each with the number of tokens before it."""
    rows, words, is_open, main, main_at = [], [], [], [], []
    for i, page in enumerate(texts):
        stream, texts_, places = [], [], []
        for region, text in blocks(page):
            if region == "main":
                texts_.append(text)
                places.append(len(stream))
            else:
                stream += [(w, region == "open") for w in text.split()]
        if not stream:
            continue
        has_open = any(o for _, o in stream)
        rows.append(i)
        words.append([w for w, _ in stream])
        is_open.append([o for _, o in stream])
        main.append(texts_ if has_open else [])
        main_at.append(places if has_open else [])
    return rows, {"words": words, "is_open": is_open, "main": main, "main_at": main_at}


def unique_runs(
    words: list[str], is_open: list[bool], main: list[str], main_at: list[int], starts: list[int], repeat: int
) -> str:
    """The main blocks and the open tokens that no repeated substring covers, in page order.

    Repeated substrings begin at ``starts``.
    """
    covered = bytearray(len(words) + 1)
    for s in starts:
        covered[s : s + repeat] = b"\1" * len(covered[s : s + repeat])
    left = [w if o and not c else None for w, o, c in zip(words, is_open, covered)]
    parts, done = [], 0
    for text, at in zip([*main, None], [*main_at, len(words)]):
        parts += [w for w in left[done:at] if w is not None]
        done = at
        if text is not None:
            parts.append(text)
    return " ".join(parts)


def _assembled(batches: Iterator[pa.RecordBatch], repeat: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("words", "is_open", "main", "main_at", "starts")))
        texts = [unique_runs(w, o, m, a, s or [], repeat) for w, o, m, a, s in rows]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), batch.column("_url"), pa.array(texts, pa.string())],
            ["_id", "_url", "text"],
        )


def repeated_starts(streams: DataFrame, repeat: int) -> DataFrame:
    """Rows (row, starts): where a repeated substring begins in a stream.

    Only hosts with an open block are looked at; elsewhere nothing depends on it.
    """
    hosts = streams.filter("exists(is_open, o -> o)").select("_host").distinct()
    mine = keep(streams.join(hosts, "_host", "left_semi"), "host-streams")
    # A suffix for each token that has enough behind it, one at least.
    at = F.explode(F.expr(f"sequence(0, greatest(0, size(words) - {repeat}))")).alias("at")
    suffixes = (
        mine.filter(F.size("words") > 0)
        .select("_host", "row", "words", F.xxhash64("words").alias("stream"), at)
        .select(
            "_host", "row", "stream", "at", F.xxhash64(F.expr(f"slice(words, at + 1, {repeat})")).alias("prefix")
        )
    )
    repeats = keep(
        suffixes.groupBy("_host", "prefix")
        .agg(F.min("stream").alias("low"), F.max("stream").alias("high"), F.count("*").alias("n"))
        .filter("low <> high")
        .select("_host", "prefix", "n"),
        "host-repeats",
    )
    total = mine.agg(F.sum(F.greatest(F.size("words") - repeat + 1, F.lit(1)))).first()[0] or 0
    return (
        join_groups(suffixes, repeats, ["_host", "prefix"], "n", total)
        .groupBy("row")
        .agg(F.collect_list("at").alias("starts"))  # those of one page
    )


def extract_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    repeat: int = REPEAT,
) -> DataFrame:
    """One row per row: the id, the url and ``text``.

    The html is parsed twice: for the streams, and for the pages that need none. So
    the text of a page without open blocks is not written down on the way.
    """
    ship(pages.sparkSession)
    named = pages.select(
        F.col(id_col).alias("_id"),
        F.col(url_col).alias("_url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("_text"),
    )
    settled = map_texts(named, _settled, "text string")
    streams = keep(
        map_texts(
            named.withColumn("_host", host_of(F.col("_url"))),
            _streams,
            "words array<string>, is_open array<boolean>, main array<string>, main_at array<int>",
        ).withColumn("row", F.monotonically_increasing_id()),
        "page-streams",
    )
    starts = repeated_starts(streams, repeat)
    texts = T.StructType([named.schema["_id"], named.schema["_url"], T.StructField("text", T.StringType())])
    others = (
        streams.filter("exists(is_open, o -> o)")
        .join(starts, "row", "left")
        .select("_id", "_url", "words", "is_open", "main", "main_at", "starts")
        .mapInArrow(lambda batches: _assembled(batches, repeat), texts)
    )
    return settled.unionByName(others).select(
        F.col("_id").alias(id_col), F.col("_url").alias(url_col), "text"
    )
