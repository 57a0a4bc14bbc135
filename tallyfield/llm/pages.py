"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one for each block of the page.  A line weighs as many characters as it
has outside links; lines of menus, headers, footers, sidebars, notices, adverts, forms and comments weigh
nothing.  The weights of `WINDOW` lines in a row are summed: where the sum rises from nothing to a good
height the text surges, where it falls back to nothing it dives, and the lines between a
surge and its dive that have any weight are the text.  A page with an article element (else a main element) has its
distribution over that element alone and any height is a surge; without, a surge needs `HEIGHT` characters.

Each page is worked on alone, in the task that reads it: no shuffle, and memory follows the longest page.

Defined cases: a null html is an empty page and gives an empty text; a tag or comment that never ends
takes the rest of the page; text after an unclosed paragraph or inline tag counts all the same; a page that
has links or boilerplate only gives an empty text; repeated rows give repeated rows; all columns but the html are
handed on, also those with null ids; an empty table gives an empty table.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3  # lines of a block
HEIGHT = 80  # characters of a block where text surges, on pages without an article

# Names of elements and words in class names, as pages use them.
BLOCKS = set("address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("applet audio canvas embed head iframe math noembed noframes noscript object script style svg template textarea title video".split())
UNREAD = set("noembed noframes noscript script style template textarea title iframe".split())  # their content isn't markup
BOILERPLATE = set("aside button dialog footer form menu nav search select".split())
BOILERPLATE_ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
NOT_TEXT = set("ad ads adsense advert adverts advertisement advertising aside banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright dialog disclaimer disqus footer form gdpr login masthead menu menus modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo promotion recommendations recommended related replies reply search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split())
SAYS_OTHERWISE = set("has with without no hide".split())  # class names such as has-sidebar

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>")
ENDS = {tag: re.compile(rf"(?i)</{tag}(?=[\s/>])") for tag in UNREAD}
ATTRIBUTE = re.compile(r"(?i)(?<![\w-])(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
UNSEEN = re.compile(r"(?i)display\s*:\s*none|visibility\s*:\s*hidden")
COPYRIGHT = re.compile(r"(?i)(©|\(c\) |copyright\b)")


class Line(NamedTuple):
    text: str
    weight: int
    article: bool
    main: bool


def words_of_name(name: str) -> list[str]:
    return [w for w in re.split(r"[^a-z0-9]+", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "-", name).lower()) if w]


def is_boilerplate(tag: str, attributes: str, inside: bool) -> bool:
    """Whether an element holds no text of the article; inside: it lies in an article or main element."""
    if tag in BOILERPLATE or (tag == "header" and not inside):
        return True
    if not attributes or tag in ("html", "body", "main"):
        return False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and UNSEEN.search(value)):
            return True
        if name == "role" and value.lower() in BOILERPLATE_ROLES and not (inside and value.lower() == "banner"):
            return True
        if name in ("class", "id"):
            for part in value.split():
                words = words_of_name(part)
                if words and words[0] not in SAYS_OTHERWISE and (words[0] in NOT_TEXT or words[-1] in NOT_TEXT or (not inside and words[-1] == "header")):
                    return True
    return False


def lines_of(page: str) -> list[Line]:
    """The blocks of a page in order, without markup."""
    out: list[Line] = []
    parts: list[str] = []  # text of the current line
    linked = 0  # characters of it inside links
    stack: list[tuple[str, int, bool, bool]] = []  # open elements: name, boilerplate depth, in an article, in a main element
    bad, article, main, link_at, failures = 0, False, False, -1, 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                weight = 0 if bad or linked >= len(text) or (not article and len(text) < 200 and COPYRIGHT.match(text)) else len(text) - linked
                out.append(Line(text, weight, article, main))
            parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            if link_at >= 0:
                linked += len(" ".join(text.split()))

    i, n = 0, len(page)
    while i < n:
        at = page.find("<", i)
        if at < 0:
            add(page[i:])
            break
        add(page[i:at])
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            i = n if end < 0 else end + 3
            continue
        follows = page[at + 1 : at + 2]
        if follows and follows in "!?":
            end = page.find(">", at)
            i = n if end < 0 else end + 1
            continue
        if not (follows.isascii() and follows.isalpha()) and not (follows == "/" and page[at + 2 : at + 3].isalpha()):
            add("<")
            i = at + 1
            continue
        found = TAG.match(page, at) if failures < 64 else None
        if found:
            closing, tag, attributes, i = found[1], found[2].lower(), found[3], found.end()
        else:  # a quote that never ends
            failures += 1
            end = page.find(">", at)
            if end < 0:
                break
            closing, tag, attributes, i = ("/" if follows == "/" else ""), re.match(r"</?([^\s/>]*)", page[at : at + 64])[1].lower(), "", end + 1
        if tag in UNREAD and not closing:
            end = ENDS[tag].search(page, i)
            if end is None:
                break
            i = page.find(">", end.start()) + 1 or n
            continue
        if tag in BLOCKS:
            flush()
        if closing:
            if tag == "a":
                link_at = -1
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    bad, article, main = stack[-1][1:] if stack else (0, False, False)
                    if link_at > len(stack):
                        link_at = -1
                    break
            continue
        if tag == "a":
            link_at = len(stack)
        if tag in VOID:
            continue
        if tag in BLOCKS and stack and stack[-1][0] == "p":  # a block ends an open paragraph
            stack.pop()
            bad, article, main = stack[-1][1:] if stack else (0, False, False)
        spoiled = tag in HIDDEN or is_boilerplate(tag, attributes, article or main)
        if tag in BLOCKS or spoiled:
            if attributes.endswith("/") and tag not in BLOCKS:
                continue
            if spoiled and not bad:
                flush()
            bad, article, main = bad + spoiled, article or tag == "article", main or tag == "main"
            stack.append((tag, bad, article, main))
    flush()
    return out


def main_text(lines: list[Line]) -> str:
    """The lines between surges and dives, joined by one space."""
    weights = np.array([x.weight for x in lines], np.int64)
    region, height = np.ones(len(lines), bool), HEIGHT
    in_article = np.array([x.article for x in lines], bool)
    in_main = np.array([x.main for x in lines], bool)
    if 2 * weights[in_article].sum() >= weights[in_main].sum() > 0 or (weights[in_article].sum() > 0 and not in_main.any()):
        region, height = in_article, 1
    elif weights[in_main].sum() > 0:
        region, height = in_main, 1
    weights = np.where(region, weights, 0)
    # sums[i]: lines i - WINDOW + 1 to i; nothing lies before the first and after the last line
    total = np.concatenate([[0], np.cumsum(weights), np.full(WINDOW, weights.sum())])
    sums = total[1:] - np.concatenate([np.zeros(WINDOW, np.int64), total])[1 : len(total)]
    up = sums > 0
    start = np.flatnonzero(up & ~np.concatenate([[False], up[:-1]]))
    stop = np.flatnonzero(~up & np.concatenate([[False], up[:-1]]))
    kept = []
    for a, b in zip(start, stop):  # a surge, and the dive after it
        if sums[a:b].max() >= height:
            kept += [x.text for x, w in zip(lines[a:b], weights[a:b]) if w]
    return " ".join(kept)


def extract(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """The columns of `pages` other than the html, the main text and `n_chars` of it."""
    kept = [F.col(c) for c in pages.columns if c not in (html_col, out, "n_chars")]
    source = pages.select(*kept, F.coalesce(F.col(html_col), F.lit("")).alias(out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(out)
            texts = pa.array([main_text(lines_of(x.as_py())) for x in batch.column(at)], batch.schema.field(at).type)
            yield batch.set_column(at, out, texts)

    return source.mapInArrow(run, source.schema).withColumn("n_chars", F.length(out).cast("long"))
