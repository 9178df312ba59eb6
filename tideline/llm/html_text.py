"""Main text of web pages by the distribution of text over lines.

Markup is stripped: block elements become lines, inline tags vanish, elements
that never hold article text (menus, page headers and footers, sidebars,
notices, adverts, forms, scripts, styles, reader comments) are left out.
Text lengths are summed over a sliding window of lines; link text does not
count. A text begins at a surge, where the sum reaches ``SURGE`` characters, or
the page's fullest window if that has less, and ends at a dive, where a window
holds nothing but links; the lines between are kept whole.

A character in a marked article weighs ``ARTICLE`` times as much, so a short
article survives; text outside is kept where it surges by itself and has more
than ``RIVAL`` times the characters of the longest article, so a long notice
is not kept beside an article, but a body beside teasers is. Each article is a
text of its own, in which links are text once it has begun, and what is outside
goes on behind it. A stripped element ends no text, but no window reaches
across it to begin one. A dive ends no text outside while the same element
(other than body or main) goes on with more of it: lists of links between two
of its paragraphs are kept.

Names of class, id and role strip an element outside an article if one of their
words is on the list. Inside, where ``entry-header`` or ``related work`` may
hold the text itself, a whole name must be on the list or begin with one of
``SURELY_NOT``, and of a paragraph or heading all names.

Defined cases: null, empty and text-less pages give an empty text; a stripped
element that is never closed is only skipped if its content is no markup
(script, style); unknown or broken references stay as they are; repeated rows
return as often as they come; an empty table gives no rows; further columns
are ignored.
"""
from __future__ import annotations

import html as references
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tideline.llm.common import per_batch, whole

WINDOW = 3                 # lines
SURGE = 80                 # characters in a window
ARTICLE = 8                # weight of a character in a marked article
RIVAL = 2                  # text outside has more than this times the longest article

# Element names of HTML, and words of class, id and role names.
RAW = frozenset("script style noscript template iframe object svg math textarea select title head".split())
SKIPPED = frozenset("nav header footer aside form button menu dialog fieldset label option".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split())
NOT_TEXT = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer header login masthead menu modal nav navbar navigation newsletter notice notices pagination "
    "popup promo promoted related respond search share sharing sidebar signup social sponsor sponsored subscribe "
    "toolbar widget".split())
SURELY_NOT = frozenset(
    "ad ads advert adverts advertisement advertising breadcrumb breadcrumbs comment comments cookie cookies nav newsletter "
    "share sharing sidebar social sponsored subscribe".split())
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre td th tr figcaption caption".split())
ROOT = frozenset("html body main".split())
# End of the fixed values.

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""", re.S)
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(
    r"""(?:^|\s)hidden(?:[\s=/]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none""", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")


@lru_cache(1024)
def _end_of(name: str) -> re.Pattern:
    """Lower-casing the page instead would move what follows some letters."""
    return re.compile("</" + re.escape(name), re.I | re.A)


def _no_text(name: str, attributes: str, in_article: int) -> bool:
    if name in ("html", "body", "main") or name in VOID:
        return False
    if name in RAW or name in SKIPPED and not (name == "header" and in_article):
        return True
    if not attributes.strip():
        return False
    named = _NAMED.findall(attributes)
    words = {w for value in named for w in _SPLIT.split(value.lower())}
    if name == "article":
        return bool(words & {"comment", "comments"})
    if _HIDDEN.search(attributes):
        return True
    if not in_article or not words & NOT_TEXT:
        return bool(words & NOT_TEXT)
    whole_names = [w for value in named for w in value.strip("\"'").lower().split()]
    hits = [w != "header" and (w in NOT_TEXT or _SPLIT.split(w)[0] in SURELY_NOT) for w in whole_names]
    return bool(hits) and (all(hits) if name in LEAF else any(hits))


def lines(page: str) -> list[tuple[str, int, int, bool, int]]:
    """(text, article, characters of links, cut, container) of each line.

    ``article`` numbers the outermost articles from one and is zero outside;
    ``cut`` marks a line with a stripped element or the border of an article
    between itself and the line before. ``container`` numbers the innermost
    element around the line that is no paragraph, heading, item or cell; it is
    zero in the page itself.
    """
    out: list[tuple[str, int, int, bool, int]] = []
    around: list[tuple[str, int]] = []               # open block elements with their container
    containers = 0
    part: list[str] = []
    at = article = link = linked = number = 0
    skip, depth, cut = "", 0, False

    def end_line():
        nonlocal linked, cut
        text = " ".join(references.unescape("".join(part)).split())
        if text:
            out.append((text, number if article else 0, linked, cut, around[-1][1] if around else 0))
            cut = False
        part.clear()
        linked = 0

    for m in _TOKEN.finditer(page):
        if m.start() < at:
            continue
        if not skip:
            part.append(page[at:m.start()])
            if link:
                linked += m.start() - at
        at = m.end()
        name = (m[2] or "").lower()
        closing = m[1] == "/"
        if not name:
            continue
        if skip:
            if skip == "p" and name != "p" and name not in INLINE and name not in VOID:
                skip = ""                            # a paragraph ends where the next block begins or the outer one ends
            elif name == skip:
                depth += -1 if closing else 1
                if depth <= 0 or skip == "p":
                    skip = ""
                    if not (m[2].lower() == "p" and not closing):
                        continue
                else:
                    continue
            else:
                continue
        if not closing and _no_text(name, m[3], article):
            shut = _end_of(m[2]).search(page, at)
            if name in RAW and name != "head":
                at = len(page) if not shut else max(at, page.find(">", shut.start()) + 1 or len(page))
                continue
            elif name == "p" or shut:
                skip, depth = name, 1
            else:
                continue
            end_line()
            cut = True
            continue
        if name == "a":
            link = 0 if closing else 1
        if name in INLINE:
            continue
        end_line()
        if closing:
            i = len(around) - 1
            while i >= 0 and around[i][0] != name:
                i -= 1
            if i >= 0:
                del around[i:]
        elif name not in VOID and name not in ROOT:
            if around and (around[-1][0] == "p" or around[-1][0] == name and name in LEAF):
                around.pop()                         # its end tag is left out
            if name in LEAF:
                around.append((name, around[-1][1] if around else 0))
            else:
                containers += 1
                around.append((name, containers))
        if name == "article":
            cut = True
            number += not closing and not article
            article = max(0, article + (-1 if closing else 1))
    if not skip:
        part.append(page[at:])
    end_line()
    return out


def window_sums(lengths: np.ndarray, cuts: np.ndarray | None = None, window: int = WINDOW) -> np.ndarray:
    """Sum of each line and those after it in its window, which ends ahead of a line marked in ``cuts``."""
    total = np.concatenate([[0], np.cumsum(lengths)])
    stop = np.minimum(np.arange(len(lengths)) + window, len(lengths))
    if cuts is not None:
        ends = np.r_[np.flatnonzero(cuts), len(lengths)]
        stop = np.minimum(stop, ends[np.searchsorted(ends, np.arange(len(lengths)), side="right").clip(max=len(ends) - 1)])
    return total[stop] - total[:-1]


def surge_to_dive(lengths: np.ndarray, sums: np.ndarray, limit: int) -> np.ndarray:
    """Mask of the lines between each surge of ``sums`` and the dive of ``lengths`` after it."""
    keep = np.zeros(len(lengths), bool)
    left = window_sums(lengths)
    inside = False
    for i in range(len(lengths)):
        inside = left[i] > 0 if inside else lengths[i] > 0 and sums[i] >= limit
        keep[i] = inside
    return keep


def go_on(keep: np.ndarray, plain: np.ndarray, container: np.ndarray) -> np.ndarray:
    """``keep`` and the lines from the first kept one of an element to the last with text of the same element."""
    step = np.zeros(len(keep) + 1, np.int64)
    text = (plain > 0) & (container > 0)
    last = {c: i for i, c in zip(np.flatnonzero(text).tolist(), container[text].tolist())}
    begun = set()
    for i in np.flatnonzero(keep & text).tolist():
        c = int(container[i])
        if c not in begun:
            begun.add(c)
            step[i] += 1
            step[last[c] + 1] -= 1
    return keep | (np.cumsum(step[:-1]) > 0)


def main_text(page: str) -> str:
    found = lines(page)
    if not found:
        return ""
    size, article, linked, cuts, container = (
        np.array(x) for x in zip(*((len(t), a, n, c, e) for t, a, n, c, e in found)))
    plain = np.maximum(0, size - linked)
    if not plain.any():
        plain = np.where(article > 0, size, 0)       # an article of links only
    lengths = np.where(article > 0, size, plain)
    # what is outside goes on behind an article, and each article is a text of its own
    flows = [np.flatnonzero(article == a) for a in np.unique(article)]
    sums = np.zeros(len(found), np.int64)
    for rows in flows:
        cut = cuts[rows] | (np.diff(rows, prepend=rows[0]) > 1)
        sums[rows] = window_sums(np.where(article > 0, ARTICLE, 1)[rows] * plain[rows], cut)
    limit = min(SURGE, max(1, sums.max()))
    longest = max((int(plain[rows].sum()) for rows in flows if article[rows[0]]), default=0)
    keep = np.zeros(len(found), bool)
    for rows in flows:
        kept = surge_to_dive(lengths[rows], sums[rows], limit)
        if not article[rows[0]]:
            kept = go_on(kept, plain[rows], container[rows])
            begins = kept & ~np.r_[False, kept[:-1]]
            text = np.cumsum(begins) * kept          # number of the text a line is part of
            kept &= np.bincount(text, plain[rows] * kept)[text] > RIVAL * longest
        keep[rows] = kept
    return " ".join(t for (t, *_), k in zip(found, keep) if k)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    def run(batch):
        texts = [main_text(h) for h in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            names=["page_id", "url", "text", "n_chars"])

    x = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                     whole(html).alias("html"))
    return per_batch(run, x, "page_id long, url string, text string, n_chars long")
