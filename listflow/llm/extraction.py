"""Main text of web pages by line-block distribution.

Markup is stripped to lines (one per block element). Each line has a text length: the characters
outside links, and zero inside menus, headers, footers and the like. Sums over a sliding window
of lines show where text surges and where it dives back to nothing; the lines between are kept.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of the HTML standard, and words that name page furniture.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option "
    "p pre search section select summary table tbody td tfoot th thead title tr ul".split())
RAW = frozenset("script style noscript template textarea iframe noframes noembed xmp svg math title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE = frozenset("nav header footer aside form menu dialog button select head search fieldset object".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search menu menubar dialog alert alertdialog toolbar form".split())
FURNITURE_WORDS = frozenset(
    "ad ads adv advert advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies copyright disclaimer discussion disqus feedback footer gdpr header masthead menu modal nav "
    "navbar navigation newsletter notice notices pager pagination popup promo promoted promotion recommended "
    "related replies respond responses share sharing sidebar signup skip social sponsor sponsored subscribe subscription "
    "tags toolbar toc widget widgets".split())
#: Furniture that is so whatever it holds; the other names may also stand on a wrapper around the main text.
_SURE_TAGS = FURNITURE - {"form", "fieldset", "object"}
_SURE_WORDS = frozenset(
    "advertisement advertising breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright "
    "disclaimer discussion disqus feedback footer gdpr nav navbar navigation newsletter pager pagination promoted promotion "
    "recommended related replies respond responses signup sponsored subscribe subscription".split())
#: Names that tell a state of the page, such as ``has-sidebar`` or ``comments-closed``, not what an element is.
_STATE = re.compile(r"(?i)(?:no|not|has|with|without|hide|show)[-_].*|.*[-_](?:open|opened|closed|off|disabled|hidden)")

CONTAINERS = frozenset("div section article main td details dd fieldset center".split())

#: Elements whose content a stray end tag does not end, and the end tags that may.
_CONTENT = ("article", "main", "body")
_ENDS_CONTENT = frozenset((*_CONTENT, "html"))

#: Opening tags whose end tag may be left out: a new one of the group closes the last.
_SELF_CLOSING = {"li": {"li"}, "p": {"p"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
                 "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*+)>|<[a-zA-Z/!?][^>]*+>", re.S)
_CUT_TAG = re.compile(r"<[a-zA-Z/!][^<>]*\Z")
_TAG_PARTS = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)(.*)>", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_SPLIT_NAME = re.compile(r"[a-z]+|[A-Z][a-z]*")


_SURE = frozenset("!")
_NONE: frozenset[str] = frozenset()


@dataclass
class Line:
    """One block of text: its characters outside links, whether it is page furniture or main content,
    the number of the container it stands in (0: none but the body), and the words that make it furniture."""

    text: str
    plain: int
    furniture: bool
    content: bool
    parent: int
    words: frozenset[str] = _NONE


def _furniture_words(tag: str, attributes: str) -> frozenset[str]:
    """What makes an element page furniture: nothing, words that a wrapper of the main text may have too, or ``!``."""
    if tag in _SURE_TAGS:
        return _SURE
    words = {f"<{tag}>"} if tag in FURNITURE else set()
    if attributes.strip() and tag not in ("html", "body", "article", "main"):
        for name, a, b, c in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), a or b or c
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return _SURE
            if name == "role" and value.lower() in ROLES:
                return _SURE
            if name in ("class", "id"):
                words.update(w.lower() for one in value.split() if not _STATE.fullmatch(one)
                             for w in _SPLIT_NAME.findall(one) if w.lower() in FURNITURE_WORDS)
    return _SURE if words & _SURE_WORDS else frozenset(words)


def page_lines(page: str) -> list[Line]:
    """The blocks of a page in order; comments, scripts and styles are gone, references decoded.

    A tag that the end of the page cuts off is dropped. White space inside a block is one space. Blocks that are
    empty are left out, but furniture leaves an empty line as a gap. Words on elements that hold most of the
    text name a wrapper, not furniture.
    """
    lines: list[Line] = []
    parts: list[str] = []
    linked = 0
    # name, what makes it furniture from here on, inside main content, container, whether furniture begins here
    open_tags: list[tuple[str, frozenset[str], bool, int, bool]] = []
    standing: defaultdict[str, list[int]] = defaultdict(list)  # places of a name's open tags
    in_link = containers = 0
    outside = ("", _NONE, False, 0, False)

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                _, words, content, container, _ = open_tags[-1] if open_tags else outside
                lines.append(Line(text, max(0, len(text) - linked), bool(words), content, container, words))
        parts, linked = [], 0

    def close(to: int) -> None:
        nonlocal in_link
        if any(t[0] in BLOCKS for t in open_tags[to:]):
            flush()
        if any(t[4] for t in open_tags[to:]):
            flush()
            lines.append(Line("", 0, True, False, 0, frozenset().union(*{t[1] for t in open_tags[to:]})))
        in_link = max(0, in_link - sum(t[0] == "a" for t in open_tags[to:]))
        for t in open_tags[to:]:
            standing[t[0]].pop()
        del open_tags[to:]

    at, end = 0, page.rfind(">") + 1
    while at < end:
        m = _TOKEN.search(page, at, end)
        if m is None:
            break
        if m.start() > at:
            parts.append(page[at:m.start()])
            linked += (m.start() - at) * bool(in_link)
        at = m.end()
        token = m if m[2] else _TAG_PARTS.fullmatch(m[0])
        if m[0].startswith("<!") or token is None:
            continue
        closing, tag, attributes = token[1], token[2].lower(), token[3]
        if closing:
            k = standing[tag][-1] if standing[tag] else -1
            # a stray end tag does not end the content
            content = -1 if tag in _ENDS_CONTENT else max(
                (standing[t][-1] for t in _CONTENT if standing[t]), default=-1)
            if k >= 0 and k > content:
                close(k)
            elif content < 0 and tag in BLOCKS:
                flush()
            continue
        if tag in RAW and not attributes.endswith("/"):
            stop = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = stop.end() if stop else len(page)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        group = _SELF_CLOSING.get(tag)
        if group and open_tags and open_tags[-1][0] in group:
            close(len(open_tags) - 1)
        elif group or tag in BLOCKS:
            # an open paragraph, with the inline elements in it, ends where a block begins
            k = len(open_tags)
            while k and open_tags[k - 1][0] not in BLOCKS:
                k -= 1
            if k and open_tags[k - 1][0] == "p":
                close(k - 1)
        above = open_tags[-1] if open_tags else outside
        containers += tag in CONTAINERS
        content = above[2] or tag in ("article", "main")
        own = _furniture_words(tag, attributes)
        words = above[1] | own if own - above[1] else above[1]
        if above[1] and content and tag in ("h1", "h2", "h3"):
            # a heading in the header of an article is furniture only if the header stands in furniture
            k = next((k for k in range(len(open_tags) - 1, max(-1, len(open_tags) - 4), -1) if open_tags[k][0] == "header"), -1)
            if k >= 0:
                words = open_tags[k - 1][1] if k else _NONE
        begins = bool(own and words)
        if tag in BLOCKS or begins:
            flush()
            if begins:
                lines.append(Line("", 0, True, False, 0, words))
        standing[tag].append(len(open_tags))
        open_tags.append((tag, words, content, containers if tag in CONTAINERS else above[3], begins))
        in_link += tag == "a"
    if at < len(page):
        parts.append(_CUT_TAG.sub("", page[at:]))
    flush()
    return _without_wrappers(lines)


def _without_wrappers(lines: list[Line]) -> list[Line]:
    """The lines with ``furniture`` as it stands once words of wrappers are known.

    A word whose elements hold over half of the text (of the main content, if that is marked) is no
    furniture in this page. If all text would still be furniture, only what is sure is, and if all is that, nothing.
    """
    pool = [x for x in lines if x.text and "!" not in x.words]
    pool = [x for x in pool if x.content and x.plain] or pool
    share: defaultdict[str, int] = defaultdict(int)
    for x in pool:
        for word in x.words:
            share[word] += x.plain
    total = sum(x.plain for x in pool)
    wrappers = frozenset(w for w, n in share.items() if 2 * n > total)
    filled = {x.words for x in lines if x.text}
    if filled and all(words - wrappers for words in filled):
        wrappers = frozenset().union(*filled)
        if not all("!" in words for words in filled):
            wrappers -= _SURE
    if not wrappers:
        return lines
    for x in lines:
        x.furniture = bool(x.words - wrappers)
    return [x for x in lines if x.text or x.furniture]


def main_text(page: str | None, window: int = 3, surge: int = 80) -> str:
    """The lines between surge and dive points, joined by newlines.

    ``window`` lines are summed from each line on. In a page that marks its main content, its lines count
    as longer than ``surge`` and all others as furniture. Text surges at a line whose sum exceeds
    ``surge`` and dives at the next line whose sum is zero or that is furniture.
    Where nothing surges, the run with the most text is kept. Lines between other dives stay if they
    stand in the same container as kept ones. Null or no text gives ''.
    """
    lines = page_lines(page or "")
    marked = [x for x in lines if x.content and not x.furniture]
    if any(x.plain for x in marked) or marked and not any(x.plain and not x.furniture for x in lines):
        # the marks raise the lengths of all main content, so that its short and linked lines surge too, and zero the rest
        for x in lines:
            x.furniture = x.furniture or not x.content
            x.plain += surge + 1 if x.text else 0
    lengths = [0 if x.furniture else x.plain for x in lines]
    sums, total = [], 0
    for i in range(len(lines) - 1, -1, -1):
        total += lengths[i] - (lengths[i + window] if i + window < len(lines) else 0)
        sums.append(total)
    sums.reverse()
    kept: list[list[int]] = []
    runs: list[list[int]] = []
    i = 0
    while i < len(lines):
        if not lengths[i]:
            i += 1
            continue
        run, surged = [], False
        while i < len(lines) and (sums[i] > 0 and not lines[i].furniture):
            surged = surged or sums[i] > surge
            if lines[i].text:
                run.append(i)
            i += 1
        while run and not lengths[run[-1]]:
            run.pop()
        runs.append(run)
        if surged:
            kept.append(run)
    if not kept and runs:
        kept = [max(runs, key=lambda r: sum(lengths[k] for k in r))]
    # short text that furniture cuts off from its article still stands in the article's container
    within = {lines[k].parent for run in kept for k in run} - {0}
    chosen = {k for run in kept for k in run} | {k for run in runs for k in run if lines[k].parent in within}
    return "\n".join(lines[k].text for k in sorted(chosen))


def extract_main_text(pages: DataFrame, html_col: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the main text of ``html_col`` in ``into`` and its code points in ``n_chars``.

    Rows stay as they are (also repeated ones); columns of those two names are replaced. Python
    works on Arrow batches, one page at a time, so memory is bounded by a batch.
    """

    @F.pandas_udf("string")
    def extract(column: pd.Series) -> pd.Series:
        return column.map(main_text, na_action=None)

    return pages.withColumn(into, extract(F.col(html_col))).withColumn("n_chars", F.length(into).cast("long"))
