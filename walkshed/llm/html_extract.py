"""Main text of web pages by the distribution of text over line blocks.

A page is cut into lines at block elements; markup, comments, scripts, styles, forms and
elements that are named as menus, headers, footers, sidebars, notices, adverts or reader
comments give lines without text. The text lengths of ``WINDOW`` successive lines are summed;
where the sums rise from nothing text surges, where they fall to nothing it dives. Windows with
links in every line and hardly a word beside them are menus, inside an article too: text dives there. Text
between a surge and its dive is a candidate. Inside article or main elements, if a page has
any, all that surges there is its text. Elsewhere the candidate with the most text outside of links
is the text, with all others under its parent element, which only left-out elements part from it, and
with those elsewhere that are of a like weight.

The time grows with the length of a page whatever its markup: quotes and tags that never end,
deep nesting and end tags without a start cost no more than others.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from walkshed.llm.common import map_texts

#: Lines whose lengths are summed, and empty lines that stand for an element left out around a text.
#: What is left out within a text, such as an advert, leaves one empty line.
WINDOW, GAP = 3, 4
#: A candidate under another parent joins the heaviest one from this part of its weight on.
JOINS = 0.3
#: Outside of an article, lines with more of their text in links may be of a menu; inside, those with nothing else.
LINK_SHARE = 0.6

# Element names of HTML.
RAW = frozenset({"script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "math", "object", "xmp"})
LEFT_OUT = frozenset({
    "head", "nav", "menu", "aside", "footer", "form", "button", "select", "dialog", "fieldset", "datalist",
    "canvas", "audio", "video", "map",
})
VOID = frozenset({
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
})
INLINE = frozenset({
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "embed", "font",
    "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike",
    "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
})
CONTENT = frozenset({"article", "main"})
TABLE = frozenset({"table", "caption", "colgroup", "thead", "tbody", "tfoot", "tr", "td", "th"})
_CELL, _ROW, _ROWS = frozenset({"td", "th"}), frozenset({"tr"}), frozenset({"thead", "tbody", "tfoot", "caption", "colgroup"})
_LOOSE = frozenset({"p", "div", "address"})
#: Elements without a needed end tag, by the start tags that end them: within their list, or within their table.
IN_LIST = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt")}
IN_TABLE = {
    **dict.fromkeys(_CELL, [_CELL]), **dict.fromkeys(_ROW, [_CELL, _ROW]), **dict.fromkeys(_ROWS, [_CELL, _ROW, _ROWS])
}
#: Block elements, whose start ends a paragraph.
ENDS_P = frozenset({
    "address", "article", "aside", "blockquote", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "li", "main",
    "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "ul",
})

#: Blocks that hold a part of a text, never several parts of it.
_LEAVES = frozenset({"p", "li", "dd", "dt", "pre", "blockquote", "span", "h1", "h2", "h3", "h4", "h5", "h6"}) | TABLE

_OPENS = re.compile(r"<(?:!--|[!?]|(/?)([A-Za-z][A-Za-z0-9:-]*))")
_SPECIAL = re.compile(r"[>\"']")
_ENDS = re.compile(r"</([A-Za-z][A-Za-z0-9:-]*)\s*>")
_ANY_CONTENT = re.compile(r"<(?:article|main)[\s/>]", re.I)
_NAMED = re.compile(r"\b(id|class|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
#: Whole words of an id, class or role that say an element is not part of the article. Of hyphenated ones
#: such as sidebar-right, which say how a wrapper is laid out, no part is taken alone.
_BOILERPLATE = re.compile(
    r"(?:(?:site|page|main|top|global|left|right|bottom|primary|secondary|reader|user|cookie|ads?|social|nav|post|article)[-_]?)*"
    r"(?:ads?|advert\w*|banners?|sponsor(?:ed|s)?|promos?|nav(?:bar|igation)?|menus?|breadcrumbs?|side-?bars?"
    r"|aside|widgets?|footers?|(?:site|page|main|top|global)[-_]?header|masthead|cookies?|consent|notices?|notifications?"
    r"|popups?|modal|overlay|newsletter|subscribe|subscription|signup|login|share|sharing|social|related|recommend\w*"
    r"|comments?|disqus|replies|respond|pagination|pager|search|toolbar|complementary|contentinfo|skip-?link)"
    r"(?:[-_]?(?:lists?|sections?|threads?|area|form|box|blocks?|bar|slots?|units?|links?|buttons?|items?|posts?|container|wrapper"
    r"|banner|notice|menu))?",
    re.I,
)

_WITHIN = re.compile(r"(?:^|[^a-z])(?:ads?|advert\w*|sponsor\w*|promos?|widgets?|newsletter|subscri\w+|signup|shar\w+|social|related)(?:$|[^a-z])", re.I)
_WITHIN_TAGS = frozenset({"form", "button", "select", "fieldset", "datalist", "canvas", "audio", "video", "map"})


class _Line:
    __slots__ = ("parts", "links", "plain", "inside", "node")

    def __init__(self, inside: int) -> None:
        self.parts, self.links, self.plain, self.inside, self.node = [], 0, 0, inside, 0


class _Open:
    """The open elements, and where in them each tag is: looked up, never searched."""

    def __init__(self) -> None:
        self.tags, self.tight, self.at = [], [], {}

    def push(self, tag: str) -> None:
        self.at.setdefault(tag, []).append(len(self.tags))
        if tag not in _LOOSE:
            self.tight.append(len(self.tags))
        self.tags.append(tag)

    def cut(self, keep: int) -> None:
        for tag in reversed(self.tags[keep:]):
            self.at[tag].pop()
            if tag not in _LOOSE:
                self.tight.pop()
        del self.tags[keep:]

    def last(self, tags, below: int) -> int:
        """The place of the last open element of ``tags`` before place ``below``, or -1."""
        found = -1
        for tag in tags:
            places = self.at.get(tag)
            if places and (n := bisect_left(places, below)):
                found = max(found, places[n - 1])
        return found

    def after_start(self, tag: str) -> int:
        """How many of the open elements stay open when ``tag`` starts."""
        keep = len(self.tags)
        if tag in ENDS_P and (p := self.last(("p",), keep)) > self.last(_AROUND_P, keep):
            keep = p
        if tag in IN_LIST:
            n = bisect_left(self.tight, keep)
            if n and self.tags[self.tight[n - 1]] in IN_LIST[tag]:
                keep = self.tight[n - 1]
        elif tag in ("option", "optgroup"):
            keep -= bool(keep and self.tags[keep - 1] == "option")
        for ended in IN_TABLE.get(tag, ()):
            if (found := self.last(ended, keep)) > self.last(("table",), keep):
                keep = found
        return keep

    def after_end(self, tag: str) -> int:
        """How many of the open elements stay open at the end tag; all, if it ends none."""
        keep = len(self.tags)
        around = ("table",) if tag in TABLE else TABLE if tag != "li" else _AROUND_LI
        found = self.last((tag,), keep)
        return found if found >= 0 and found >= self.last(around, keep) else keep


_AROUND_P, _AROUND_LI = TABLE | {"button"}, TABLE | {"ul", "ol", "menu"}


def _tokens(page: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """(start, end, whether an end tag, tag or "" for comments, attributes); ``send`` goes on from a later place.

    What starts like a tag and never ends is text. Opening quotes from which no tag ended are kept, so that
    no stretch is walked twice in vain.
    """
    at, last_gt, special, dead = 0, page.rfind(">"), -1, set()
    while (found := _OPENS.search(page, at)) is not None:
        start, end, tag = found.start(), found.end(), found.group(2)
        at = start + 1
        if tag is None:
            if page.startswith("--", start + 2):
                closed = page.find("-->", end)
                at = closed + 3 if closed >= 0 else len(page)
            elif end <= last_gt:
                at = page.index(">", end) + 1
            else:
                continue
            at = max(at, (yield start, at, False, "", "") or 0)
            continue
        if end > last_gt:
            continue
        if special < end:
            special = _SPECIAL.search(page, end).start()  # there is one, at the latest the last ">"
        place, quotes = special, []
        while place >= 0 and page[place] != ">":
            if place in dead:
                place = -1
                break
            quotes.append(place)
            closed = page.find(page[place], place + 1)
            following = _SPECIAL.search(page, closed + 1) if closed >= 0 else None
            place = following.start() if following else -1
        if place < 0:
            dead.update(quotes)
            continue
        at = place + 1
        at = max(at, (yield start, at, bool(found.group(1)), tag.lower(), page[end:place]) or 0)


def _names(attributes: str) -> list[str]:
    return " ".join(" ".join(g for g in m.groups()[1:] if g) for m in _NAMED.finditer(attributes)).split()


def _is_boilerplate(tag: str, attributes: str, in_content: bool) -> bool:
    if tag in LEFT_OUT or tag == "header" and not in_content:
        return True
    if tag in ("main", "html", "body") or tag in INLINE and tag != "span":
        return False
    if not attributes:
        return False
    return any(map(_BOILERPLATE.fullmatch, _names(attributes))) or bool(_HIDDEN.search(attributes))


def _ends(page: str) -> dict[str, int]:
    """Where the last end tag of each element starts."""
    return {m.group(1).lower(): m.start() for m in _ENDS.finditer(page)}


def _after_raw(page: str, tag: str, at: int, ends: dict[str, int]) -> int:
    """Where the end tag of an element of bare text ends, or -1."""
    if ends.get(tag, -1) < at:
        return -1
    return re.compile(rf"</{tag}\s*>", re.I).search(page, at).end()


def _holders(page: str, ends: dict[str, int]) -> set[int]:
    """Where elements start that hold every article and main element of the page."""
    if not _ANY_CONTENT.search(page):
        return set()
    stack, opened, seen, held = _Open(), [], 0, {}
    tokens, to = _tokens(page), None
    while True:
        try:
            first, last, closing, tag, attributes = tokens.send(to)
        except StopIteration:
            break
        to = None
        if not tag or tag in VOID or tag in INLINE and tag != "span":
            continue
        if tag in RAW:
            if not closing:
                end = _after_raw(page, tag, last, ends)
                to = end if end >= 0 else len(page)
            continue
        keep = stack.after_end(tag) if closing else stack.after_start(tag)
        for start, before in opened[keep:]:
            held[start] = seen - before
        stack.cut(keep)
        del opened[keep:]
        if not closing and not attributes.endswith("/"):
            stack.push(tag)
            opened.append((first, seen))
            seen += tag in CONTENT
    for start, before in opened:
        held[start] = seen - before
    return {start for start, n in held.items() if n == seen > 0}


class _Page:
    """Lines of a page, and the elements that hold them, numbered as they start."""

    def __init__(self, page: str) -> None:
        self.up, self.tag, self.until = [-1], ["html"], [-1]  # of each element; number 0 is the page
        self.lines = self._read(page)
        self.until = [len(self.up) if u < 0 else u for u in self.until]

    def _read(self, page: str) -> list[tuple[str, int, int, int]]:
        """(text, characters in links, content element or 0, element) of every line, "" where text is left out."""
        lines, content, inside = [_Line(0)], 0, []
        skipped, gap, links, at, size = "", 0, 0, 0, len(page)
        ends = _ends(page)
        stack, base, holders = _Open(), 0, _holders(page, ends)  # open elements; those before the one left out
        nodes = [0]  # the page, then the numbers of the open elements
        up, tags, until = self.up, self.tag, self.until

        def text_to(end: int) -> None:
            if end > at and not skipped:
                piece, line = page[at:end], lines[-1]
                n = len(piece.strip())
                if n and not (line.links or line.plain):
                    line.node = nodes[-1]
                line.parts.append(piece)
                if links:
                    line.links += n
                else:
                    line.plain += n

        def new_line(empty: int = 0) -> None:
            """Start a line, after empty ones; a line without text so far is gone on with."""
            for _ in range(empty or bool(lines[-1].links or lines[-1].plain)):
                lines.append(_Line(inside[-1][1] if inside else 0))

        def open_element(tag: str) -> None:
            stack.push(tag)
            up.append(nodes[-1])
            tags.append(tag)
            until.append(-1)
            nodes.append(len(up) - 1)

        def cut(keep: int) -> None:
            stack.cut(keep)
            for node in nodes[keep + 1 :]:
                until[node] = len(up)
            del nodes[keep + 1 :]

        tokens, to = _tokens(page), None
        while True:
            try:
                first, last, closing, tag, attributes = tokens.send(to)
            except StopIteration:
                break
            to = None
            text_to(first)
            at = last
            if not tag:
                continue
            own = tag not in VOID and tag not in RAW and (tag not in INLINE or tag == "span")
            if own:
                keep = stack.after_end(tag) if closing else stack.after_start(tag)
                ended = skipped and keep <= base
                consumed = ended and closing and tag == skipped and keep == base
                cut(keep)
                if ended:
                    skipped = ""
                    new_line(gap)
                if consumed:
                    continue
            if skipped:
                if tag in CONTENT and skipped not in CONTENT and not closing and ends.get(skipped, -1) < at:
                    skipped = ""  # an element that is never closed ends where the article begins
                    new_line(GAP)
                else:
                    if own and not closing and not attributes.endswith("/"):
                        open_element(tag)
                    elif tag in RAW and not closing and (end := _after_raw(page, tag, at, ends)) >= 0:
                        to = at = end
                    continue
            if tag in RAW and not closing:
                end = _after_raw(page, tag, at, ends)
                to = at = end if end >= 0 else size
                if tag not in ("script", "style"):
                    new_line(1)
                continue
            if tag == "a":
                links = 0 if closing else 1
            opens = not closing and not attributes.endswith("/")
            if opens and tag not in VOID and first not in holders and _is_boilerplate(tag, attributes, bool(inside)):
                skipped, base = tag, len(stack.tags)
                open_element(tag)
                gap = 1 if tag in _WITHIN_TAGS or _WITHIN.search(attributes) else GAP
                continue
            if own and opens:
                open_element(tag)
            if tag in CONTENT:
                new_line()
                if closing:
                    while inside and inside.pop()[0] != tag:
                        pass
                else:
                    content += 1
                    inside.append((tag, inside[0][1] if inside else content))
                lines[-1].inside = inside[-1][1] if inside else 0
            elif tag not in INLINE:
                new_line()
        text_to(size)
        out = []
        for x in lines:
            text = " ".join(html.unescape("".join(x.parts)).split())
            out.append((text, min(x.links, len(text) - 1) if x.plain else len(text), x.inside, x.node))
        return out

    def holds(self, node: int, other: int) -> bool:
        return node <= other < self.until[node]

    def parent_of(self, first: int, last: int) -> int:
        """The element that holds the lines from one in ``first`` to one in ``last``, other than a block of text."""
        node = first
        while not self.holds(node, last):
            node = self.up[node]
        while node and (self.tag[node] in _LEAVES or node == first == last):
            node = self.up[node]
        return node


def surges(lengths: np.ndarray, window: int = WINDOW) -> list[tuple[int, int]]:
    """(first, last + 1) of the lines between each surge and its dive."""
    if not lengths.any():
        return []
    padded = np.concatenate((np.zeros(window, np.int64), np.cumsum(lengths), np.full(window, lengths.sum())))
    sums = padded[window:] - padded[:-window]  # of the window that ends at each line, and beyond
    on = np.concatenate(([0], (sums > 0).astype(np.int8), [0]))
    edges = np.flatnonzero(np.diff(on))
    out = []
    for first, end in zip(edges[::2], edges[1::2]):
        full = np.flatnonzero(lengths[first:end])
        out.append((first + full[0], first + full[-1] + 1))
    return out


def menus(linked: np.ndarray, full: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Which lines are of a menu: in a window of successive lines with text that are all linked.

    Empty lines between do not count, so a list of links is one however its items are marked up.
    """
    rows = np.flatnonzero(full)
    runs = np.concatenate(([0], linked[rows].astype(np.int64), [0]))
    edges = np.flatnonzero(np.diff(runs))
    out = np.zeros(len(full), bool)
    for first, end in zip(edges[::2], edges[1::2]):
        if end - first >= window:
            out[rows[first:end]] = True
    return out


def main_text(page: str | None) -> str:
    """The main text of a page, one line a block; "" for null, empty pages and pages without.

    Lines inside articles stay, but for menus of ``WINDOW`` or more links; a link of its own stays.
    """
    read = _Page(page or "")
    lines = read.lines
    length = np.array([len(t) for t, *_ in lines], np.int64)
    links = np.array([n for _, n, *_ in lines], np.int64)
    inside = np.array([i for _, _, i, _ in lines], np.int64) > 0
    if length[inside].any():
        length = np.where(inside, length, 0)
        length[menus(links >= length, length > 0)] = 0
        chosen = surges(length)
    else:
        linked = links > LINK_SHARE * length
        length[menus(linked, length > 0)] = 0
        bare = np.where(linked, 0, length)
        found = surges(bare)
        sums = [int(bare[a:b].sum()) for a, b in found]
        chosen = []
        if found:
            a, b = found[int(np.argmax(sums))]
            parent = read.parent_of(lines[a][3], lines[b - 1][3])
            chosen = [
                (a, b) for (a, b), s in zip(found, sums) if s >= JOINS * max(sums) or read.holds(parent, lines[a][3]) and read.holds(parent, lines[b - 1][3])
            ]
    return "\n".join(lines[i][0] for a, b in chosen for i in range(a, b) if length[i])


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """The columns ``id_col`` and ``keep``, then ``main__``: the main text of every row's page.

    Null and empty pages, and pages without text, have an empty text. Very long and broken pages take time
    in proportion to their length. Repeated rows each return a row; other columns are not read. An empty table gives none.
    """

    def work():
        return lambda texts: [pa.array([main_text(t) for t in texts], pa.string())]

    return map_texts(pages, [id_col, *keep], html_col, "main__ string", work)
