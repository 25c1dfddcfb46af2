"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block element. Elements that are no article text by their
kind (scripts, menus, page headers and footers, sidebars, forms, ...) or by what their class, id
or role says (adverts, cookie notices, reader comments, ...) give no lines and do not part the
lines around them. A line's weight is its text outside links if that is the larger part, else
nothing. Weights are summed over windows of ``WINDOW`` lines: a stretch of lines starts to surge
where the sum rises from zero and dives where it is zero again, and is kept if the sum reaches
``SURGE`` in between. A page where nothing surges keeps its heaviest stretch.

What the page tells of its structure adjusts the stretches that are kept: weak lines that stand in
the same container join them, windows end at the bounds of article elements, and a stretch in an
article grows to its bounds. A page's only article is kept if it has any text.
"""

import re
from bisect import bisect_left, bisect_right
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulecast.llm.common import ship, small_batches

WINDOW, SURGE = 3, 80

RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object", "xmp"}
DROPPED = {"head", "nav", "aside", "footer", "form", "select", "button", "dialog", "menu", "canvas", "audio", "video"} | RAW
ARTICLE = {"article", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "legend", "li",
    "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
HINTS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
    "complementary", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "gdpr", "login", "menu", "modal", "nav",
    "navbar", "navigation", "newsletter", "notice", "notices", "overlay", "pagination", "pager", "popup", "promo", "promotion",
    "related", "respond", "search", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar", "topbar",
    "widget", "widgets", "masthead", "replies",
}
#: What a hint may be joined to in one token ("cookie-bar", "share-buttons"); with other words it says nothing.
COMPANIONS = {
    "area", "bar", "block", "bottom", "box", "button", "buttons", "container", "dfp", "div", "google", "gpt", "header", "icons", "inner",
    "item", "items", "left", "links", "list", "main", "outer", "page", "post", "posts", "primary", "right", "secondary", "section", "site",
    "slot", "stories", "thread", "top", "unit", "wrap", "wrapper",
}
COMMENTS = {"comment", "comments", "disqus", "replies", "respond"}
ADS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "cookie", "cookies", "consent", "gdpr", "sponsor", "sponsored"}
#: Hints on article elements only, and what they may be joined to there.
CARDS, CARD_COMPANIONS = {"card", "cards", "teaser", "teasers", "tile"}, {"article", "blog", "body", "entry", "news", "story"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_HINTED = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")


def _tokens(html: str):
    """(kind, name, value): text pieces and tags, in order; each character is looked at a few times."""
    at, n = 0, len(html)
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            yield "text", "", html[at:lt]
        if lt == n:
            return
        if html.startswith("<!--", lt):
            end = html.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        closing = html.startswith("</", lt)
        name = _NAME.match(html, lt + 1 + closing)
        if not name:
            if html.startswith(("<!", "<?", "</"), lt):
                end = html.find(">", lt)
                at = n if end < 0 else end + 1
            else:
                yield "text", "", "<"
                at = lt + 1
            continue
        end = html.find(">", name.end())
        end = n if end < 0 else end
        for quote in ('"', "'"):  # a ">" inside a quoted value
            if html.count("=" + quote, name.end(), end) and html.count(quote, name.end(), end) % 2:
                shut = html.find(quote, end)
                more = html.find(">", shut) if shut >= 0 else -1
                end = more if more >= 0 else end
                break
        tag, inside = name[0].lower(), html[name.end() : end]
        at = min(end + 1, n)
        if closing:
            yield "close", tag, ""
        elif tag in RAW and not inside.endswith("/"):
            shut = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            yield "raw", tag, ""
            if shut:
                at = shut.end()
        else:
            yield ("void" if tag in VOID or inside.endswith("/") else "open"), tag, inside


def _slug(text: str) -> list[str]:
    return _WORD.findall(unescape(text).lower())


def _heading_id(tokens: list, i: int, name: str) -> bool:
    """Whether ``name`` is the id of a heading, or made from the one its element begins with."""
    said = None
    for kind, tag, value in tokens[i : i + 12]:
        if kind == "open" and tag in HEADINGS:
            said = []
        elif kind == "close" and tag in HEADINGS:
            break
        elif kind == "text" and said is not None:
            said.append(value)
        elif kind == "text" and value.strip():
            return False
    return tokens[i][1] in HEADINGS or (said is not None and _slug("".join(said)) == _slug(name))


def _hints(tokens: list, i: int) -> set[str]:
    """The hints that whole tokens of an element's class, id and role are made of."""
    _, tag, inside = tokens[i]
    names, beside = (HINTS | CARDS, COMPANIONS | CARD_COMPANIONS) if tag == "article" else (HINTS, COMPANIONS)
    found: set[str] = set()
    for value in _HINTED.finditer(inside):
        for token in (value[2] or value[3] or value[4] or "").lower().split():
            words = [w for w in _WORD.findall(token) if len(w) > 1]
            hints = {w for w in words if w in names}
            if not hints or any(w not in names and w not in beside for w in words):
                continue
            if value[1].lower() == "id" and (tag in HEADINGS or not hints & COMMENTS) and _heading_id(tokens, i, token):
                continue
            found |= hints
    return found


def _elements(tokens: list) -> tuple[set[int], list[int], dict[int, int]]:
    """Token numbers at which dropped and outermost article elements open, and where each element closes.

    An element that never closes is none: an unclosed menu must not swallow the page. A form and
    what only a hint tells against are not dropped if they hold most of the page's text outside
    links; reader comments only if no article and hardly any text, adverts and notices of cookies
    only if no text at all stands beside them. What holds all articles of the page is not dropped
    either, unless it is named after comments or related.
    """
    open_at: dict[str, list[int]] = {}
    ends: dict[int, int] = {}
    for i, (kind, tag, _) in enumerate(tokens):
        if kind == "open":
            open_at.setdefault(tag, []).append(i)
        elif kind == "close" and open_at.get(tag):
            ends[open_at[tag].pop()] = i
    if not any(tokens[i][1] in ARTICLE for i in ends) and open_at.get("article"):  # cut off before its end
        ends[open_at["article"][0]] = len(tokens)
    hints = {i: found for i in ends if (found := _hints(tokens, i))}
    before, until, in_link = [0], -1, 0
    for i, (kind, tag, value) in enumerate(tokens):
        if i in ends and tag in DROPPED and tag != "form":
            until = max(until, ends[i])
        if tag == "a":
            in_link = max(0, in_link + (1 if kind == "open" else -1))
        before.append(before[-1] + (len(" ".join(value.split())) if kind == "text" and not in_link and i > until else 0))

    def most(i: int) -> bool:
        held = before[min(ends[i] + 1, len(tokens))] - before[i]
        said = hints.get(i, set())
        if said & ADS:
            return held == before[-1]
        if said & COMMENTS:
            beside = any(tokens[k][1] in ARTICLE and k not in hints and not (k < i < ends[k] or i < k < ends[i]) for k in ends)
            return before[-1] - held < SURGE and not beside
        return 2 * held > before[-1]

    articles = sorted(i for i in ends if tokens[i][1] in ARTICLE and (tokens[i][1] == "main" or i not in hints or most(i)))
    outer: list[int] = []
    for i in articles:
        if not outer or i > ends[outer[-1]]:
            outer.append(i)
    dropped = set()
    for i in ends:
        tag, said = tokens[i][1], hints.get(i, set())
        if tag in ("html", "body", "main") or i in articles:
            continue
        place = bisect_left(outer, i) - 1
        by_tag = tag in DROPPED or (tag == "header" and not (place >= 0 and i < ends[outer[place]]))
        if not by_tag and not said:
            continue
        held = bisect_left(articles, ends[i]) - bisect_right(articles, i)
        shields = bool(articles) and held == len(articles) and not said & (COMMENTS | {"related"})
        if not shields and ((by_tag and tag != "form") or not most(i)):
            dropped.add(i)
    return dropped, outer, ends


class Line:
    """A line's text and weight, the token that ended it, and the elements it stands in; -1 is the page."""

    __slots__ = ("text", "weight", "at", "block", "article")

    def __init__(self, text: str, weight: int, at: int, block: int, article: int):
        self.text, self.weight, self.at, self.block, self.article = text, weight, at, block, article


def lines_of(html: str) -> tuple[list[Line], dict[int, int]]:
    """The lines of a page, without dropped elements, and where each of their containers closes.

    ``block`` becomes the container of a line: the element around its paragraph, or the one whose
    text it is if that holds paragraphs as well.
    """
    tokens = list(_tokens(html))
    dropped, articles, ends = _elements(tokens)
    first = set(articles)
    lines: list[Line] = []
    said: list[str] = []
    linked, in_link, article = 0, 0, -1
    stack: list[int] = []
    above: dict[int, int] = {}
    parents: set[int] = set()

    def end_line():
        nonlocal linked
        text = " ".join(unescape("".join(said)).split())
        if text:
            plain = len(text) - min(linked, len(text))
            lines.append(Line(text, len(text) if 2 * plain >= len(text) else 0, i, stack[-1] if stack else -1, article))
        said.clear()
        linked = 0

    i = 0
    while i < len(tokens):
        kind, tag, value = tokens[i]
        if kind == "text":
            said.append(value)
            if in_link:
                linked += len(value)
        elif i in dropped:
            if tag in BLOCKS or tag in DROPPED:
                end_line()
            i = ends[i] + 1
            continue
        elif tag == "a":
            in_link = max(0, in_link + (1 if kind == "open" else -1))
        elif tag == "br":
            said.append(" ")
        elif tag in BLOCKS:
            end_line()
            while stack and ends[stack[-1]] <= i:
                stack.pop()
            if article >= 0 and ends[article] <= i:
                article = -1
            if kind == "open":
                if stack:
                    parents.add(stack[-1])
                if i in first:
                    article = i
                if i in ends and tag not in ("html", "body"):
                    above[i] = stack[-1] if stack else -1
                    stack.append(i)
        i += 1
    end_line()
    for line in lines:
        if line.block >= 0 and line.block not in parents and tokens[line.block][1] not in ARTICLE:
            line.block = above[line.block]
    return lines, ends


def main_text(html: str | None) -> str:
    lines, ends = lines_of(html or "")
    stretches: list[tuple[int, int]] = []
    edges = [0, *(k for k in range(1, len(lines)) if lines[k].article != lines[k - 1].article), len(lines)]
    sums: list[int] = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        start = None
        for i in range(a, b):
            sums.append(sum(line.weight for line in lines[i : min(i + WINDOW, b)]))
            if not sums[i]:
                if start is not None:
                    stretches.append((start, i))
                start = None
            elif start is None and lines[i].weight:
                start = i
        if start is not None:
            stretches.append((start, b))
    heavy = lambda s: sum(line.weight for line in lines[s[0] : s[1]])
    articles = {line.article for line in lines if line.article >= 0}
    kept = [(a, b) for a, b in stretches if max(sums[a:b]) >= SURGE]
    kept = kept or sorted(stretches, key=lambda s: (lines[s[0]].article < 0, -heavy(s)))[:1]
    keep = [False] * len(lines)
    for a, b in kept:
        keep[a:b] = [True] * (b - a)
    whole = articles if len(articles) == 1 or not stretches else {lines[a].article for a, _ in kept} - {-1}
    containers = {line.block for line, k in zip(lines, keep, strict=True) if k}
    closed: list[tuple[int, int]] = []
    for c in sorted(containers - {-1}):
        if not closed or c > closed[-1][1]:
            closed.append((c, ends[c]))
    starts = [c for c, _ in closed]

    def joins(line: Line) -> bool:
        """Whether a line that has weight stands in a container of kept lines."""
        place = bisect_left(starts, line.at) - 1
        return bool(line.weight) and (line.block in containers or (place >= 0 and line.at <= closed[place][1]))

    return "\n\n".join(line.text for line, k in zip(lines, keep, strict=True) if k or line.article in whole or joins(line))


def extract_main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page, rows as they come, repeated ones included.

    A null or empty page, or one without text, has the empty text. ``n_chars`` counts code points.
    Other columns are ignored; no rows give no rows. Nothing is cut off, however long a page is.
    """
    spark = pages.sparkSession
    ship(spark)
    small_batches(spark)

    def extract(batches):
        for batch in batches:
            found = [main_text(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    columns = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    kinds = dict(columns.dtypes)
    return columns.mapInArrow(extract, f"page_id {kinds['page_id']}, url string, text string, n_chars bigint")
