"""Main text of web pages: markup first, then differencing against the page with the nearest URL.

A page is cut into lines, one per block of its markup. Lines in menus, headers, footers, sidebars,
notices, adverts, forms, scripts and comments, as their elements, roles and class names tell, are no text. Inside an
article only names that can mean nothing else count; headings are never judged by their names there.
If the page has an article (or main) element, only lines inside it can be text. What markup does not
tell is found by comparison: pages are sorted by URL path within their host, each page's lines are
aligned with those of its neighbour by longest common subsequence, and shared lines are deleted, unless the pages share
most of their text, which makes them copies and not pages of one template. Inside an article, where a
sentence or a licence note of the author's may well occur on the near page too, only the lines go with which the articles of the page and of
both its neighbours begin or end, if they stand in elements of their own: bylines, share bars and author boxes.

Pages are dealt out in ranges of (host, path, url, id), a fixed number of them for each shuffle partition and all of about the same
number of pages, so that a host with a third of all pages is spread over many tasks. The last page of a range and the first of the next are
sent to both, so that every page meets its nearest neighbours wherever a range ends. A task reads its pages in
order and holds three at a time. The html is shuffled once.
"""

import html
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeromart.llm.words import blocks

#: So many ranges for each shuffle partition, for even tasks. Their bounds are all that the driver holds.
RANGES = 3
#: Pages that share so much of what the markup leaves are copies.
COPY_SHARE = 0.7

#: Names of HTML elements by their part in the layout.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BREAKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody tfoot thead tr ul".split()
)
NO_TEXT = frozenset(
    "annotation annotation-xml applet audio aside button canvas datalist dialog embed footer form frame frameset head iframe input label map menu meter nav noscript "
    "object option picture progress script search select style svg template textarea title video".split()
)
RAW = "script|style|textarea|title|noscript|iframe|template|svg"
#: Words in class names, ids and roles that mark what is not the text.
MARKS = frozenset(
    "ad ads adsbygoogle advert adverts advertisement advertising adbox adslot alert alertdialog banner breadcrumb breadcrumbs comment comments commentlist complementary consent contentinfo "
    "cookie cookies dialog disqus discussion donate footer footnav gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice notices notification overlay "
    "pager pagination paywall popup popover promo promoted promotion promotions recommended recommendations register related replies reply respond search share sharing "
    "shares sidebar signin signup skip social sponsor sponsored sponsors subscribe subscription tagcloud teaser toolbar topbar widget widgets".split()
)
COMMENT_MARKS = frozenset("ad advert advertisement comment comments promo related replies reply sponsored teaser".split())
#: Inside an article a class, or the id of a plain box, counts only as a whole and only if it can mean nothing else.
ARTICLE_MARKS = frozenset(
    "ad ads adsbygoogle advert adverts advertisement advertising adbox adslot ad-slot ad-container ad-banner breadcrumb breadcrumbs comment comments commentlist comment-list "
    "comments-area comments-section comment-respond cookie-banner cookie-notice disqus disqus_thread newsletter newsletter-signup newsletter-form pager pagination paywall promo "
    "related-articles related-posts share shares sharing share-bar share-buttons share-links sharedaddy sidebar social-links social-share sponsored subscribe-form".split()
)
ARTICLE_ROLES = frozenset("alertdialog banner complementary contentinfo dialog menu menubar navigation search toolbar".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?/][^>]*>|([^<]+|<)",
    re.S | re.I,
)
_NAMED = re.compile(r"""(?:^|[\s"'])(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)


@dataclass
class _Open:
    tag: str
    drop: bool
    article: bool
    path: str = ""


@dataclass
class Page:
    """Lines of a page: `texts`, whether each is content by its markup and inside an article, and the block elements it is in."""

    texts: list[str] = field(default_factory=list)
    content: list[bool] = field(default_factory=list)
    article: list[bool] = field(default_factory=list)
    paths: list[str] = field(default_factory=list)

    def inside(self) -> list[tuple[str, str]]:
        """(text, elements) of the lines of the article."""
        return [(t, p) for t, p, c, a in zip(self.texts, self.paths, self.content, self.article, strict=True) if c and a]


def _dropped(tag: str, attributes: str, in_article: bool) -> bool:
    """Is the element no text, by its name or by what its attributes say?"""
    if tag in NO_TEXT or (tag == "header" and not in_article):
        return True
    if not attributes or tag in ("html", "body"):
        return False
    marks = COMMENT_MARKS if tag in ("article", "main") else MARKS
    for name, value in _NAMED.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none", value)):
            return True
        if tag in HEADINGS and name == "id":
            continue
        if in_article and tag not in ("article", "main"):
            known = {"role": ARTICLE_ROLES, "class": ARTICLE_MARKS, "id": ARTICLE_MARKS if tag == "div" else frozenset()}.get(name, frozenset())
            if tag not in HEADINGS and not known.isdisjoint(value.split()):
                return True
        elif name in ("class", "id", "role"):
            for one in value.split():
                parts = [p for p in re.split(r"[^a-z]+", one) if p]
                if parts and parts[0] not in ("has", "no", "with", "without", "is") and (parts[0] in marks or parts[-1] in marks):
                    return True
    return False


def lines_of(markup: str) -> Page:
    """The lines of a page. Unclosed and misplaced tags are taken as browsers do for paragraphs and list items."""
    page, stack, held = Page(), [_Open("", False, False)], []

    def close() -> None:
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if text:
                page.texts.append(text)
                page.content.append(not stack[-1].drop)
                page.article.append(stack[-1].article)
                page.paths.append(stack[-1].path)

    for found in _TOKEN.finditer(markup):
        raw, slash, tag, attributes, text = found.groups()
        if text is not None:
            held.append(text)
        elif tag is not None:
            tag = tag.lower()
            if tag in ("br", "td", "th", "img", "wbr") and tag != "wbr":
                held.append(" ")
            if slash:
                at = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag), 0)
                if at:
                    if tag in BREAKS or stack[-1].drop != stack[at - 1].drop:
                        close()
                    del stack[at:]
                elif tag in BREAKS:
                    close()
                continue
            if tag in BREAKS:
                close()
                # A paragraph ends where a block begins, a list item where the next one does.
                for ended in ("p",) if tag not in ("li", "dt", "dd", "tr") else ("p", tag):
                    at = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == ended or stack[k].tag in ("ul", "ol", "dl", "table", "div", "section", "article", "main", "body", "blockquote")), 0)
                    if at and stack[at].tag == ended:
                        del stack[at:]
            if tag in VOID or attributes.rstrip().endswith("/"):
                continue
            top = stack[-1]
            drop = top.drop or _dropped(tag, attributes, top.article)
            if drop != top.drop:
                close()
            path = f"{top.path}/{tag}" if tag in BREAKS else top.path
            stack.append(_Open(tag, drop, top.article or (not drop and (tag in ("article", "main") or bool(re.search(r"""role\s*=\s*["']?main\b""", attributes, re.I)))), path))
        elif raw is not None and raw.lower() not in ("svg",):
            held.append("")
    close()
    return page


def common_lines(own: list[str], other: list[str]) -> set[int]:
    """Places in `own` of a longest common subsequence with `other`: one row of bits per line."""
    low = 0
    while low < min(len(own), len(other)) and own[low] == other[low]:
        low += 1
    a, b = len(own), len(other)
    while a > low and b > low and own[a - 1] == other[b - 1]:
        a, b = a - 1, b - 1
    found = {*range(low), *range(a, len(own))}
    places: dict[str, int] = {}
    for j in range(low, b):
        places[other[j]] = places.get(other[j], 0) | 1 << (j - low)
    every = (1 << (b - low)) - 1
    bits, rows = every, []
    for i in range(low, a):
        met = bits & places.get(own[i], 0)
        bits = ((bits + met) | (bits - met)) & every
        rows.append(bits)
    i, j = a - low, b - low
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
            continue
        i -= 1
        if i and not rows[i - 1] >> (j - 1) & 1:
            continue
        found.add(low + i)
        j -= 1
    return found


def article_lines(own: list[tuple[str, str]], others: list[list[tuple[str, str]]]) -> list[tuple[str, str]]:
    """The lines of an article without those with which it and two others begin or end alike, and which its markup sets apart.

    Set apart is what stands in other elements than the lines between, and is no heading: a first sentence that three
    pages share is text. If the shared lines make up most of the article, or all of another, the pages are copies, and nothing goes.
    """
    if len(others) < 2:
        return own
    shortest = min(map(len, [own, *others]))
    head = next((k for k in range(shortest) if any(x[k] != own[k] for x in others)), shortest)
    tail = next((k for k in range(shortest - head) if any(x[-1 - k] != own[-1 - k] for x in others)), shortest - head)
    between = own[head : len(own) - tail]
    whole = sum(len(t) for t, _ in own)
    if head + tail == shortest or whole - sum(len(t) for t, _ in between) >= COPY_SHARE * whole:
        return own
    usual = {p for _, p in between}

    def stays(line: tuple[str, str]) -> bool:
        return line[1] in usual or line[1].rpartition("/")[2] in HEADINGS

    return [*filter(stays, own[:head]), *between, *filter(stays, own[len(own) - tail :])]


def main_text(page: Page, *found: Page | None) -> str:
    """The lines that are text, joined by an empty line. The nearest neighbour comes first; of a copy the next one is asked."""
    neighbours = [x for x in found if x]
    if inside := page.inside():
        return "\n\n".join(t for t, _ in article_lines(inside, [x.inside() for x in neighbours]))
    kept = [i for i, c in enumerate(page.content) if c]
    for other in neighbours:
        shared = common_lines(page.texts, other.texts)
        if sum(len(page.texts[i]) for i in kept if i in shared) < COPY_SHARE * sum(len(page.texts[i]) for i in kept):
            return "\n\n".join(page.texts[i] for i in kept if i not in shared)
    return "\n\n".join(page.texts[i] for i in kept)


def _ranges(keys: DataFrame, parts: int) -> tuple[list[str], list[str]]:
    """(bounds, last): ascending first keys of all ranges but the lowest, and the last key of each range. Their number does not grow with the pages."""
    n = keys.count()
    # An even sample by hash tells where ranges begin; the result does not depend on it.
    every = max(1, n // (16 * parts))
    drawn = sorted(r[0] for r in keys.where(F.pmod(F.xxhash64("key"), F.lit(every)) == 0).distinct().collect())
    bounds = [drawn[k * len(drawn) // parts] for k in range(1, parts)] if drawn else []
    bounds = sorted(set(bounds))
    found = dict(keys.groupBy(_range_of(F.col("key"), bounds).alias("part")).agg(F.max("key")).collect())
    return bounds, [found.get(k, "") for k in range(len(bounds) + 1)]


def _listed(keys: list[str]) -> Column:
    """An array literal; keys have no line ends."""
    return F.split(F.lit("\n".join(keys)), "\n")


def _range_of(key: Column, bounds: list[str]) -> Column:
    """How many bounds are at or below the key, found in two steps."""
    if not bounds:
        return F.lit(0)
    wide = int(len(bounds) ** 0.5) + 1
    block = F.size(F.filter(_listed(bounds[::wide]), lambda b: b <= key))
    low = (F.greatest(block, F.lit(1)) - 1) * wide
    return low + F.size(F.filter(F.slice(_listed(bounds), low + 1, wide), lambda b: b <= key))


def extract_text(pages: DataFrame, ranges: int | None = None) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of `pages`.

    Null or empty html gives an empty text. A page that is alone on its host is judged by its markup
    alone. The first and the last page of a host have one neighbour, so their articles stay whole. Rows that repeat are
    neighbours of each other and, being copies, lose nothing. Null urls and ids are allowed. The result does not
    depend on the number of `ranges`. Other columns are not read.
    """
    ranges = ranges or RANGES * int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    url = F.coalesce("url", F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^#]*)", 1)
    stem = F.regexp_replace(F.regexp_replace(path, r"\?.*$", ""), r"(/|\.[A-Za-z]{2,5})$", "")
    # Line ends in urls would break the lists of keys; the first character sorts below all others.
    key = F.translate(F.concat_ws("\u0001", host, stem, url, F.coalesce(F.col("page_id").cast("string"), F.lit(""))), "\r\n", "  ")
    bounds, last = _ranges(pages.select(key.alias("key")), ranges)
    part = _range_of(F.col("key"), bounds)
    first = F.col("key") == F.get(_listed(["", *bounds]), F.col("part"))
    ends = F.col("key") == F.get(_listed(last), F.col("part"))
    placed = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"), stem.alias("stem"), key.alias("key")).withColumn("part", part)
    goes = F.array_compact(F.array("part", F.when(first & (F.col("part") > 0), F.col("part") - 1), F.when(ends & (F.col("part") < len(bounds)), F.col("part") + 1)))
    dealt = placed.withColumn("goes", F.explode(goes)).withColumn("own", F.col("goes") == F.col("part"))
    ordered = dealt.repartition("goes").sortWithinPartitions("goes", "key", F.xxhash64("html"))
    return ordered.select("page_id", "url", "html", "host", "stem", F.col("goes").alias("part"), "own").mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")


def _alike(a: str, b: str) -> int:
    """The length of the common beginning."""
    return len(os.path.commonprefix([a, b]))


def _extracted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def told() -> pa.RecordBatch:
        ids, urls, texts = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"]
        )

    def judge(before: tuple | None, row: tuple, after: tuple | None) -> None:
        (key, own, stem, page_id, url, page) = row
        if own:
            near = [x for x in (before, after) if x and x[0] == key]
            near.sort(key=lambda x: -_alike(x[2], stem))
            out.append((page_id, url, main_text(page, *(x[-1] for x in near))))

    out: list[tuple] = []
    waiting = before = None  # ((part, host), own, stem, id, url, page); the page before it
    for block in blocks(batches, "html"):
        for row in block.to_pylist():
            now = ((row["part"], row["host"]), row["own"], row["stem"], row["page_id"], row["url"], lines_of(row["html"]))
            if waiting:
                judge(before, waiting, now)
            before, waiting = waiting, now
        if out:
            yield told()
            out.clear()
    if waiting:
        judge(before, waiting, None)
    if out:
        yield told()
