"""Main text of web pages by consensus paths of their hosts.

1. Each page is parsed into blocks of text, each with the path of containers around it. A path
   step is the tag and its class, generalised: digits become 0 and only the first class counts.
2. Per page each container is scored by the text that it holds (long blocks with sentence marks
   count, links count against it), and the page's best path gets a vote.
3. Spark sums the votes per host and path. A host's winning path is the one with the most votes;
   hosts with few pages follow the vote over all hosts, which is kept as well.
4. Each page is read again with its host's winner; where that path is absent or empty on the page,
   with the overall winner, then with the page's own best container.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are
left out wherever they lie, by element, role and class or id words. Such a word counts as a whole name
or as the last part of one (``site-header``, not ``has-header`` or ``search-results``), and a container
of most of the page's text is not left out for the last part of a name, nor if it holds the headline.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.llm.common import column_or, materialise, ready, table
from cardlens.llm.url_filter import split_url

# Elements of HTML by their part in the layout.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROP = frozenset("script style noscript template head title nav header footer aside form button select textarea "
                 "iframe object svg canvas audio video dialog menu datalist option".split())
RAW = frozenset(("script", "style", "textarea", "title"))
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset "
                  "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre "
                  "section summary table tbody td tfoot th thead tr ul".split())
CONTAINERS = frozenset("article main section div body td blockquote".split())
# Words in a class, id or role that mark what is no main text.
BOILER = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
                   "cookie cookies consent copyright disqus footer form gdpr header login masthead menu menubar modal "
                   "nav navbar navigation newsletter notice notices alert pager pagination popup promo promoted "
                   "related reply replies respond share sharing sidebar signup social sponsor sponsored subscribe "
                   "toolbar widget contentinfo complementary search".split())
# Parts of a name that say what an element lacks or only goes with, and those of a headline's own header.
APART = frozenset("has no non not with without".split())
HEADLINE = frozenset("article content entry hentry page post story title".split())
LAYOUT = frozenset("area bar box buttons icons items links list panel slot unit".split())  # nav-links is a nav
_CLOSES_P = BLOCK - {"html", "body"}
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
              "th": {"td", "th"}, "option": {"option"}}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"},
          "th": {"tr", "table"}, "option": {"select"}}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(?P<end>/?)(?P<tag>[A-Za-z][A-Za-z0-9:-]*)"
                    r"(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")
_PARTS = re.compile(r"[-_]+")


def _boiler(name: str) -> str | None:
    """Whether a class, id or role (lower case) marks no main text: as a whole, by its last part, or not at all."""
    parts = [p for p in (q.strip("0123456789") for q in _PARTS.split(name.split("--")[0])) if p.isalpha()]
    if len(parts) > 1 and parts[-1] in LAYOUT:
        parts.pop()
    if not parts or parts[-1] not in BOILER or not APART.isdisjoint(parts):
        return None
    if parts[-1] == "header" and not HEADLINE.isdisjoint(parts):
        return None
    return "whole" if BOILER.issuperset(parts) else "part"


def _marked(attrs: str, tag: str) -> tuple[str, bool, str | None]:
    """(path step, whether the element is hidden, how its class, id or role marks it as boilerplate)."""
    if not attrs or attrs.isspace():
        return tag, False, None
    step, hidden, marks = tag, False, set()
    for name, a, b, c in _ATTR.findall(attrs):
        name = name.lower()
        if name not in ("class", "id", "role", "hidden", "aria-hidden", "style"):
            continue
        value = (a or b or c).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" \
                or name == "style" and "display:none" in value.replace(" ", ""):
            hidden = True
        elif name in ("class", "id", "role"):
            names = value.split()
            if name == "class" and names:
                step = f"{tag}.{re.sub('[0-9]+', '0', names[0])}"
            if tag not in ("html", "body", "article", "main"):
                marks.update(map(_boiler, names))
    return step, hidden, "whole" if "whole" in marks else "part" if "part" in marks else None


def blocks(page: str | None):
    """(path, text, chars in links) of every block of text outside boilerplate, in page order.

    ``path`` is a tuple of the steps of the containers around the block.
    """
    if not page:
        return
    marks: list[list] = []
    found = list(_blocks(page, marks, frozenset()))
    if marks:
        most = (sum(len(text) for _, text, _ in found) + sum(m[2] for m in marks)) / 2
        spared = {m[0] for m in marks if m[1] > most and (m[3] == "part" or m[4] or not found)}
        if spared:
            found = list(_blocks(page, [], spared))
    yield from found


def _blocks(page: str, marks: list[list], spared):
    """The blocks of a page; elements that start at a position in ``spared`` are no boilerplate by their names.

    ``marks`` gets, for each element left out by its name alone: its position, the characters of text
    in it and in it alone (in no such element inside), the kind of mark, whether it holds h1 or main.
    """
    open_marks: list[tuple[int, list]] = []  # stack depth, mark
    stack: list[tuple[str, str, bool, bool]] = []  # tag, step, left out from here on, also but for names
    parts: list[str] = []
    links = linked = at = 0

    def flush():
        nonlocal parts, linked
        text = _SPACE.sub(" ", entities.unescape("".join(parts))).strip() if parts else ""
        count, parts, linked = linked, [], 0
        if text:
            return tuple(s for t, s, *_ in stack if t in CONTAINERS), text, count
        return None

    def close(depth):
        nonlocal links
        links -= sum(t == "a" for t, *_ in stack[depth:])
        del stack[depth:]
        while open_marks and open_marks[-1][0] >= depth:
            open_marks.pop()

    while True:
        m = _TOKEN.search(page, at)
        end = m.start() if m else len(page)
        if end > at and not (stack and stack[-1][2]):
            parts.append(page[at:end])
            linked += (end - at) * bool(links)
        elif end > at and open_marks and not stack[-1][3]:
            n = len(page[at:end].strip())
            open_marks[-1][1][2] += n
            for _, mark in open_marks:
                mark[1] += n
        if m is None:
            break
        at = m.end()
        tag = (m.group("tag") or "").lower()
        if not tag:
            continue
        if tag == "br":
            if not (stack and stack[-1][2]):
                parts.append(" ")
            continue
        if tag in BLOCK and (found := flush()):
            yield found
        if m.group("end"):
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    close(depth)
                    break
            continue
        if tag in VOID:
            continue
        # what the new element ends without an end tag
        if tag in _CLOSES_P:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == "p":
                    close(depth)
                    break
                if stack[depth][0] in BLOCK:
                    break
        for depth in range(len(stack) - 1, -1, -1) if tag in _CLOSED_BY else ():
            if stack[depth][0] in _CLOSED_BY[tag]:
                close(depth)
                break
            if stack[depth][0] in _SCOPE[tag]:
                break
        step, hidden, kind = _marked(m.group("attrs"), tag)
        inside = [t for t, *_ in stack]
        # an article's own header holds its headline; those of the page and its sections do not
        dropped = tag in DROP and not (tag == "header" and "article" in inside)
        if m.group("attrs").endswith("/") and tag not in BLOCK:
            continue
        if tag in RAW:
            # no markup inside: on to the end tag
            close_at = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = close_at.end() if close_at else len(page)
            continue
        nested = tag == "article" and "article" in inside  # an article within the article: a reader's comment
        hard = dropped or hidden or nested or bool(stack and stack[-1][3])
        named = bool(kind) and m.start() not in spared
        if tag in ("h1", "main") and not hard:
            for _, mark in open_marks:
                mark[4] = True
        if named and not hard:
            open_marks.append((len(stack), [m.start(), 0, 0, kind, False]))
            marks.append(open_marks[-1][1])
        stack.append((tag, step, hard or named or bool(stack and stack[-1][2]), hard))
        links += tag == "a"
    if found := flush():
        yield found


def best_path(found: list[tuple]) -> str | None:
    """The page's own choice: the container that holds most text for what it spends on links."""
    scores: dict[tuple, float] = {}
    for path, text, linked in found:
        worth = len(text) - 3 * linked + 25 * len(re.findall(r"[.!?](?:\s|$)", text))
        for depth in range(1, len(path) + 1):
            scores[path[:depth]] = scores.get(path[:depth], 0.0) + worth
    if not scores:
        return None
    kind = {"article": 1.6, "main": 1.3, "body": 0.9}

    def rank(path):
        tag = path[-1].split(".")[0]
        return scores[path] * kind.get(tag, 1.0), len(path), path
    return "/".join(max(scores, key=rank))


def text_at(found: list[tuple], path: str | None) -> str:
    """The blocks under ``path``, joined by line ends; without a path, all blocks."""
    steps = tuple(path.split("/")) if path else ()
    return "\n".join(text for at, text, _ in found if at[:len(steps)] == steps)


def extract(page: str | None, paths: tuple[str | None, ...] = ()) -> str:
    """Main text of one page: the first of ``paths`` that has text, else the page's own best container."""
    found = list(blocks(page))
    for path in paths:
        if path and (text := text_at(found, path)):
            return text
    return text_at(found, best_path(found)) if found else ""


#: Votes that a host needs before its own winner is taken.
MIN_VOTES = 3


def consensus(pages: DataFrame) -> DataFrame:
    """host, path: the winning path of every host, and under a NULL host that of all hosts."""
    host, _ = split_url(column_or(pages, "url", "string"))

    @F.arrow_udf("string")
    def vote(page: pa.Array) -> pa.Array:
        return pa.array([best_path(list(blocks(p))) for p in page.to_pylist()], pa.string())

    votes = materialise(
        pages.select(host.alias("host"), vote(column_or(pages, "html", "string")).alias("path"))
        .where("path IS NOT NULL").groupBy("host", "path").agg(F.count("*").alias("n")), "html-votes")
    first = F.max_by("path", F.struct("n", "path"))
    own = votes.groupBy("host").agg(first.alias("path"), F.sum("n").alias("n")).where(F.col("n") >= MIN_VOTES)
    overall = (votes.groupBy("path").agg(F.sum("n").alias("n")).agg(first.alias("path"))
               .select(F.lit(None).cast("string").alias("host"), "path").where("path IS NOT NULL"))
    return own.select("host", "path").unionByName(overall)


def extract_pages(pages: DataFrame) -> DataFrame:
    """All columns of ``pages`` (page_id, url, html) plus text and n_chars (same-named ones are replaced).

    Character references are decoded, white space inside a block becomes one space, blocks are
    trimmed and joined in page order by one line end. NULL, empty and markup-only pages have an
    empty text; pages without a host vote together as the empty host. Repeated rows vote and are
    read one by one.
    """
    ready(pages.sparkSession)
    winners = materialise(consensus(pages), "html-winners")
    overall = [r.path for r in winners.where("host IS NULL").limit(1).collect()]
    overall = overall[0] if overall else None
    own = winners.where("host IS NOT NULL").toDF("_host", "_path")  # one row a host

    @F.arrow_udf("string")
    def read(page: pa.Array, path: pa.Array) -> pa.Array:
        return pa.array([extract(p, (w, overall)) for p, w in zip(page.to_pylist(), path.to_pylist(), strict=True)],
                        pa.string())

    host, _ = split_url(column_or(pages, "url", "string"))
    out = pages.withColumn("_host", host).join(own, "_host", "left")
    out = out.withColumn("text", read(column_or(pages, "html", "string"), F.col("_path")))
    return out.withColumn("n_chars", F.length("text").cast("long")).drop("_host", "_path")


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``pages``."""
    return extract_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select(
        "page_id", "url", "text", "n_chars")
