"""Main text of web pages by consensus paths of a host.

1. Each page's containers are scored by the text that they hold outside of menus, notices, comments and the like.
2. Spark adds the scores by host and generalised path of tags and classes; the highest sum wins the host.
3. Each page is read again by its host's path; a page without it uses its own best container.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfield.llm.common import stash

#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that begin and end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that hold an article's prose, and those of them that may stand before its container.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote li pre".split())
LEAD = frozenset(["p", "blockquote"])
#: Elements that an open p ends at.
ENDS_P = BLOCKS - frozenset("body caption dd dt html legend li optgroup option tbody td tfoot th thead tr".split()) | frozenset("dd dt li".split())
#: What the start of an element ends, up to the nearest of the second.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table", "tbody", "thead", "tfoot"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist", "optgroup"])),
}
#: Elements, roles and name parts that are no part of an article.
DROP_TAGS = frozenset(
    "applet aside audio button canvas datalist dialog embed footer form head iframe input map menu nav noembed noframes noscript object "
    "script search select style svg template textarea title video".split()
)
DROP_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search tablist toolbar".split())
DROP_NAMES = frozenset(
    "ad ads adsense advert adverts advertisement advertising banner banners breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies discussion disqus footer gdpr masthead menu menus modal nav navbar navigation newsletter notice notices "
    "pager pagination paywall popup promo promos promotion promoted recommended recommendations related replies reply respond share sharing "
    "sidebar sidebars sidenav signup skip social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)
RAW = "script|style|textarea|title|noscript|template|iframe|noembed|noframes|xmp"
TOKEN = re.compile(
    r"<!--(?:>|->)?.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<raw>{RAW})(?=[\s/>])[^>]*>.*?(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)"
    # a quote only opens a value after a sign of equality, and only if it is closed somewhere
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*)(?:>|\Z)",
    re.S | re.I,
)
ATTR = re.compile(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))|([^\s=/>\"']+)")
CONTENT_NAME = re.compile(r"article|content|story|post|entry|main|body|text", re.I)
NAME_PART = re.compile(r"[-_\s]+|(?<=[a-z])(?=[A-Z])")
#: Names that count as a whole or as the first part, as in the middle of others they are common in articles.
WHOLE_ONLY = frozenset(["ad", "banner", "notice", "share", "skip", "social"])
#: Last parts of names of clutter; first and last parts of names of what lies around clutter and content.
ENDS_NAME = frozenset(["ad", "ads", "banner", "notice"])
AROUND_FIRST = frozenset(["has", "with", "no", "without"])
AROUND_LAST = frozenset(["wrap", "wrapper", "container", "layout"])


class Element:
    __slots__ = ("tag", "path", "dropped", "inside", "kept", "linked", "depth")

    def __init__(self, tag: str, path: str, dropped: bool, inside: bool, depth: int):
        self.tag, self.path, self.dropped, self.inside, self.depth = tag, path, dropped, inside, depth
        self.kept = self.linked = 0


def attributes(raw: str) -> dict[str, str]:
    return {(m[1] or m[5]).lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTR.finditer(raw)} if raw.strip(" /") else {}


def is_clutter(tag: str, attrs: dict[str, str], inside: bool) -> bool:
    """Whether an element is no part of an article; inside of one its header stays."""
    if tag in DROP_TAGS or tag == "header" and not inside:
        return True
    if not attrs or tag in ("html", "body", "article", "main"):
        return False
    if "hidden" in attrs or attrs.get("role", "").lower() in DROP_ROLES or attrs.get("aria-hidden") == "true":
        return True
    return any(names_clutter(name, inside, inside and tag in PROSE) for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".split())


@lru_cache(1 << 14)
def names_clutter(name: str, inside: bool, prose: bool = False) -> bool:
    """Whether a class or id is a name for clutter. ``content-sidebar-wrap`` and ``has-sidebar`` name what lies around both.

    What holds prose in an article (``prose``) is clutter by a whole name only: ``notice``, but not ``notice-period``.
    """
    parts = [p for p in (x.lower().rstrip("0123456789") for x in NAME_PART.split(name)) if p]
    if not parts:
        return False
    if prose:
        return "".join(parts) in DROP_NAMES
    if parts[0] in AROUND_FIRST or parts[-1] in AROUND_LAST and CONTENT_NAME.fullmatch(parts[0]):
        return False
    if any(p in DROP_NAMES and p not in WHOLE_ONLY for p in parts) or "".join(parts) in DROP_NAMES:
        return True
    if parts[0] in WHOLE_ONLY and not any(CONTENT_NAME.fullmatch(p) for p in parts) or parts[-1] in ENDS_NAME:
        return True
    return parts[-1] == "header" and (len(parts) == 1 and not inside or parts[0] in ("site", "page", "global", "top"))


def path_part(tag: str, attrs: dict[str, str]) -> str:
    """The tag with its first class, where digits become one sign."""
    name = (attrs.get("class", "").split() or [""])[0]
    return f"{tag}.{re.sub(r'[0-9]+', '#', name)}" if name else tag


def blocks(page: str) -> tuple[list[tuple[tuple[int, ...], str, int]], list[Element]]:
    """Blocks of text outside of clutter, as ``(indices of the elements around, text, characters in links)``, and all elements."""
    elements = [Element("", "", False, False, 0)]
    stack = [0]
    out: list[tuple[tuple[int, ...], str, int]] = []
    held: list[str] = []
    around: tuple[int, ...] = ()
    linked = links = 0

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join("".join(held).split())
            if text:
                out.append((around, text, min(linked, len(text))))
            held.clear()
        linked = 0

    def say(raw: str) -> None:
        nonlocal around, linked
        if raw and not elements[stack[-1]].dropped:
            if not held:
                around = tuple(stack)
            # run by run, as a reference doesn't reach across a tag
            held.append(html.unescape(raw))
            if links:
                linked += len(raw)

    def close(at: int) -> None:
        nonlocal links
        while len(stack) > at:
            tag = elements[stack.pop()].tag
            if tag in BLOCKS:
                flush()
            links -= tag == "a"

    last = 0
    for m in TOKEN.finditer(page):
        say(page[last : m.start()])
        last = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            say("\n")
            continue
        if m["end"]:
            for at in range(len(stack) - 1, 0, -1):
                if elements[stack[at]].tag == tag:
                    close(at)
                    break
            continue
        if tag in ENDS_P:
            for at in range(len(stack) - 1, 0, -1):
                if elements[stack[at]].tag == "p":
                    close(at)
                    break
                if elements[stack[at]].tag in BLOCKS:
                    break
        if tag in ENDS:
            ended, limit = ENDS[tag]
            for at in range(len(stack) - 1, 0, -1):
                if elements[stack[at]].tag in limit:
                    break
                if elements[stack[at]].tag in ended:
                    close(at)
                    if tag != "tr":
                        break
        if tag in BLOCKS:
            flush()
        if tag in VOID:
            continue
        attrs = attributes(m["attrs"])
        up = elements[stack[-1]]
        inside = up.inside or tag in ("article", "main") or attrs.get("role") == "main"
        path = f"{up.path}>{path_part(tag, attrs)}" if up.path else path_part(tag, attrs)
        elements.append(Element(tag, path, up.dropped or is_clutter(tag, attrs, up.inside), inside, up.depth + 1))
        if not m["attrs"].endswith("/") or tag not in ("path", "circle", "rect", "line", "use", "g"):
            stack.append(len(elements) - 1)
            links += tag == "a"
    say(page[last:])
    flush()
    return out, elements


def container_scores(found: list, elements: list[Element]) -> dict[str, float]:
    """For each container path of a page its share of the page's text, links taken off, and more for elements that are meant to hold it."""
    for around, text, linked in found:
        for i in around:
            elements[i].kept += len(text) - linked
    total = max(1, elements[0].kept)
    scores: dict[str, float] = {}
    for e in elements[1:]:
        if e.dropped or not e.kept or e.tag not in ("article", "main", "section", "div", "td", "body", "html"):
            continue
        name = e.path.rpartition(">")[2].partition(".")[2]
        favour = {"article": 1.5, "main": 1.3, "body": 0.7, "html": 0.6}.get(e.tag, 1.2 if CONTENT_NAME.search(name) else 1.0)
        scores[e.path] = scores.get(e.path, 0.0) + favour * e.kept / total
    # of elements with the same text the inner one names the place better; nested paths differ by it only
    return {p: s + 0.001 * p.count(">") * (s > 0.5) for p, s in scores.items()}


def votes(page: str | None) -> list[tuple[str, float]]:
    """The containers that come near the page's best, with their share of it."""
    scores = container_scores(*blocks(page or ""))
    top = max(scores.values(), default=0)
    return [(p, s / top) for p, s in scores.items() if s >= 0.5 * top]


def extract_page(page: str | None, path: str | None) -> tuple[str, str | None]:
    """The text of all containers at ``path``, or of the page's own best one, with the paragraphs before it in its wrapper, and the path that was used."""
    found, elements = blocks(page or "")
    if path is None or not any(elements[i].path == path for around, _, _ in found for i in around):
        scores = container_scores(found, elements)
        path = min(scores, key=lambda p: (-scores[p], p)) if scores else None
    if path is None:
        return " ".join(text for _, text, _ in found), None
    first = next(around for around, _, _ in found if any(elements[i].path == path for i in around))
    at = next(k for k, i in enumerate(first) if elements[i].path == path)
    # paragraphs that stand before the container in the same wrapper lead the article
    wrapper = first[at - 1] if elements[first[at - 1]].tag not in ("", "html", "body") else None
    told, begun = [], False
    for around, text, _ in found:
        inside = any(elements[i].path == path for i in around)
        begun = begun or inside
        lead = not begun and wrapper in around[:-1] and elements[around[around.index(wrapper) + 1]].tag in LEAD
        if inside or lead:
            told.append(text)
    return " ".join(told), path


def vote_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Scores of a batch, added by host and path."""
    for pdf in batches:
        total: dict[tuple[str, str], float] = {}
        for host, page in zip(pdf.host, pdf.html):
            for path, score in votes(page):
                total[host, path] = total.get((host, path), 0.0) + score
        yield pd.DataFrame([(h, p, s) for (h, p), s in total.items()], columns=["host", "path", "score"])


def host_of(url):
    return F.lower(F.nullif(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def host_paths(pages: DataFrame) -> DataFrame:
    """``(host, path)``: the winning path of each host; ties go to the path that is first by name."""
    rows = pages.select(host_of(F.col("url")).alias("host"), "html").filter("host IS NOT NULL AND html IS NOT NULL")
    # rounded, so that the order in which parts are added can't change a winner
    total = rows.mapInPandas(vote_rows, "host string, path string, score double").groupBy("host", "path").agg(F.round(F.sum("score"), 6).alias("score"))
    return total.groupBy("host").agg(F.min(F.struct((-F.col("score")).alias("s"), "path")).alias("best")).select("host", "best.path")


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text``, ``n_chars`` (code points) and ``path`` (the container used, null if none).

    A null or empty page gives an empty text, repeated rows the same one each, a table without rows none; a page is read as a whole, whatever its length. A page whose url is null or names no host has no consensus and uses its own best
    container. Other columns stay; those with these names are replaced. Winning paths are written to the shared
    folder first, so the planner knows their size and broadcasts them only if they are small; a hot host is split by
    the skew join otherwise.
    """
    best = stash(host_paths(pages), "host-paths").toDF("__host", "__path")
    keyed = pages.withColumn("__own", host_of(F.col("url")))
    joined = keyed.join(best, F.col("__own") == F.col("__host"), "left")

    @F.pandas_udf("struct<text: string, path: string>")
    def read(pages_: pd.Series, paths: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([extract_page(p, w) for p, w in zip(pages_, paths)], columns=["text", "path"])

    out = joined.withColumn("__read", read("html", "__path")).drop("__host", "__path", "__own")
    return out.withColumns({"text": F.col("__read.text"), "path": F.col("__read.path"), "n_chars": F.length("__read.text").cast("long")}).drop("__read")
