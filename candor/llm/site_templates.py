"""Main text of web pages: site template removal.

A page is parsed where it lies into blocks of text, each with the hashes of the element subtrees that
hold it. Spark counts, for each host, in how many different pages each subtree occurs; subtrees that
recur in ``min_pages`` of them, however large the host is, are the site's template and go, with all
their blocks. Elements that
name themselves as something else than the article (menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles, reader comments: by tag, role, class or id) go while parsing.
Of what is left, only text within ``article`` (else ``main``) elements is kept if they hold more than half of
it; else all is, so a page whose ``article`` elements are teasers keeps its main text.

A subtree counts once for each different text it occurs with (of the ``article``, else the ``main``
that it lies in, else of the page), so copies of a page, however many, don't make its text a
template. Inside ``article`` and ``main``, headings, paragraphs, lists, tables and inline elements are text
even where a passage recurs; only generic containers can be template there. The elements themselves, and
their text, go with the template only where they don't hold most of the page.
A page where a subtree holds half of the text or more doesn't count for it, so the text of pages that
differ in a date alone is no template; but what other pages show to be template goes there as well.

Counts are combined before each shuffle; what to delete comes back as one small list a page, so a host
with a third of all pages makes no hot task and pages themselves move only if that list is
larger than the session's broadcast limit.

Defined results: null and empty html give an empty text; a null or odd url is a host of its own
("" for all of those); repeated rows are pages of their own; an empty table gives no rows. Blocks
are joined by one space; white space inside a block (line breaks and no-break spaces included) is one
space. page_id, url and html are read by name, so further columns can have any name.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, require, table, with_row_id

# Fixed values of HTML: how its elements nest.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "canvas")
FLOW = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
CLOSED_BY = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
             "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
             "option": ({"option"}, {"select"})}
# What names itself as something else than the article.
NOT_ARTICLE = frozenset("nav aside footer form menu dialog button select datalist search head header".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promoted "
    "cookie cookies consent gdpr notice notices notification notifications alert popup modal overlay paywall newsletter "
    "subscribe subscription signup login menu menus nav navbar navigation navi breadcrumb breadcrumbs sidebar sidenav "
    "pagination pager footer header masthead topbar toolbar comment comments commentlist respond disqus reply replies "
    "related recommended share sharing social widget widgets search form".split())
# Words that say nothing of their own in such a name: "comment-list" is one, "notice-board-history" isn't.
GENERIC = frozenset(
    "area aside bar block body box btn button buttons card cards cell center col column container content control controls "
    "desktop div element entry footer global group header heading holder icon icons inner item items label layer left line link links list "
    "main mobile module nav outer page pane panel post posts primary region right row secondary section site slot slots tab text thread title top "
    "bottom unit units view wrap wrapper zone section articles stories a b c d e f g h i j k l m n o p q r s t u v w x y z".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ABOUT = frozenset("has is js no not with without".split())  # such a class ("with-sidebar") tells what is around it
TEXT_IN_ARTICLE = frozenset(
    "p h1 h2 h3 h4 h5 h6 blockquote pre ul ol li dl dt dd table caption thead tbody tfoot tr td th figure figcaption".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>"
    r"|<(?P<raw>" + "|".join(RAW) + r")\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*(?<!/)>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*|[^>]*)>", re.S | re.I)
ATTR = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

MIN_PAGES = 5


class _Element:
    __slots__ = ("tag", "skip", "inside", "hash", "size", "removable", "weak", "within")

    def __init__(self, tag: str, skip: bool, inside: int, within: _Element | None = None):
        self.tag, self.skip, self.inside = tag, skip, inside
        self.hash, self.size, self.removable = xxhash.xxh3_64(tag), 0, False
        self.weak = False  # goes only where article and main elements don't hold most of the page
        self.within = within  # the article, else the main, that it lies in

    def digest(self) -> int:
        return self.hash.intdigest() - (1 << 63)


def _foreign(tag: str, attrs: str, inside: int) -> bool:
    """Whether an element names itself as something else than the article. Inside an article a header
    holds its title, so there only other names count."""
    names = set()
    if attrs and tag not in HEADINGS:
        for name, *values in ATTR.findall(attrs):
            for value in "".join(values).lower().split():
                words = re.split("[^a-z0-9]+", value)
                if name.lower() == "role":
                    if value in ROLES:
                        return True
                elif words[0] not in ABOUT and all(w in NAMES or w in GENERIC or w.isdigit() for w in words if w):
                    names |= NAMES.intersection(words)  # one of these words among others of a topic is no such name
    if inside:
        names.discard("header")
        return bool(names) or (tag in NOT_ARTICLE and tag != "header")
    return bool(names) and tag not in ("html", "body", "article", "main") or tag in NOT_ARTICLE


def blocks(page: str | None) -> list[tuple[str, list[int]]]:
    """The blocks of text that the page keeps if the host has no template, in order, each with the hashes of
    the subtrees it could go with."""
    found = _blocks(page)[0]
    of = [sum(len(t) for t, inside, *_ in found if inside >= least) for least in range(3)]
    level = 2 if 2 * of[2] > of[0] else 1 if 2 * of[1] > of[0] else 0
    return [(t, strong) for t, inside, strong, _ in found if inside >= level]


def _blocks(page: str | None) -> tuple[list[tuple[str, int, list[int], list[int]]], list[tuple[int, int]]]:
    """The page's blocks of text in order: text, 2 in an article or 1 in a main, the hashes of the subtrees
    it goes with if they are template, and of those it goes with only if articles aren't the page's main
    text. Then the subtrees that the page counts for, each with the hash of the text around it."""
    stack = [_Element("#page", False, 0)]
    found: list[tuple[str, int, list[_Element]]] = []  # text, 2 in an article, 1 in main, the elements around
    text: list[str] = []
    spaces = re.compile(r"\s+").sub

    def flush() -> None:
        if text:
            got = spaces(" ", entities.unescape("".join(text))).strip()
            text.clear()
            if got and not stack[-1].skip:
                found.append((got, stack[-1].inside, stack[1:]))
                for e in stack:
                    e.size += len(got)
                stack[-1].hash.update(got.encode("utf-8", "surrogatepass"))

    def pop() -> None:
        e = stack.pop()
        if not e.skip and not stack[-1].skip:
            stack[-1].hash.update(e.hash.digest())

    def pop_to(tags: set[str], until: set[str] | frozenset[str]) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in tags:
                while len(stack) > k:
                    pop()
                return
            if stack[k].tag in until:
                return

    last = 0
    page = page or ""
    for m in TOKEN.finditer(page):
        if m.start() > last:
            text.append(page[last:m.start()])
        last = m.end()
        tag = (m["tag"] or "").lower()
        if m["raw"] or not tag:
            continue
        if tag in FLOW or tag == "br":
            flush()
        if m["close"]:
            if any(e.tag == tag for e in stack[1:]):
                flush()
                pop_to({tag}, frozenset())
            continue
        if tag in FLOW and tag != "option":
            pop_to({"p"}, {"td", "th", "li", "div", "section", "article", "main", "aside", "body", "table", "button", "blockquote"})
        if tag in CLOSED_BY:
            pop_to(*CLOSED_BY[tag])
        if tag in VOID or m["attrs"].endswith("/") and tag not in FLOW:
            continue
        up = stack[-1]
        inside = 2 if tag == "article" else max(up.inside, 1) if tag == "main" else up.inside
        within = up if up.tag == "article" or up.tag == "main" and up.inside < 2 else up.within
        e = _Element(tag, up.skip or _foreign(tag, m["attrs"], up.inside), inside, within)
        if tag in FLOW:
            e.weak = tag in ("article", "main") or bool(up.inside and tag in TEXT_IN_ARTICLE)
            e.removable = tag not in ("html", "body") and not e.weak
            stack.append(e)
        elif e.skip and (not up.skip or any(x.tag == tag for x in stack)):  # inline: only what goes is followed
            flush()
            stack.append(e)
    if last < len(page):
        text.append(page[last:])
    flush()
    while len(stack) > 1:
        pop()
    whole = xxhash.xxh3_64_intdigest(" ".join(t for t, *_ in found).encode("utf-8", "surrogatepass")) - (1 << 63)
    elements = {id(e): e for *_, around in found for e in around if e.removable or e.weak}
    counted = {(e.digest(), e.within.digest() if e.within else whole) for e in elements.values()
               if 2 * e.size < (e.within or stack[0]).size}
    # a single article that holds most of the page whatever else is template: while it's there, nothing weak goes
    sure = sum(len(t) for t, inside, around in found if inside == 2 and not any(e.removable and e.inside == 2 for e in around))
    alone = 2 * sure > stack[0].size and len({id(e) for *_, around in found for e in around if e.tag == "article"}) == 1
    return [(t, inside, [e.digest() for e in around if e.removable],
             [] if alone and inside == 2 else [e.digest() for e in around if e.weak])
            for t, inside, around in found], list(counted)


def _parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        got = [_blocks(page) for page in batch["html"]]
        yield pd.DataFrame({
            "page_id": batch["page_id"], "rid": batch["rid"], "url": batch["url"],
            "blocks": [[{"text": t, "inside": i, "subtrees": s, "weak": w} for t, i, s, w in b] for b, _ in got],
            "counted": [[{"subtree": e, "around": a} for e, a in c] for _, c in got]})


def extract(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """Every page: page_id, url, text. A subtree is template if it occurs in ``min_pages`` different
    pages of its host."""
    rows = with_row_id(require(pages, ["page_id", "url", "html"])).select("row.page_id", "rid", "row.url", "row.html")
    kind = rows.schema["page_id"].dataType.simpleString()
    rows = rows.mapInPandas(_parsed, f"page_id {kind}, rid bigint, url string, "
                                     "blocks array<struct<text:string,inside:int,subtrees:array<bigint>,weak:array<bigint>>>, "
                                     "counted array<struct<subtree:bigint,around:bigint>>")
    rows = materialise(rows, "page-blocks")
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    subtrees = F.array_union(F.flatten(F.col("blocks.subtrees")), F.flatten(F.col("blocks.weak")))
    held = rows.select("page_id", "rid", host.alias("host"), F.explode(subtrees).alias("subtree"))
    counted = rows.select(host.alias("host"), F.inline("counted")).distinct()
    counts = counted.groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("n"))
    template = materialise(counts.where(F.col("n") >= min_pages).select("host", "subtree"), "page-templates")
    gone = held.join(template, ["host", "subtree"]).groupBy("rid", "page_id").agg(F.collect_set("subtree").alias("gone"))
    gone = materialise(gone.select(F.col("rid").alias("of"), F.col("page_id").alias("of_id"), "gone"), "page-gone")
    rows = rows.join(gone, (F.col("rid") == F.col("of")) & F.col("page_id").eqNullSafe(F.col("of_id")), "left")
    # again a step of its own: the page's level is decided on the blocks that are left
    stays = F.filter("blocks", lambda b: F.col("gone").isNull() | ~F.arrays_overlap(b["subtrees"], F.col("gone")))
    rows = rows.select("page_id", "url", "gone", stays.alias("stays"))
    of = [F.aggregate(F.filter("stays", lambda b: b["inside"] >= F.lit(least)), F.lit(0).cast("bigint"),  # noqa: B023
                      lambda n, b: n + F.char_length(b["text"])) for least in range(3)]
    rows = rows.select("*", F.when(2 * of[2] > of[0], 2).when(2 * of[1] > of[0], 1).otherwise(0).alias("level"))
    kept = F.filter("stays", lambda b: (b["inside"] >= F.col("level")) & (
        F.col("gone").isNull() | (b["inside"] <= F.col("level")) | ~F.arrays_overlap(b["weak"], F.col("gone"))))
    text = F.array_join(F.transform(kept, lambda b: b["text"]), " ")
    return rows.select("page_id", "url", text.alias("text"))


def op3_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page: page_id, url, text, n_chars."""
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))
