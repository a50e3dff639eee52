"""Main text of web pages by site style trees.

The pages of one host share a template. Their DOMs are merged: a style node is
a host and a path of elements (tag, class, role), and over the pages that have it
the entropy of its content (which texts it holds) and of its presentation
(which child elements they have) say how much it varies. Template parts vary
little: their composite importance ``(1 - g^l) * presentation + g^l * content`` is low, ``l``
being the number of child styles. Branches that are low on enough distinct
pages, with the same texts on most of them, are removed from every page, except
within an article that the page marks.

What one page alone shows is used first: elements that HTML or a class name
mark as menu, header, footer, sidebar, notice, advert, form, comment section
or invisible are dropped, and if the page marks its article, the rest outside it.

A page whose every remaining block is low (all pages of a host alike) keeps
them: then nothing tells content from template.

Edge cases: a null or empty page gives an empty text; a null url is a host of
its own; repeated rows each get a result; equal pages count once in a tree;
unclosed and misnested elements end with their parents; empty tables give
empty results.
"""

from __future__ import annotations

import html as _html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlens.llm.common import broadcast_if, written

DAMPING = 0.9
#: a style node is judged if so many distinct pages have it, and low below this importance
MIN_PAGES = 8
LOW = 0.25
#: a form with so many characters, and most of the page's, is the page
PAGE_FORM = 400
#: text outside of articles is the page's own if it is so many times as long, and at least so many characters
TEASERS, PAGE_TEXT = 2, 200
#: and if a text on it is found on so large a share of its pages on average, whatever their number
COMMON = 0.75
#: hosts with low nodes that may be broadcast with the paths of these nodes
BROADCAST_HOSTS = 100_000

# Element names by what they do to the text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "textarea", "iframe", "title", "xmp", "noembed", "noframes")
#: elements without text of the page; they are left out up to their end tag, if they have one
SKIPPED = frozenset(("template", "svg", "object", "canvas", "select", "annotation", "annotation-xml"))
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search
    section summary table tbody td tfoot th thead tr ul""".split())
CLOSES_P = BLOCKS - frozenset("body caption dd dt head html legend li summary tbody td tfoot th thead tr".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}, "thead": {"tbody", "tfoot"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
NOISE_TAGS = frozenset("nav header footer aside form menu dialog button fieldset label head search".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
IN_HEAD = frozenset(("meta", "link", "base", *RAW, *SKIPPED))
MAIN_TAGS = frozenset(("article", "main"))
#: whole class tokens and ids, alone or with a part that names a box
NOISE_CLASS = re.compile(
    r"(?:ad|ads|advert|adverts|advertisement|sponsor|sponsored|promo|banner|nav|navbar|navigation|menu|submenu"
    r"|header|masthead|footer|sidebar|side-bar|aside|widget|breadcrumb|breadcrumbs|cookie|cookies|consent|notice|alert"
    r"|popup|modal|newsletter|subscribe|signup|login|share|social|related|recommended|comment|comments|commentlist"
    r"|respond|disqus|pagination|pager|copyright|legal)"
    r"(?:[_-](?:links?|lists?|area|bar|box|buttons?|block|container|form|icons?|inner|items?|menu|notice|popup|posts|section|slot|unit"
    r"|thread|title|widget|wrap|wrapper|\d+))*", re.I)
#: elements with such a token hold the page's own text, whatever else they are called
CONTENT_CLASS = frozenset("""content main-content page-content article article-body article-content post post-body
    post-content entry entry-content story story-body""".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])(?P<rawattr>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>.*?(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attr>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)", re.S | re.I)
_ATTR = re.compile(r"""(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|$)""", re.I)


#: how a block is marked as noise: 0 not at all, by its element, by being in a form, by a class, or only by a class
#: around the marked article that it is in
HARD, FORM, BY_CLASS, DOUBTFUL = 1, 2, 3, 4


class _Page:
    """Blocks of one page: text, path of elements, child styles, and whether an ancestor marks noise or an article."""

    def __init__(self):
        self.blocks: list[tuple[str, str, str, int, bool]] = []
        # (tag, style, noise, main); formatting elements carry no path
        self.stack: list[tuple[str, str, int, bool]] = []
        self.text: list[str] = []
        self.inside: list[str] = []

    def flush(self) -> None:
        words = " ".join(_html.unescape("".join(self.text)).split())
        if words:
            path = "/".join(s for _, s, _, _ in self.stack)
            top = self.stack[-1] if self.stack else ("", "", 0, False)
            self.blocks.append((words, path, ",".join(dict.fromkeys(self.inside)), top[2], top[3]))
        self.text, self.inside = [], []

    def _inherit(self) -> tuple[int, bool]:
        return (self.stack[-1][2], self.stack[-1][3]) if self.stack else (0, False)

    def _pop_to(self, tags: frozenset | set, stop: frozenset | set) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] in tags:
                self.flush()
                del self.stack[i:]
                return
            if self.stack[i][0] in stop:
                return

    def open(self, tag: str, attrs: str) -> None:
        found = {m[1].lower(): next((g for g in m.groups()[1:] if g is not None), "") for m in _ATTR.finditer(attrs)} if attrs else {}
        marks = " ".join(found.get(k, "") for k in ("class", "id")).lower().split()
        marked = tag in MAIN_TAGS or found.get("role", "").lower() in ("main", "article")
        by_class = not (marked or tag in HEADINGS or tag in ("html", "body") or CONTENT_CLASS.intersection(marks)) and any(
            map(NOISE_CLASS.fullmatch, marks))
        noise = int(tag in NOISE_TAGS or found.get("role", "").lower() in NOISE_ROLES or "hidden" in found
                 or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower())
        if noise and tag == "form" or not noise and by_class:
            noise = FORM if tag == "form" else BY_CLASS
        if self.stack and self.stack[-1][0] == "head" and tag not in IN_HEAD:
            self._pop_to({"head"}, set())  # content ends an unclosed head
        if tag in BLOCKS:
            self.flush()
            if tag in CLOSES_P:
                self._pop_to({"p"}, BLOCKS - {"p"})
            if tag in SIBLINGS:
                self._pop_to(SIBLINGS[tag], {"ul", "ol", "dl", "table", "menu"})
        elif tag in VOID:
            self.inside.append(tag)
            if tag == "br":
                self.text.append(" ")
            return
        else:
            self.inside.append(tag)
            if not noise:
                return  # formatting does not start a block
            self.flush()
        above, main = self._inherit()
        style = tag + ("." + ".".join(sorted(found["class"].lower().split())) if found.get("class") else "")
        if noise and tag in ("header", "footer") and main:
            noise = HARD if tag == "footer" else 0  # an article's own heading group is part of it
        if marked and not main and above in (FORM, BY_CLASS):
            above = 0 if above == FORM else DOUBTFUL  # the marked article is not noise by what is around it
        kept = noise if noise and above in (0, FORM, DOUBTFUL) else above
        self.stack.append((tag, style, kept, main or marked))

    def close(self, tag: str) -> None:
        if any(t == tag for t, *_ in self.stack):
            self._pop_to({tag}, set())


def parse(page: str) -> list[tuple[str, str, str, int, bool]]:
    """(text, path, child styles, noise, in article) of a page's blocks, in order."""
    state, at, endless = _Page(), 0, set()
    while m := _TOKEN.search(page, at):
        if m.start() > at:
            state.text.append(page[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        if m["end"]:
            state.close(tag.lower())
        else:
            tag = tag.lower()
            if tag in SKIPPED:
                if not m["attr"].endswith("/") and tag not in endless:
                    if end := re.compile(rf"</{tag}\s*[^>]*>", re.I).search(page, at):
                        at = end.end()
                    else:
                        endless.add(tag)  # not looked for again
                continue
            state.open(tag, m["attr"])
            if m["attr"].endswith("/") and tag not in BLOCKS and tag not in VOID:
                state.close(tag)
    state.text.append(page[at:])
    state.flush()
    return state.blocks


def usable(blocks: list[tuple[str, str, str, int, bool]]) -> list[tuple[str, str, str, bool]]:
    """Blocks that the page itself does not mark as noise, from its article if it marks one.

    An article within an element of a noise class stands against the unmarked
    blocks by length; so does a form that holds most of the page's text, and so
    do the blocks outside of articles that are mere teasers beside them. A
    page of which nothing would be left keeps what only a class or a form marks,
    in its article if it has one.
    """
    clean = [b for b in blocks if not b[3]]
    article, beside = [b for b in clean if b[4]], [b for b in clean if not b[4]]
    own, other = (sum(len(b[0]) for b in x) for x in (article, beside))
    if article and other >= max(TEASERS * own, PAGE_TEXT):
        article, clean = [], beside
    elif not article:
        others = [[b for b in blocks if b[3] == DOUBTFUL], [b for b in blocks if b[3] in (0, FORM)]]
        length = [sum(len(b[0]) for b in x) for x in (clean, *others)]
        if length[1] >= max(1, length[0]):
            clean = others[0]
        elif length[2] > 4 * length[0] and length[2] - length[0] >= PAGE_FORM:
            clean = others[1]
        if not clean:
            soft = [b for b in blocks if b[3] != HARD]
            clean = [b for b in soft if b[4]] or soft
    return [(*b[:3], b[4]) for b in (article or clean)]


def page_blocks(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page with its host and ``blocks``: text, path, child styles and whether a marked article has it."""

    @F.arrow_udf("array<struct<text:string,path:string,inside:string,main:boolean>>")
    def blocks(source: pa.Array) -> pa.Array:
        out = [[dict(zip(("text", "path", "inside", "main"), b)) for b in usable(parse(v.as_py() or ""))] for v in source]
        return pa.array(out, pa.list_(pa.struct([*((c, pa.string()) for c in ("text", "path", "inside")), ("main", pa.bool_())])))

    host = F.lower(F.regexp_extract(F.col(url), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]+)", 1))
    return pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"),
                        F.coalesce(host, F.lit("")).alias("host"), blocks(F.col(html)).alias("blocks"))


def node_importance(parsed: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """``host, path, pages, content, presentation, importance, common`` of style nodes on ``min_pages`` distinct pages or more.

    Content importance is one minus the mean entropy of the node's distinct
    texts over its pages; a text on ``k`` of ``m`` pages alike has entropy
    ``log k / log m``. Presentation importance is the entropy, to base ``m``, of the
    distribution of child styles. Both depend on ``m``; ``common`` does not: it is
    the mean share of the pages that have the text of an occurrence.
    """
    one = parsed.where(F.size("blocks") > 0).select(
        "host", F.xxhash64("blocks").alias("_page"), F.explode_outer(F.transform("blocks", lambda b: F.struct(
            b["path"].alias("path"), F.xxhash64(b["text"]).alias("text"), b["inside"].alias("inside")))).alias("b"))
    # Copies of a page have its key and so leave the same rows: distinct rows count a page once.
    node = written(one.select("host", "_page", "b.path", "b.text", "b.inside").distinct(), "style-nodes")
    pages = node.select("host", "path", "_page").distinct().groupBy("host", "path").agg(F.count("*").alias("pages"))
    pages = pages.where(F.col("pages") >= min_pages)
    texts = (node.select("host", "path", "text", "_page").distinct()
             .groupBy("host", "path", "text").agg(F.count("*").alias("k"))
             .groupBy("host", "path").agg(F.avg(F.log(F.col("k"))).alias("spread"),
                                         (F.sum(F.col("k") * F.col("k").cast("double")) / F.sum("k")).alias("same")))
    shapes = (node.select("host", "path", "inside", "_page").distinct()
              .groupBy("host", "path", "inside").agg(F.count("*").alias("k"))
              .groupBy("host", "path").agg(F.sum("k").alias("n"), F.sum(F.col("k") * F.log("k")).alias("klogk"),
                                           F.count("*").alias("styles")))
    base = F.log(F.col("pages"))
    content = F.lit(1.0) - F.col("spread") / base
    presentation = F.least(F.lit(1.0), (F.log("n") - F.col("klogk") / F.col("n")) / base)
    damp = F.pow(F.lit(DAMPING), F.col("styles"))
    return (pages.join(texts, ["host", "path"]).join(shapes, ["host", "path"])
            .select("host", "path", "pages", content.alias("content"), presentation.alias("presentation"),
                    ((F.lit(1.0) - damp) * presentation + damp * content).alias("importance"),
                    (F.col("same") / F.col("pages")).alias("common")))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
            min_pages: int = MIN_PAGES, low: float = LOW) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page.

    Pages are parsed once. A host's low nodes travel to its pages as one short
    list, by broadcast while at most ``BROADCAST_HOSTS`` hosts have any, so texts
    stay where they were parsed; beyond that by a join that splits hot hosts.
    """
    parsed = written(page_blocks(pages, page_id, url, html), "page-blocks")
    noisy = (node_importance(parsed, min_pages).where((F.col("importance") < low) & (F.col("common") >= COMMON))
             .groupBy("host").agg(F.collect_set("path").alias("_low")))
    noisy = broadcast_if(written(noisy, "low-nodes"), BROADCAST_HOSTS)
    kept = F.filter("blocks", lambda b: b["main"] | ~F.coalesce(F.array_contains("_low", b["path"]), F.lit(False)))
    chosen = F.when(F.size(kept) > 0, kept).otherwise(F.col("blocks"))
    text = F.array_join(F.transform(F.coalesce(chosen, F.array()), lambda b: b["text"]), "\n")
    return (parsed.join(noisy, "host", "left").select("page_id", "url", text.alias("text"))
            .withColumn("n_chars", F.length("text").cast("bigint")))
