"""The tag scanner against a tree built from Python's HTML tokens."""

import random
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from transitlens.operators import crawl
from transitlens.operators.tags import first_links


class Node:
    def __init__(self, name, attrs, parent):
        self.name, self.attrs, self.parent, self.children = name, dict(attrs), parent, []

    def all(self, name):
        for c in self.children:
            if isinstance(c, Node):
                if c.name == name:
                    yield c
                yield from c.all(name)

    def text(self):
        return "".join(c if isinstance(c, str) else c.text() for c in self.children)


class Tree(HTMLParser):
    """Elements that matter, with the end tags that HTML lets authors omit put in."""

    def __init__(self, listing):
        super().__init__(convert_charrefs=False)
        self.kinds = {listing.container, listing.row, "a", *listing.nesting}
        self.listing, self.root, self.raw = listing, Node("root", [], None), 0
        self.at = self.root

    def _open(self, names, until):
        n = self.at
        while n is not None and n.name not in until:
            if n.name in names:
                return n
            n = n.parent
        return None

    def _close(self, node):
        self.at = node.parent

    def handle_starttag(self, name, attrs):
        if name in ("script", "style"):
            self.raw = 1
        if name not in self.kinds:
            return
        x = self.listing
        if name == x.row and (open_row := self._open([x.row], [*x.nesting, x.container])):
            self._close(open_row)
        if name == "a" and (open_link := self._open(["a"], [])):
            # what was open within the link stays open beside it: rows and lists are not closed by a link
            within, n = [], self.at
            while n is not open_link:
                within.append(n)
                n = n.parent
            if not within:
                self._close(open_link)
        self.at.children.append(Node(name, attrs, self.at))
        self.at = self.at.children[-1]

    def handle_startendtag(self, name, attrs):
        self.handle_starttag(name, attrs)

    def handle_endtag(self, name):
        if name in ("script", "style"):
            self.raw = 0
        x = self.listing
        stop = [] if name == x.container and name not in x.nesting else [x.container, *x.nesting] if name in (x.row, "a") else []
        if name in self.kinds and (n := self._open([name], [s for s in stop if s != name])):
            self._close(n)

    def _say(self, text):
        if not self.raw:
            self.at.children.append(text)

    def handle_data(self, data):
        self._say(data)

    def handle_entityref(self, name):
        self._say(f"&{name};")

    def handle_charref(self, name):
        self._say(f"&#{name};")


def plain(html, listing):
    tree = Tree(listing)
    tree.feed(html)
    tree.close()
    for c in tree.root.all(listing.container):
        if listing.css_class is None or listing.css_class in (c.attrs.get("class") or "").split():
            out = []
            for k, row in enumerate(c.all(listing.row), 1):
                link = next(row.all("a"), None)
                if link is not None:
                    out.append((k, link.text()))
            return out
    return []


def scanned(spark, pages, listing):
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")
    found = {r["page_id"]: [tuple(x) for x in r["found"]]
             for r in df.select("page_id", first_links(F.col("html"), listing).alias("found")).collect()}
    return [found[i] for i in range(len(pages))]


def _cell(rnd, depth):
    inner = rnd.choice(["T1", "x &lt; y", "1 < 2", "<b>B</b>i", "<!-- </a></tr><a>no</a> -->c", "<script>'</a><a>'</script>s", "", " "])
    link = f"<a {rnd.choice(['href=/x', 'title=\"a>b\"', 'data-x=\'<tr>\'', ''])}>{inner}</a>"
    nested = _table(rnd, depth + 1, "") if depth < 3 and rnd.random() < 0.25 else ""
    return rnd.choice([link, link + link, "plain", nested + link, link + nested, nested, f"<i>{link}</i>"])


def _table(rnd, depth, cls):
    end_row = rnd.choice(["</tr>", "", "</tr >", "</TR>"])
    rows = "".join(f"<{rnd.choice(['tr', 'TR', 'tr class=\"r\"'])}><td>{_cell(rnd, depth)}{rnd.choice(['</td>', ''])}{end_row}"
                   for _ in range(rnd.randrange(0, 4)))
    return f"<{rnd.choice(['table', 'TABLE'])}{cls}>{rnd.choice(['<tbody>', ''])}{rows}</table>"


def _list(rnd, depth):
    item = rnd.choice(["</li>", ""])
    rows = ""
    for _ in range(rnd.randrange(0, 4)):
        nested = _list(rnd, depth + 1) if depth < 3 and rnd.random() < 0.3 else ""
        rows += f"<li>{rnd.choice(['', '<a href=/y>N%d</a>' % rnd.randrange(9)])}{nested}{rnd.choice(['', '<a>late</a>'])}{item}"
    tag = rnd.choice(["ul", "ol"])
    return f"<{tag}>{rows}</{tag}>"


def test_generated_pages_give_what_a_tree_gives(spark):
    rnd = random.Random(3)
    classes = [" class=category", ' class="a category b"', " class='category'", ' id="x" CLASS = "category"', ' class="sub-category"',
               ' data-class="category"', "", ' title="class=category"', " title='>' class=category"]
    pages = ["<html><!-- <table class=category><tr><td><a>no</a></table> -->"
             f"<p>{_table(rnd, 0, rnd.choice(classes))}{_table(rnd, 0, rnd.choice(classes))}<a>after</a></html>" for _ in range(400)]
    got = scanned(spark, pages, crawl.ROUTE_TABLE)
    for p, g in zip(pages, got, strict=True):
        assert g == plain(p, crawl.ROUTE_TABLE), p
    assert sum(map(len, got)) > 300
    navs = [f"<div><ul><li><a>no</a></ul><nav class=x>{_list(rnd, 0)}{_list(rnd, 0)}</nav><nav><ul><li><a>no</a></ul></nav>" for _ in range(300)]
    got = scanned(spark, navs, crawl.NAV_LIST)
    for p, g in zip(navs, got, strict=True):
        assert g == plain(p, crawl.NAV_LIST), p
    assert sum(map(len, got)) > 300


@pytest.mark.parametrize("html, expected", [
    ("", []), (None, None), ("<table class=category>", []), ("<table class=category><tr><td><a>open", [(1, "open")]),
    ("<table class=category><tr><td><a>A<tr><td><a>B</table><a>C</a>", [(1, "A"), (2, "B")]),
    ("<table class=category><tr></tr></tr></td><tr><a>x</a></table>", [(2, "x")]),
    ("<script><table class=category><tr><a>no</a></table></script>", []),
    ("<table class=category><tr><a>one<a>two</a></table>", [(1, "one")]),
    ('<table class=category><tr><td title="</table>"><a href="</a>">q</a></table>', [(1, "q")]),
    ("<title><table class=category></title><table class=category><tr><td><a>t</a>", [(1, "t")]),
    ("<table class=category><tr><td><a>a</3>b<?x?>c<!d>e</a>", [(1, "abce")]),
])
def test_single_pages(spark, html, expected):
    assert scanned_one(spark, html) == expected


def scanned_one(spark, html):
    df = spark.createDataFrame([(0, html)], "page_id long, html string")
    found = df.select(first_links(F.col("html"), crawl.ROUTE_TABLE).alias("f")).first()["f"]
    return found if found is None else [tuple(x) for x in found]


def test_long_pages(spark):
    """Long texts, many rows and many attributes take neither deep stacks nor squared time."""
    rows = "".join(f"<tr><td><a href='/{i}'>R{i}</a></td></tr>" for i in range(4000))
    t = time.time()
    assert len(scanned_one(spark, f"<p>{'x' * 2_000_000} < y</p><table class=category>{rows}</table>")) == 4000
    assert scanned_one(spark, f"<div {' '.join(f'a{i}=1' for i in range(500))}><table class=category><tr><td><a>{'y ' * 100000}</a>") == [
        (1, "y " * 100000)]
    assert time.time() - t < 60
