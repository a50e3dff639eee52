"""Link texts of the rows of one container element, read by a scanner of HTML tags.

A page is cut into tokens once: a comment, the whole of a raw element, or a tag
with the text behind it. Quoted attribute values may hold any character.
``aggregate`` then carries the nesting through the tokens, as an HTML parser
would: the container is the first element of its name and class; it, its rows
and lists or tables within it nest; a row or a list or table that ends closes
what is open inside; a new row closes an open one of the same list or table (end
tags of rows may be omitted). Every row in the container, nested ones included,
takes the text of its first link; a link inside a nested row is also the first
link of the outer row if that had none before.

A link ends at its end tag, at the next link, or where a row ends. An element
that is never closed reaches to the end of the page.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# How HTML writes attributes, tags and elements whose content holds no tags.
ATTRIBUTE = r"""[^\s/>=][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+))?+"""
TAG = rf"""</?[a-zA-Z][^\s/>]*+(?:[\s/]++|{ATTRIBUTE}|=)*+>"""
RAW_ELEMENTS = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")
COMMENT = r"<!--(?:-?>|(?s:.*?)(?:--!?>|\z))|<[!?][^>]*+>?|</(?![a-zA-Z])[^>]*+>?"
RAW = (rf"<(?i:(?<raw>{'|'.join(RAW_ELEMENTS)}))(?=[\s/>])(?:[\s/]++|{ATTRIBUTE}|=)*+>"
       r"(?s:.*?)(?:</(?i:\k<raw>)(?=[\s/>])[^>]*+>|\z)")
MARKUP = f"(?:{COMMENT}|{RAW}|{TAG})"
TOKEN = rf"{MARKUP}[^<]*+(?:<(?![a-zA-Z/!?])[^<]*+)*+"
NAME = r"^</?([a-zA-Z][^\s/>]*)"
TAG_AHEAD = rf"^({TAG})"
CLASS = r"(?i)^class\s*=\s*"


@dataclass(frozen=True)
class Listing:
    """Where links are listed: the container's name and class, the rows, and the elements that rows nest in."""

    container: str
    row: str
    nesting: tuple[str, ...]
    css_class: str | None = None


ROUTE_TABLE = Listing("table", "tr", ("table",), "category")
NAV_LIST = Listing("nav", "li", ("ul", "ol", "menu"))

_STATE = ("struct<inside:int,level:int,rows:int,open:array<struct<row:int,level:int,named:boolean>>,"
          "link:string,waiting:array<int>,out:array<struct<row:int,link:string>>>")


def _has_class(tag: Column, css_class: str) -> Column:
    """Whether a tag's class attribute holds the class as a whole word."""
    body = F.regexp_replace(tag, NAME, "")
    attributes = F.regexp_extract_all(body, F.lit(ATTRIBUTE), F.lit(0))
    found = F.get(F.filter(attributes, lambda a: a.rlike(CLASS)), F.lit(0))
    value = F.regexp_replace(F.regexp_replace(found, CLASS, ""), r"""^["']|["']$""", "")
    return F.coalesce(F.array_contains(F.split(value, r"\s+"), css_class), F.lit(False))


def _tokens(html: Column, listing: Listing) -> Column:
    """Structs of tag name (empty unless it matters), closing, fit (a container's start), and the token itself."""
    names = {listing.container, listing.row, "a", *listing.nesting}

    def token(t: Column) -> Column:
        name = F.lower(F.regexp_extract(t, NAME, 1))
        known = F.when(name.isin(*RAW_ELEMENTS), F.lit("")).otherwise(name)
        closing = F.startswith(t, F.lit("</"))
        fit = F.lit(True) if listing.css_class is None else _has_class(F.regexp_extract(t, TAG_AHEAD, 1), listing.css_class)
        return F.struct(F.when(known.isin(*names), known).otherwise(F.lit("")).alias("name"), closing.alias("closing"),
                        F.when(~closing & (known == listing.container), fit).otherwise(F.lit(False)).alias("fit"),
                        t.alias("whole"))

    return F.transform(F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0)), token)


def _text(t: Column) -> Column:
    """The text behind a token's tag."""
    return F.regexp_replace(t["whole"], f"^{MARKUP}", "")


def _step(listing: Listing):
    def state(s: Column, **changed: Column) -> Column:
        fields = ("inside", "level", "rows", "open", "link", "waiting", "out")
        return F.struct(*[changed.get(f, s[f]).alias(f) for f in fields])

    def longer(s: Column, t: Column) -> Column:
        """The link being read goes on."""
        return F.when(s["link"].isNotNull(), F.concat(s["link"], _text(t)))

    def ended(s: Column) -> dict[str, Column]:
        """The link being read, if there is one, goes to the rows that wait for it."""
        reading = s["link"].isNotNull()
        said = F.transform(s["waiting"], lambda r: F.struct(r.alias("row"), s["link"].alias("link")))
        return {"link": F.lit(None).cast("string"), "out": F.when(reading, F.concat(s["out"], said)).otherwise(s["out"])}

    def closed(s: Column, t: Column, keep) -> dict[str, Column]:
        """Rows that ``keep`` refuses are closed; if any is, the link ends, and else it goes on."""
        left = F.filter(s["open"], keep)
        any_closed = F.size(left) < F.size(s["open"])
        end = ended(s)
        return {"open": left, "out": F.when(any_closed, end["out"]).otherwise(s["out"]),
                "link": F.when(any_closed, end["link"]).otherwise(longer(s, t))}

    def step(s: Column, t: Column) -> Column:
        name, closing, inside = t["name"], t["closing"], s["inside"] > 0
        nests = name.isin(*listing.nesting)
        up = F.when(nests & (s["level"] > 0), s["level"] - 1).otherwise(s["level"])
        down = F.when(nests, s["level"] + 1).otherwise(s["level"])
        begin = state(s, inside=F.lit(1), level=F.lit(0))
        nested = state(s, inside=s["inside"] + F.when(name == listing.container, 1).otherwise(0), level=down,
                       link=longer(s, t))
        over = (name == listing.container) & (s["inside"] == 1)
        done = state(s, inside=F.lit(-1), open=F.filter(s["open"], lambda r: F.lit(False)), **ended(s))
        leave = state(s, inside=s["inside"] - F.when(name == listing.container, 1).otherwise(0), level=up,
                      **closed(s, t, lambda r: (r["level"] < s["level"]) | ~nests | (s["level"] == 0)))
        fresh = closed(s, t, lambda r: r["level"] != s["level"])
        row = F.struct((s["rows"] + 1).alias("row"), s["level"].alias("level"), F.lit(False).alias("named"))
        new_row = state(s, rows=s["rows"] + 1, **(fresh | {"open": F.concat(fresh["open"], F.array(row))}))
        end_row = state(s, **closed(s, t, lambda r: r["level"] < s["level"]))
        unnamed = F.transform(F.filter(s["open"], lambda r: ~r["named"]), lambda r: r["row"])
        all_named = F.transform(s["open"], lambda r: F.struct(r["row"].alias("row"), r["level"].alias("level"), F.lit(True).alias("named")))
        before = ended(s)
        new_link = state(s, open=all_named, out=before["out"], waiting=unnamed,
                         link=F.when(F.size(unnamed) > 0, _text(t)))
        more_text = state(s, link=longer(s, t))
        end_link = state(s, **ended(s))
        return (F.when(s["inside"] == 0, F.when(t["fit"], begin).otherwise(s))
                .when(~inside, s)
                .when((name == listing.row) & ~closing, new_row)
                .when((name == listing.row) & (F.size(F.filter(s["open"], lambda r: r["level"] == s["level"])) > 0), end_row)
                .when((name == "a") & ~closing, new_link)
                .when(name == "a", end_link)
                .when(((name == listing.container) | nests) & ~closing, nested)
                .when(over & closing, done)
                .when((name == listing.container) | nests, leave)
                .otherwise(more_text))

    return step


def first_links(html: Column, listing: Listing) -> Column:
    """``row`` (from 1) and raw text of the first link of each row that has one, by row."""
    start = F.from_json(F.lit('{"inside":0,"level":0,"rows":0,"open":[],"link":null,"waiting":[],"out":[]}'), _STATE)

    def finish(s: Column) -> Column:
        unended = F.when(s["link"].isNotNull(), F.transform(s["waiting"], lambda r: F.struct(r.alias("row"), s["link"].alias("link"))))
        return F.array_sort(F.concat(s["out"], F.coalesce(unended, F.array().cast("array<struct<row:int,link:string>>"))))

    return F.aggregate(_tokens(html, listing), start, lambda s, t: _step(listing)(s, t).cast(_STATE), finish)
