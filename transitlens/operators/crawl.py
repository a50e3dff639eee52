"""Operators over crawl output (tables of fetched pages and fetch results).

Fixed values: link text is cleaned by trimming and removing the literal
newline-plus-six-tabs sequence the route listing pages wrap names in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitlens.operators.dimension import bounded_broadcast
from transitlens.operators.tags import NAV_LIST, ROUTE_TABLE, Listing, first_links
from transitlens.schemas import STOP_LIST_TYPE

__all__ = ["NAV_LIST", "ROUTE_TABLE", "decode_references", "dedupe_keep_first", "extract_route_names",
           "fetch_outcome_counts", "latest_stop_lists", "pages_before_first_empty", "stop_fetch_records",
           "unify_fetch_results"]

WRAP = "\n\t\t\t\t\t\t"
EDGE_SPACE = r"^[ \t\n\x0B\f\r ]+|[ \t\n\x0B\f\r ]+$"  # spaces, controls, no-break space
# The named character references of Latin-1 letters and common signs.
REFERENCES = {
    "nbsp": " ", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&",
    "aacute": "á", "eacute": "é", "iacute": "í", "oacute": "ó", "uacute": "ú", "ntilde": "ñ", "uuml": "ü",
    "Aacute": "Á", "Eacute": "É", "Iacute": "Í", "Oacute": "Ó", "Uacute": "Ú", "Ntilde": "Ñ", "Uuml": "Ü",
    "agrave": "à", "egrave": "è", "acirc": "â", "ecirc": "ê", "ccedil": "ç", "auml": "ä", "ouml": "ö", "szlig": "ß",
    "iexcl": "¡", "iquest": "¿", "deg": "°", "ordm": "º", "ordf": "ª", "middot": "·", "copy": "©", "reg": "®",
    "ndash": "–", "mdash": "—", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”", "hellip": "…", "bull": "•",
    "laquo": "«", "raquo": "»", "euro": "€", "times": "×",
}


def decode_references(text: Column) -> Column:
    """Named, decimal and hexadecimal character references decoded once; unknown ones stay."""
    names = F.create_map(*[F.lit(x) for pair in REFERENCES.items() for x in pair])

    def one(ref: Column) -> Column:
        body = F.regexp_extract(ref, r"^&#?[xX]?([^;]*);$", 1)
        code = (F.when(ref.rlike(r"^&#[0-9]{1,7};$"), body.try_cast("int"))
                .when(ref.rlike(r"^&#[xX][0-9a-fA-F]{1,6};$"), F.conv(body, 16, 10).try_cast("int")))
        # four bytes per code point, big-endian
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        valid = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        return F.when(valid, char).otherwise(F.coalesce(F.try_element_at(names, body), ref))

    # text between references and the references alternate: a split keeps both in order
    parts = F.regexp_extract_all(text, F.lit(r"(?s)&#?[a-zA-Z0-9]{1,31};|[^&]+|&"), F.lit(0))
    whole = F.transform(parts, lambda p: F.when(p.rlike("^&.+;$"), one(p)).otherwise(p))
    return F.when(F.contains(text, F.lit("&")), F.array_join(whole, "")).otherwise(text)


def extract_route_names(pages: DataFrame, listing: Listing = ROUTE_TABLE,
                        html_col: str = "html", id_col: str = "page_id") -> DataFrame:
    """(page id, pos, route): per row of the listing's container, the first link's text.

    Tags are scanned as an HTML parser reads them (``operators.tags``); nested
    rows count as rows of their own. Character references are decoded,
    surrounding whitespace (including non-breaking spaces) stripped, the
    listing's wrap sequence removed and blanks dropped; ``pos`` is the 1-based
    row position in the container. A page without the container yields no rows.
    """
    # Pages without such a tag, most of a crawl, are not cut into tokens.
    likely = pages.where(F.col(html_col).rlike(rf"(?i)<{listing.container}[\s/>]"))
    ex = likely.select(F.col(id_col), F.inline(first_links(F.col(html_col), listing)).alias("pos", "link"))
    text = F.replace(F.regexp_replace(decode_references(F.col("link")), EDGE_SPACE, ""), F.lit(WRAP), F.lit(""))
    return ex.select(F.col(id_col), "pos", text.alias("route")).filter(F.length("route") > 0)


def pages_before_first_empty(df: DataFrame, type_col: str, idx_col: str, n_col: str) -> DataFrame:
    """Per type, the pages whose index precedes the first page with no routes.

    The first empty index per type is a grouped minimum (one row per type,
    size-checked before broadcast), joined back instead of a window per type.
    """
    first_empty = (df.filter(F.col(n_col) == 0).groupBy(type_col)
                   .agg(F.min(idx_col).alias("_first_empty")))
    fe, _ = bounded_broadcast(first_empty)
    j = df.join(fe, type_col, "left")
    return j.filter(F.col("_first_empty").isNull() | (F.col(idx_col) < F.col("_first_empty"))).drop("_first_empty")


def dedupe_keep_first(df: DataFrame, key: str, seq_cols) -> DataFrame:
    """One row per key with the earliest (lexicographic) sequence position."""
    seq_cols = [seq_cols] if isinstance(seq_cols, str) else list(seq_cols)
    first = F.min(F.struct(*[F.col(c) for c in seq_cols])).alias("_first")
    g = df.filter(F.col(key).isNotNull()).groupBy(key).agg(first)
    return g.select(key, *[F.col(f"_first.{c}").alias(c) for c in seq_cols])


def unify_fetch_results(ok: DataFrame, err: DataFrame) -> DataFrame:
    """Success and error records under one schema; absent fields are null."""
    return ok.unionByName(err, allowMissingColumns=True)


def stop_fetch_records(ok: DataFrame, err: DataFrame) -> DataFrame:
    """Stop lists fetched and fetches failed under one schema: ``ruta, paradas, timestamp, error``.

    A failed fetch has an empty list and its error, a fetched one no error; a
    list missing on either side is empty, columns beyond the schema are dropped.
    """
    def shaped(df: DataFrame) -> DataFrame:
        paradas = F.col("paradas").cast(STOP_LIST_TYPE) if "paradas" in df.columns else F.lit(None).cast(STOP_LIST_TYPE)
        error = F.col("error") if "error" in df.columns else F.lit(None).cast("string")
        return df.select("ruta", F.coalesce(paradas, F.array().cast(STOP_LIST_TYPE)).alias("paradas"),
                         F.col("timestamp").cast("double").alias("timestamp"), error.alias("error"))

    return shaped(ok).unionByName(shaped(err))


def latest_stop_lists(records: DataFrame) -> DataFrame:
    """Per route, the last stop list that was fetched without an error and is not empty (ties: the longer, then the greater list)."""
    good = records.filter(F.col("error").isNull() & (F.size("paradas") > 0) & F.col("ruta").isNotNull())
    best = F.max(F.struct("timestamp", F.size("paradas").alias("n"), F.array_sort("paradas").alias("paradas")))
    return good.groupBy("ruta").agg(best.alias("b")).select("ruta", "b.paradas", "b.timestamp")


def fetch_outcome_counts(df: DataFrame, payload: str = "gps_data") -> DataFrame:
    """One row: routes fetched with a non-empty payload, routes failed (null
    success counts as failed), total records."""
    dt = df.schema[payload].dataType.simpleString()
    if dt == "string":
        size = F.coalesce(F.json_array_length(F.col(payload)), F.lit(0))
    else:
        size = F.coalesce(F.size(F.col(payload)), F.lit(0))
    ok = F.coalesce(F.col("success"), F.lit(False))
    return df.agg(F.count_if(ok & (size > 0)).alias("routes_with_gps"),
                  F.count_if(~ok).alias("routes_failed"),
                  F.count(F.lit(1)).alias("routes_total"))
