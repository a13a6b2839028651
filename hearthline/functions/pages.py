"""Fields of stored pages, as column expressions: only the markup named here is read.

A page is cut into tags, texts, comments and scripts once. An element ends where the tags of its name
that open and close behind its own come to one more close (an unclosed one at the end of its page), so
inner elements of the same name, and markup in comments and scripts, do no harm. Class and attribute
values may be in single or double quotes and in any attribute order.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import address
from .values import money, staged

# Markup of listing and search pages.
SEARCH_CONTAINER = "DesktopBlueprintSearchPage__pageContainer"
CARD = "mapHomeCard"
ADDRESS_CLASSES = ["full-address addressBannerRevamp street-address", "streetAddress addressBannerRevamp", "full-address street-address"]
STATUS_CLASSES = ["ListingStatusBannerSection", "rental-status"]
READY_PHRASE = "ready to build"
_ENTITIES = {"&nbsp;": " ", "&mdash;": "—", "&quot;": '"', "&#39;": "'", "&lt;": "<", "&gt;": ">", "&amp;": "&"}
JS_EVENT = "struct<eventDateString: string, eventDate: bigint, eventDescription: string, price: double, sourceId: string, source: string>"


_PIECE = r"""(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|</?[a-z](?:[^>"']+|"[^"]*"|'[^']*')*+>|</?[a-z!][^>]*>|[^<]+|<"""
_CUT, _NAME = re.compile(_PIECE, re.A), re.compile(r"</?([A-Za-z][\w-]*)", re.A)
_FITS: dict[str, dict[str, bool]] = {}  # short tags by opening: pages of one site repeat theirs


def extract(text: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match; no match or an empty one gives null."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def text_of(fragment: Column) -> Column:
    """Without tags, with the common entities decoded, stripped; empty gives null."""
    plain = F.regexp_replace(fragment, "<[^>]*>", "")
    for entity, char in _ENTITIES.items():
        plain = F.replace(plain, F.lit(entity), F.lit(char))
    return F.nullif(F.btrim(plain, F.lit(" \t\r\n ")), F.lit(""))


def pieces(html: Column) -> Column:
    """The page as an array of tags, texts, comments, whole scripts and whole styles."""
    return F.regexp_extract_all(html, F.lit(_PIECE), F.lit(0))


def tag(attribute: str, value: str, name: str = r"\w+") -> str:
    """Pattern of an opening tag by words in a row in one of its attributes."""
    return rf"(?is)^<{name}\b(?=[^>]*\s{attribute}=[\"'](?:[^\"']*\s)?{value}(?:\s[^\"']*)?[\"'])"


def _class(value: str, name: str = r"\w+") -> str:
    return tag("class", value, name)


def _named(name: str) -> str:
    return rf"(?i)^<{name}\b"


def _elements(parts: list[str], opening: str) -> list[str]:
    """Contents of the elements whose opening tag fits, in order, without those inside of another, in one pass."""
    found, lo, name, depth = [], 0, "", 0
    fits, known = re.compile(opening, re.A).match, _FITS.setdefault(opening, {})
    for i, p in enumerate(parts, 1):
        if p[0] != "<":
            continue
        if not lo:
            if (opens := known.get(p)) is None:
                opens = bool(fits(p))
                if len(p) < 200 and len(known) < 20_000:
                    known[p] = opens
            if opens:
                if p.endswith("/>"):
                    found.append("")
                else:
                    lo, name, depth = i, _name(p), 0
        elif (_name(p) if len(p) < 200 else _name.__wrapped__(p)) == name:
            if p[1] != "/":
                depth += not p.endswith("/>")
            elif depth:
                depth -= 1
            else:
                found.append("".join(parts[lo : i - 1]))
                lo = 0
    return [*found, "".join(parts[lo:])] if lo else found


@functools.lru_cache(20_000)
def _name(piece: str) -> str:
    named = _NAME.match(piece)
    return named[1].lower() if named else ""


def _along(parts: list[str], path: list) -> list[str]:
    """Elements that fit the last pattern, within all elements that fit the ones before (of ``(pattern,)`` the first)."""
    for opening in path[:-1]:
        only = isinstance(opening, tuple)
        outer = _elements(parts, opening[0] if only else opening)
        parts = _CUT.findall("".join(outer[:1] if only else outer))
    return _elements(parts, path[-1])


def elements(html: Column, paths: dict[str, list], rows: dict[str, tuple[list, dict[str, list]]] | None = None) -> Column:
    """Struct of the contents of elements by their paths, cut once a page: arrays for ``paths``, and for each of ``rows``
    (a path and further paths by name) an array of structs with the arrays found within each of its elements.
    A path is a list of patterns of opening tags, each within the elements of the one before."""
    rows = rows or {}

    def read(page: str | None):
        if page is None:
            return None
        parts = _CUT.findall(page)
        inside = [[{n: _along(own, p) for n, p in fields.items()} for own in map(_CUT.findall, _along(parts, path))] for path, fields in rows.values()]
        return (*[_along(parts, path) for path in paths.values()], *inside)

    many = "array<string>"
    kinds = [f"{n}: {many}" for n in paths] + [f"{n}: array<struct<{', '.join(f'{c}: {many}' for c in fields)}>>" for n, (_, fields) in rows.items()]
    return F.udf(read, f"struct<{', '.join(kinds)}>", useArrow=False)(html)


def _first(found: Column) -> Column:
    return F.get(found, F.lit(0))


def meta(html: Column, name: str) -> Column:
    quoted = name.replace(".", r"\.")
    before, behind = rf"<meta[^>]*\bname=[\"']{quoted}[\"'][^>]*\bcontent=[\"']([^\"']*)", rf"<meta[^>]*\bcontent=[\"']([^\"']*)[\"'][^>]*\bname=[\"']{quoted}[\"']"
    return F.coalesce(extract(html, before), extract(html, behind))


def links(html: Column) -> Column:
    """All link targets of a page, in order, distinct."""
    return F.array_distinct(F.regexp_extract_all(html, F.lit(r"<a\s[^>]*?href=[\"']([^\"']*)"), F.lit(1)))


def card_links(html: Column) -> Column:
    """Distinct link targets inside the result cards of a search page."""
    cards = elements(html, {"cards": [(tag("id", SEARCH_CONTAINER),), tag("data-rf-test-name", CARD)]})["cards"]
    return F.coalesce(links(F.array_join(cards, "\n")), F.array().cast("array<string>"))


def absolute(link: Column, page_url: Column) -> Column:
    """A link as an absolute URL: absolute, root-relative and path-relative targets."""
    origin, folder = F.regexp_extract(page_url, r"^(\w+://[^/?#]+)", 1), F.regexp_extract(page_url, r"^(\w+://[^/?#]+(?:/[^?#]*/|/)?)", 1)
    return F.when(link.rlike(r"^\w+://"), link).when(link.startswith("/"), F.concat(origin, link)).otherwise(F.concat(F.regexp_replace(folder, "([^/])$", "$1/"), link))


def property_links(pages: DataFrame) -> DataFrame:
    """(property_url, from_page_url), distinct over all pages: links to homes, made absolute."""
    rows = pages.select(F.col("url").alias("from_page_url"), F.explode(card_links(F.col("html"))).alias("link")).where(F.col("link").contains("/home/"))
    return rows.groupBy(absolute(F.col("link"), F.col("from_page_url")).alias("property_url")).agg(F.min("from_page_url").alias("from_page_url"))


def listing_id(url: Column) -> Column:
    """The path segment behind the first ``home`` segment."""
    parts = F.split(F.regexp_replace(url, r"[?#].*$", ""), "/")
    at = F.array_position(parts, "home")
    return F.when(at > 0, F.nullif(F.try_element_at(parts, (at + 1).cast("int")), F.lit("")))


def page_zip(zip_code: Column, address_text: Column) -> Column:
    last = F.regexp_replace(F.element_at(F.split(F.trim(address_text), r"\s+"), -1), "^[,.]+|[,.]+$", "")
    return F.coalesce(zip_code, F.nullif(last, F.lit("")), F.lit("unknown"))


def url_zip(url: Column, meta_zip: Column) -> Column:
    return F.coalesce(extract(url, "/zipcode/([^/?#]+)"), meta_zip)


def page_number(url: Column) -> Column:
    """The last ``/page-N`` of the path, else 1."""
    return F.coalesce(extract(url, r"^.*/page-(\d+)").try_cast("int"), F.lit(1))


def next_page(html: Column, number: Column) -> Column:
    """The first link that contains the next page's path; a test by substring, as page 1 also finds /page-20."""
    return F.try_element_at(F.filter(links(html), lambda x: F.contains(x, F.concat(F.lit("/page-"), (number + 1).cast("string")))), F.lit(1))


def _number_and_unit(text: Column, unit: str | None) -> Column:
    """``2,178 sq ft`` as ``2178.0 sqft``; without a unit square feet are meant."""
    parts = F.split(F.trim(F.replace(text, F.lit(","), F.lit(""))), " ")
    number = F.try_element_at(parts, F.lit(1)).try_cast("double")
    named = F.lit(unit) if unit else F.when(F.size(parts) >= 2, F.array_join(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), "")).otherwise("sq ft")
    return F.when(number.isNotNull(), F.concat_ws(" ", number.cast("string"), named))


def _texts(html: Column) -> Column:
    """Texts of a listing page, one struct: candidates for the address, the banner, the rows of key details, the lot of
    the public facts, and the history rows."""
    span, any_order = _named("span"), r"(?is)^<\w+\b(?=[^>]*\sclass=[\"'](?:[^\"']*\s)?price-col[\s\"'])(?=[^>]*\sclass=[\"'](?:[^\"']*\s)?number[\s\"'])"
    paths = {f"address{k}": [_class(c)] for k, c in enumerate(ADDRESS_CLASSES)} | {"address_div": [tag("data-rf-test-name", "street-address", "div")]}
    paths |= {f"status{k}": [_class(c)] for k, c in enumerate(STATUS_CLASSES)}
    rows = {
        "details": ([_class("keyDetails-row")], {"label": [_class("valueType")], "value": [_class("valueText")]}),
        "facts": ([_class("entryItem", "li")], {"label": [_class("entryItemContent")], "spans": [span], "inner": [(span,), span]}),
        "history": ([_class("PropertyHistoryEventRow")], {"date": [_class("col-4"), _named("p")], "what": [_class("description-col"), _class("col-4"), _named("div")], "price": [any_order], "note": [_class("description-col"), _class("subtext", "p")]}),
    }
    return elements(html, paths, rows)


def key_detail(found: Column, label: str) -> Column:
    """The value of the first key-detail row whose label contains ``label``."""
    mine = F.filter(found["details"], lambda r: F.coalesce(F.contains(text_of(_first(r["label"])), F.lit(label)), F.lit(False)))
    return text_of(_first(_first(mine)["value"]))


def public_lot(found: Column) -> Column:
    """Of the first public fact that names the lot: its second span in the order of the opening tags, one inside the
    first or the one behind it."""
    fact = _first(F.filter(found["facts"], lambda r: F.coalesce(F.contains(text_of(_first(r["label"])), F.lit("Lot Size:")), F.lit(False))))
    return text_of(F.coalesce(_first(fact["inner"]), F.get(fact["spans"], F.lit(1))))


def lot_size(detail: Column, fact: Column) -> Column:
    """Of the key details, else of the public facts."""
    shown = lambda v: F.when(v != "—", _number_and_unit(v, None))
    return F.coalesce(shown(detail), shown(fact))


def status_text(found: Column) -> Column:
    return F.lower(F.coalesce(*[text_of(_first(found[f"status{k}"])) for k in range(len(STATUS_CLASSES))]))


def ready_to_build(html: Column, year: Column) -> Column:
    told = F.contains(F.lower(html), F.lit(READY_PHRASE))  # most pages need no cutting
    return F.when(year.isNull() & told, F.exists(pieces(html), lambda p: p.rlike(_named("script")) & F.contains(F.lower(p), F.lit(READY_PHRASE)))).otherwise(False)


def embedded_events(html: Column) -> Column:
    """Events of the embedded history object; null without one or if it is not JSON. Epoch dates are UTC."""
    json = F.replace(extract(html, r"(?s)propertyHistoryInfo[^{]*(\{.*)"), F.lit('\\"'), F.lit('"'))
    events = F.from_json(json, f"events array<{JS_EVENT}>")["events"]

    def raw(e: Column) -> Column:
        date = F.coalesce(e["eventDateString"], F.date_format(F.timestamp_millis(e["eventDate"]), "MMM dd, yyyy"))
        return F.struct(date.alias("date"), e["eventDescription"].alias("description"), e["price"].alias("price"), e["source"].alias("source"), e["sourceId"].alias("mlsNumber"))

    return F.filter(F.transform(events, raw), lambda e: F.coalesce(e["date"], F.lit("")) != "")


def row_events(found: Column) -> Column:
    """Events of the history rows; they name no source, so the record is rejected later on."""

    def raw(r: Column) -> Column:
        price = money(F.nullif(text_of(_first(r["price"])), F.lit("—"))).cast("double")
        note = text_of(_first(r["note"]))
        number = F.when(F.contains(note, F.lit("MLS")), extract(note, r"#(\d+)"))
        return F.struct(text_of(_first(r["date"])).alias("date"), text_of(_first(r["what"])).alias("description"), price.alias("price"), F.lit(None).cast("string").alias("source"), number.alias("mlsNumber"))

    return F.filter(F.transform(found["history"], raw), lambda e: e["date"].isNotNull())


def raw_records(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored pages (url, html, optional zip_code, scraped_at, property_id) to (raw records, rejects)."""
    html = F.col("html")
    extra = {c: F.lit(None).cast("string") for c in ("zip_code", "scraped_at", "property_id") if c not in pages.columns}
    df, found = pages.withColumns(extra | {"_found": _texts(html)}), F.col("_found")
    candidates = [text_of(_first(found[c])) for c in [f"address{k}" for k in range(len(ADDRESS_CLASSES))] + ["address_div"]]
    tried = []
    for k, candidate in enumerate(candidates):
        df = address.standardise(df.withColumn(f"_c{k}", candidate), f"_c{k}", f"_p{k}")
        tried.append(F.when(F.col(f"_p{k}").isNotNull(), F.col(f"_c{k}")))
    df = staged(df.drop("address", "status", "year_built"), {"address": F.coalesce(*tried), "status": status_text(found), "year_built": key_detail(found, "Year Built").try_cast("int"), "_lot": key_detail(found, "Lot Size"), "_fact": public_lot(found), "_js": embedded_events(html)})
    history = F.when(F.size("_js") > 0, F.col("_js")).otherwise(row_events(found))
    code = F.when(listing_id(F.col("url")).isNull(), "InvalidListingUrl").when(F.col("address").isNull(), "AddressNotFound").when(F.col("status").isNull(), "StatusNotFound")
    df = staged(df, {"_error": code, "_history": history})
    good = df.where("_error is null").select(
        "url", listing_id(F.col("url")).alias("data_source_id"), "scraped_at", "address", page_zip(F.col("zip_code"), F.col("address")).alias("zip_code"),
        _number_and_unit(meta(html, "twitter:text:sqft"), "sqft").alias("area"), key_detail(found, "Property Type").alias("property_type"), lot_size(F.col("_lot"), F.col("_fact")).alias("lot_area"),
        meta(html, "twitter:text:beds").try_cast("double").alias("bedrooms"), meta(html, "twitter:text:baths").try_cast("double").alias("bathrooms"), "year_built", "status",
        money(meta(html, "twitter:text:price")).cast("double").alias("price"), ready_to_build(html, F.col("year_built")).alias("ready_to_build"), "property_id", F.col("_history").alias("history"), F.size("_history").alias("history_count"),
    )
    bad = df.where("_error is not null").select(F.sha2("url", 256).alias("record_key"), F.lit("page").alias("stage"), F.col("_error").alias("error_code"), F.lit("the page lacks a required field").alias("message"), F.col("url").alias("payload"))
    return good, bad
