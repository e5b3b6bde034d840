"""Harvesters: tables of attributes, ratings, listings and links out of landed pages.

All of them work inside one row with built-in functions; none shuffles before its result needs it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.arrays import bind
from shelfwise.functions.text import WHITESPACE, extract_or_null, normalize_label, plain_blanks, strip
from shelfwise.operators.links import host_of
from shelfwise.rules import (
    ACCORDION_ROW, ACCORDION_SECTION, ACCORDION_TITLE, BULLET_ITEM, BULLET_LONGER_THAN, BULLETS_START, CHECK_MARKS, CROSS_MARKS,
)
from shelfwise.schemas import EAV_COLUMNS
from shelfwise.sources.markup import plain_text, tables_of, two_cell_rows, until_closed, without_unseen


# Marks that the values of icons and full texts leave in a page's text; `plain_blanks` has taken them out before.
_YES, _NO, _FULL = "\x1c", "\x1e", "\x1f"


def _marked(html: Column) -> Column:
    """Markup with a mark for each check and cross icon, told by name or drawing, and around each full form of a shortened text."""
    def icons(h: Column, mark: str, name: str, stroke: str) -> Column:
        named = F.when(F.contains(h, F.lit(name)), F.regexp_replace(h, rf"{name}[^>]*>", f">{mark}")).otherwise(h)
        drawing = rf'(?i)(<path\b[^>]*\sd="[^">]*){stroke.replace(".", "[.]")}[^>]*>'
        return bind(named, lambda n: F.when(F.contains(n, F.lit(stroke)), F.regexp_replace(n, drawing, f"$1>{mark}")).otherwise(n))

    def full_texts(h: Column) -> Column:
        marked = F.regexp_replace(h, r"(?is)<[^>]*a-truncate-full[^>]*>(.*?)</span>", f"{_FULL}$1{_FULL}")
        return F.when(F.contains(h, F.lit("a-truncate-full")), marked).otherwise(h)

    checked = bind(html, lambda h: icons(h, _YES, *CHECK_MARKS))
    return bind(bind(checked, lambda h: icons(h, _NO, *CROSS_MARKS)), full_texts)


def _cell_value(text: Column) -> Column:
    """Check and cross icons read as Yes and No; of a shortened text the full form is taken."""
    full = F.get(F.split(text, _FULL), F.lit(1))
    return F.when(F.contains(text, F.lit(_YES)), "Yes").when(F.contains(text, F.lit(_NO)), "No").otherwise(
        F.btrim(F.when(F.contains(text, F.lit(_FULL)), full).otherwise(text), F.lit(WHITESPACE))
    )


def _last_of_repeated(entries: Column) -> Column:
    """Of entries with the same kind and key: the position of the first and the value of the last."""
    ordered = F.array_sort(entries)

    def differs(e: Column, neighbour: Column) -> Column:
        return F.coalesce((e["kind"] != neighbour["kind"]) | (e["key"] != neighbour["key"]), F.lit(True))

    def deduplicated(rows: Column) -> Column:
        firsts = F.filter(rows, lambda e, i: differs(e, F.get(rows, i - 1)))
        lasts = F.filter(rows, lambda e, i: differs(e, F.get(rows, i + 1)))
        return F.zip_with(
            firsts, lasts,
            lambda f, e: F.struct(f["kind"].alias("kind"), f["ord"].alias("ord"), f["key"].alias("key"), e["value"].alias("value")),
        )

    # The one-element array binds the sorted entries, so they are sorted once.
    return F.transform(F.array(ordered), deduplicated)[0]


def harvest_specs(pages: DataFrame, drop: str = ":", heading: str | None = None) -> DataFrame:
    """Attributes from table rows of two cells: those of the first table are specs, those of later ones features.

    Rows belong to the table they stand in, and an inner table's rows count with the outermost one around them. A row
    with a table in one of its cells has more than two cells and gives nothing itself. Tables in comments, scripts,
    styles and templates are no tables. With `heading`, a pattern, only tables behind the first heading it matches count;
    a page without one has none.

    Blank values, `-` and `N/A` are dropped; of a repeated key the last value stays. A page is one
    row and repeats are settled inside it, so nothing is shuffled.
    """
    def pairs(table: Column) -> Column:
        return F.transform(
            two_cell_rows(table["own"]),
            lambda p: F.struct(
                F.when(table["top"] == 1, "specs").otherwise("features").alias("kind"),
                normalize_label(p["first"], drop).alias("key"),
                (table["at"].cast("bigint") * (1 << 24) + p["r"]).alias("ord"),
                _cell_value(p["second"]).alias("value"),
            ),
        )

    html = _marked(plain_blanks(without_unseen(F.col("html"))))
    if heading is not None:
        html = F.regexp_extract(html, rf"(?is)<h([1-6])\b[^>]*+>(?:(?!</h\1).)*?(?:{heading})(?:(?!</h\1).)*?</h\1>(.*+)", 2)
    kept = F.filter(
        F.flatten(F.transform(tables_of(html), pairs)), lambda e: ~e["key"].isin("", "_") & ~e["value"].isin("", "-", "N/A")
    )
    return pages.select("product_id", F.inline(_last_of_repeated(kept))).select(*EAV_COLUMNS)


def harvest_bullets(pages: DataFrame) -> DataFrame:
    """Feature bullets `feature_1`, `feature_2`, ... of the first list in the page's feature section.

    An item's number is its place in the list; items of ten characters or fewer are left out and keep their number.
    Inner lists belong to the list. All inside the page's row.
    """
    section = F.get(F.split(without_unseen(F.col("html")), BULLETS_START), F.lit(1))
    first = F.get(F.split(section, r"(?i)<ul\b[^>]*+>", 2), F.lit(1))
    items = bind(F.split(until_closed(first, "ul"), BULLET_ITEM), lambda i: F.slice(i, F.lit(2), F.size(i)))
    texts = F.transform(items, lambda item, i: F.struct(
        F.lit("features").alias("kind"), F.concat(F.lit("feature_"), (i + 1).cast("string")).alias("key"), i.cast("bigint").alias("ord"),
        plain_text(until_closed(item, "span")).alias("value"),
    ))
    long_enough = F.filter(texts, lambda t: F.length(t["value"]) > BULLET_LONGER_THAN)
    return pages.select("product_id", F.inline(long_enough)).select(*EAV_COLUMNS)


def harvest_sections(
    pages: DataFrame, section: str = ACCORDION_SECTION, title: str = ACCORDION_TITLE, row: str = ACCORDION_ROW,
) -> DataFrame:
    """Attributes from sections of `div` rows: product_id, section, section_ord, ord, key, value, one row each.

    `section` begins a section, `title` holds its name, `row` its key and value. Rows with a blank key or value are
    dropped. `flatten_sections` makes one level of the result. All inside the page's row.
    """
    parts = F.split("html", section)
    parts = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))

    def label(html: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(F.lower(plain_text(html)), "[^a-z0-9]+", "_"), "^_|_$", "")

    def rows(part: Column, s: Column) -> Column:
        name = label(F.regexp_extract(part, title, 1))
        pairs = F.arrays_zip(F.regexp_extract_all(part, F.lit(row), F.lit(1)).alias("k"), F.regexp_extract_all(part, F.lit(row), F.lit(2)).alias("v"))
        return F.transform(
            pairs,
            lambda p, r: F.struct(
                F.when(name == "", "unknown").otherwise(name).alias("section"), s.cast("bigint").alias("section_ord"), r.cast("bigint").alias("ord"),
                label(p["k"]).alias("key"), plain_text(p["v"]).alias("value"),
            ),
        )

    found = F.filter(F.flatten(F.transform(parts, rows)), lambda e: ~e["key"].isin("", "_") & (e["value"] != ""))
    return pages.select("product_id", F.inline(found))


_AGGREGATE = "aggregateRating struct<ratingValue:string,reviewCount:string>, review array<struct<reviewBody:string>>"


def harvest_jsonld(pages: DataFrame) -> DataFrame:
    """Rating, count and review bodies of the first structured-data block with an aggregate rating."""
    blocks = F.regexp_extract_all("html", F.lit(r'(?is)<script type="application/ld\+json">(.*?)</script>'), F.lit(1))
    rated = F.filter(blocks, lambda b: F.get_json_object(b, "$.aggregateRating").isNotNull())
    parsed = pages.select("product_id", F.get(rated, F.lit(0)).alias("_block")).where("_block is not null").withColumn(
        "_data", F.from_json("_block", _AGGREGATE)
    )
    bodies = F.filter(F.transform("_data.review", lambda r: r["reviewBody"]), lambda b: F.length(b) > 10)
    return parsed.select(
        "product_id",
        F.concat("_data.aggregateRating.ratingValue", F.lit("/5")).alias("rating_text"),
        extract_or_null(F.col("_data.aggregateRating.reviewCount"), r"^\s*(\d+)").cast("bigint").alias("count"),
        F.coalesce(bodies, F.array().cast("array<string>")).alias("reviews"),
    )


def _element_text(html: Column, marker: str) -> Column:
    return extract_or_null(html, rf"(?is)<[^>]*{marker}[^>]*>([^<]*)<")


def harvest_ratings(pages: DataFrame) -> DataFrame:
    """Rating and review count from page markup, by the first marker that holds text."""
    html = F.col("html")
    rating = F.coalesce(
        extract_or_null(strip(_element_text(html, 'itemprop="ratingValue"')), r"([\d.]+)"),
        extract_or_null(html, r'(?is)itemprop="ratingValue" content="([\d.]+)"'),
        extract_or_null(strip(_element_text(html, 'data-hook="rating-out-of-text"')), r"^([\d.]+)"),
    )
    count = F.coalesce(
        extract_or_null(_element_text(html, 'itemprop="reviewCount"'), r"(\d+)"),
        extract_or_null(html, r'(?is)itemprop="reviewCount" content="(\d+)'),
        F.nullif(F.regexp_replace(_element_text(html, 'id="acrCustomerReviewText"'), "[^0-9]", ""), F.lit("")),
    )
    return pages.select("product_id", rating.try_cast("double").alias("rating"), count.try_cast("bigint").alias("count"))


def harvest_listing(pages: DataFrame, origin: str) -> DataFrame:
    """Product cards (name, price text, link); cards without a name or a price are dropped."""
    def read(card: Column, position: Column) -> Column:
        name = strip(F.regexp_replace(plain_text(F.regexp_extract(card, r"(?is)<h3>(.*?)</h3>", 1)), r"\n+", " "))
        price = plain_text(F.regexp_extract(card, r'(?is)<span class="price">(.*?)</span>', 1))
        href = extract_or_null(card, r'(?is)<a [^>]*href="([^"]*)"')
        return F.struct(
            position.alias("position"), name.alias("name"),
            strip(F.regexp_replace(price, "(?i)View retailers?", "")).alias("price_text"),
            F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(origin), href)).alias("link"),
        )

    cards = F.transform(F.regexp_extract_all("html", F.lit(r'(?is)<li class="item">(.*?)</li>'), F.lit(1)), read)
    return pages.select("page_id", F.inline(F.filter(cards, lambda c: (c["name"] != "") & (c["price_text"] != ""))))


def page_count(pages: DataFrame) -> DataFrame:
    """Number N of a `Page x of N` mark."""
    return pages.withColumn("pages", extract_or_null(F.col("html"), r"(?i)Page\s+\d+\s+of\s+(\d+)").cast("int"))


def title_words(label: Column) -> Column:
    """Title case that also starts anew behind a hyphen."""
    return F.array_join(F.transform(F.split(F.lower(label), "-"), F.initcap), "-")


def harvest_links(pages: DataFrame, n: int = 20) -> DataFrame:
    """Links among the first `n` result items of a page: url, title, first pound price, source name."""
    items = F.slice(F.regexp_extract_all("html", F.lit(r"(?is)<li\b[^>]*>(.*?)</li>"), F.lit(1)), 1, n)
    item = F.col("_item")
    price = extract_or_null(plain_text(item), r"£\s*(\d{1,3}(?:,\d{3})*(?:\.\d{2})?)")
    return (
        pages.select("page_id", F.posexplode(items).alias("position", "_item"))
        .select(
            "page_id", "position",
            extract_or_null(item, r'(?is)<a [^>]*href="(http[^"]*)"').alias("url"),
            plain_text(F.regexp_extract(item, r"(?is)<a [^>]*>(.*?)</a>", 1)).alias("title"),
            F.concat(F.lit("£"), price).alias("price"),
        )
        .where("url is not null")
        .withColumn("source_name", title_words(F.split(F.replace(host_of(F.col("url")), F.lit("www."), F.lit("")), r"\.")[0]))
    )
