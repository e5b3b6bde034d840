"""Catalog rows: prices, brands, slugs, categories, loading and link refresh."""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.tables import dense_ids, first_by, rule_table
from shelfwise.functions.text import extract_or_null, is_numeric_text, strip
from shelfwise.operators.matching import first_prefix
from shelfwise.rules import (
    BRANDS, FILE_CATEGORIES, MODEL_CASCADE, QUERY_CATEGORY_TERMS, QUERY_MODEL_CASCADE, SIZE_WORD,
)
from shelfwise.schemas import IMAGES, LINK

# --- prices -------------------------------------------------------------------------------------


def price_value(text: Column, mode: str = "load") -> Column:
    """`listing`: leading number or 0; `load`: whole text as number or null; `legacy`: or 0."""
    if mode == "listing":
        number = extract_or_null(F.translate(text, "£,", ""), r"^(\d+(?:\.\d+)?)").cast("double")
        return F.coalesce(number, F.lit(0.0))
    if mode not in ("load", "legacy"):
        raise ValueError(f"unknown price mode {mode!r}")
    cleaned = F.translate(text, "£$," if mode == "load" else "£,", "")
    number = F.when(is_numeric_text(cleaned), strip(cleaned).cast("double"))
    return number if mode == "load" else F.coalesce(number, F.lit(0.0))


def clean_prices(df: DataFrame, mode: str = "load", column: str = "price_text") -> DataFrame:
    return df.withColumn("price", price_value(F.col(column), mode))


def price_rejects(df: DataFrame, mode: str = "load", column: str = "price_text") -> DataFrame:
    """Rows whose price text could not be read."""
    failed = F.col("price").isNull() | (F.col("price") == 0)
    return clean_prices(df, mode, column).where(failed)


# --- names --------------------------------------------------------------------------------------


def split_brand_model(products: DataFrame, brands: list[str] | DataFrame = BRANDS, strict: bool = False) -> DataFrame:
    """Adds `brand` and `model`: first listed brand that starts the name, else the first word.

    `brands` is a list, looked through inside the row, or a table (brand, ord) of any size, which is joined. `strict` asks for
    a word boundary behind the brand; without it `Sharpener` starts with `Sharp`.
    """
    name = F.col("name")
    if isinstance(brands, DataFrame):
        # Of brands that differ in case only, the first one's spelling is used.
        spelled = brands.groupBy(F.lower("brand").alias("pattern")).agg(F.min_by("brand", "ord").alias("_brand"), F.min("ord").alias("ord"))
        found = first_prefix(products.select(F.lower("name").alias("text")), spelled, whole_words=strict)
        known = found.select("text", "pattern").join(spelled, "pattern").select("text", "_brand")
        split = products.join(known, F.lower(products["name"]) == F.col("text"), "left").drop("text")
    else:
        listed = F.array(*[F.struct(F.lit(b.lower()).alias("start"), F.lit(b).alias("brand")) for b in brands or [""]])

        def begins(b: Column) -> Column:
            hit = F.startswith(F.lower(name), b["start"]) & (b["start"] != "")
            return hit & ~F.substring(name, F.length(b["start"]) + 1, F.lit(1)).rlike("[A-Za-z0-9]") if strict else hit

        split = products.withColumn("_brand", F.get(F.filter(listed, begins), F.lit(0))["brand"])
    brand, parts = F.col("_brand"), F.split(name, " ", 2)
    two = F.size(parts) == 2
    rest = strip(F.substring(name, F.length(brand) + 1, F.length(name)))
    return split.withColumns({
        "brand": F.coalesce(brand, F.when(two, parts[0]).otherwise(name)),
        "model": F.when(brand.isNotNull(), rest).when(two, F.get(parts, F.lit(1))).otherwise(name),
    }).drop("_brand")


def _cascade(text: Column, patterns: list[str], group: int) -> Column:
    return F.coalesce(*[extract_or_null(text, p, group) for p in patterns])


def extract_model(products: DataFrame) -> DataFrame:
    """Adds `brand_word` (first word) and `model_number` (first pattern that matches the upper-cased name)."""
    return products.withColumns({
        "brand_word": F.lower(F.get(F.split(strip("name"), r"\s+"), F.lit(0))),
        "model_number": F.coalesce(_cascade(F.upper("name"), MODEL_CASCADE, 0), F.lit("")),
    })


def build_queries(products: DataFrame, category_terms: dict[str, str] = QUERY_CATEGORY_TERMS) -> DataFrame:
    """Adds `target_model` and `search_query`; needs `name` and `category` (slug)."""
    spark = products.sparkSession
    terms = rule_table(spark, {"category": list(category_terms), "_term": list(category_terms.values())})
    words = F.split(strip(F.col("name")), r"\s+")
    model = F.col("target_model")

    def not_size(w: Column) -> Column:
        return ~w.rlike(SIZE_WORD)

    head = F.filter(F.slice(words, 1, 3), lambda w: not_size(w) & ~F.coalesce(F.contains(w, model), F.lit(False)))
    more = F.filter(F.slice(words, 4, 2), not_size)
    short = (F.size(head) < 2) & (F.size(words) > 3)
    chosen = F.slice(F.when(short, F.concat(head, more)).otherwise(head), 1, 3)
    plain = F.lower(F.array_join(chosen, " "))
    paired = (F.size(words) == 2) & (F.length(model) >= 5)
    base = F.when(paired, F.concat(F.lower(words[0]), F.lit(" "), model)).otherwise(plain)
    query = F.when(F.col("_term").isNull() | F.contains(F.lower(F.col("_base")), F.col("_term")), F.col("_base"))
    return (
        products.withColumn("target_model", _cascade(F.col("name"), QUERY_MODEL_CASCADE, 1))
        .withColumn("_base", base)
        .join(terms, "category", "left")
        .withColumn("search_query", query.otherwise(F.concat("_base", F.lit(" "), "_term")))
        .drop("_base", "_term")
    )


@lru_cache(maxsize=1)
def _ascii_forms() -> tuple[str, str, dict[str, str]]:
    """What is left of each non-ASCII character after compatibility decomposition: characters that become one other
    (as two texts for `translate`), and those that become several."""
    single, several = {}, {}
    for code in range(0x80, 0x110000):
        form = unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode("ascii")
        if len(form) == 1:
            single[chr(code)] = form
        elif form:
            several[chr(code)] = form
    return "".join(single), "".join(single.values()), several


def fold_to_ascii(text: Column) -> Column:
    """Text without accents and other non-ASCII characters, as compatibility decomposition gives it."""
    before, after, several = _ascii_forms()
    pairs = F.from_json(F.lit(json.dumps([{"c": c, "f": f} for c, f in several.items()])), "array<struct<c:string,f:string>>")

    def longer(folded: Column) -> Column:
        """Characters that become several, looked for among what is not ASCII yet."""
        left = F.regexp_replace(folded, r"[\x00-\x7F]+", "")
        held = F.transform(F.array(left), lambda rest: F.filter(pairs, lambda p: F.contains(rest, p["c"])))[0]
        return F.when(left != "", F.aggregate(held, folded, lambda done, p: F.replace(done, p["c"], p["f"]))).otherwise(folded)

    # The one-element array computes the translated text once.
    return F.regexp_replace(F.transform(F.array(F.translate(text, before, after)), longer)[0], r"[^\x00-\x7F]", "")


def slug_of(ascii_name: Column) -> Column:
    joined = F.regexp_replace(ascii_name, r"[\s_]+", "-")
    joined = F.regexp_replace(joined, r"[^a-zA-Z0-9\-]", "")
    joined = F.lower(F.btrim(F.regexp_replace(joined, "-+", "-"), F.lit("-")))

    def cut(name: Column) -> Column:
        return F.when(name == "", "product").when(F.length(name) > 100, F.rtrim(F.substring(name, 1, 100), F.lit("-"))).otherwise(name)

    return F.transform(F.array(joined), cut)[0]


def display_name(slug: Column) -> Column:
    return F.initcap(F.replace(slug, F.lit("-"), F.lit(" ")))


def build_slugs(products: DataFrame) -> DataFrame:
    """Adds `slug` and `display_name`."""
    return products.withColumn("slug", slug_of(fold_to_ascii(F.col("name")))).withColumn("display_name", display_name(F.col("slug")))


def slug_collisions(slugged: DataFrame) -> DataFrame:
    return slugged.groupBy("slug").agg(F.count("*").alias("products"), F.min("product_id").alias("first_product")).where(
        "products > 1"
    )


# --- categories ---------------------------------------------------------------------------------


def assign_category(files: DataFrame, mapping: dict[str, str] = FILE_CATEGORIES) -> DataFrame:
    """`file_name` to category slug; test files and unknown names are skipped."""
    table = rule_table(files.sparkSession, {"_base": list(mapping), "category": list(mapping.values())})
    base = F.replace(F.replace("file_name", F.lit(".metadata.json"), F.lit("")), F.lit(".json"), F.lit(""))
    return files.withColumn("_base", base).where(~F.col("_base").startswith("test_")).join(table, "_base").drop("_base")


def category_from_url(df: DataFrame) -> DataFrame:
    return df.withColumn("category", extract_or_null(F.col("url"), r"/reviews/([^/?#]+)"))


def ensure_categories(categories: DataFrame, slugs: DataFrame) -> DataFrame:
    """All categories (category_id, slug, name), with new ids for slugs not seen before."""
    new = slugs.select("slug").distinct().join(categories, "slug", "left_anti")
    highest = categories.agg(F.coalesce(F.max("category_id"), F.lit(0)).alias("m")).scalar()
    created = dense_ids(new, "slug", "category_id", highest).withColumn("name", display_name(F.col("slug")))
    return categories.select("category_id", "slug", "name").unionByName(created.select("category_id", "slug", "name"))


def pending_categories(categories: DataFrame, landed: DataFrame) -> DataFrame:
    """Categories without a landed catalog that holds products."""
    return categories.join(landed.where("products > 0").select("slug").distinct(), "slug", "left_anti")


# --- loading ------------------------------------------------------------------------------------


def project_catalog(products: DataFrame, brands: list[str] = BRANDS) -> DataFrame:
    """Catalog products to table rows; the rating score leaves the review struct.

    Whatever is there of summary, pros and cons stays. Columns a catalog does not have are null.
    """
    named = split_brand_model(products, brands)
    given = F.col("reviews.summary").isNotNull() | F.col("reviews.pros").isNotNull() | F.col("reviews.cons").isNotNull()
    reviews = F.when(given, F.struct("reviews.summary", "reviews.pros", "reviews.cons"))

    def optional(column: str, kind: str) -> Column:
        return F.col(column) if column in products.columns else F.lit(None).cast(kind).alias(column)

    attributes = "map<string,string>"
    return named.select(
        "product_id", "category_id", "name", "brand", "model",
        price_value(F.col("price_text"), "load").alias("price"),
        optional("sourceUrl", "string").alias("source_url"),
        optional("specs", attributes), optional("features", attributes),
        F.col("reviews.ratingScore").alias("rating_score"),
        reviews.alias("reviews"),
        optional("images", IMAGES.simpleString()),
        optional("retailerLinks", f"array<{LINK.simpleString()}>").alias("retailer_links"),
    )


def load_products(existing: DataFrame, incoming: DataFrame, key: list[str], mode: str = "append") -> DataFrame:
    """Rows to append: all of them, or with `mode="new"` one per key that is not loaded yet.

    What `mode="new"` leaves out is what `left_out` returns.
    """
    if mode == "append":
        return incoming
    if mode != "new":
        raise ValueError(f"unknown mode {mode!r}")
    fresh = first_by(incoming, key, ["product_id"], [c for c in incoming.columns if c not in key])
    return fresh.join(existing.select(*key), key, "left_anti").select(*incoming.columns)


def left_out(existing: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Incoming rows that `load_products(mode="new")` does not append, with the reason."""
    chosen = load_products(existing, incoming, key, "new").select("product_id")
    known = existing.select(*key).distinct().withColumn("_known", F.lit(True))
    rest = incoming.join(chosen, "product_id", "left_anti").join(known, key, "left")
    reason = F.when(F.col("_known"), "loaded before").otherwise("repeated in this load")
    return rest.select(*incoming.columns, reason.alias("reason"))


def load_counts(existing: DataFrame, incoming: DataFrame, key: list[str], mode: str = "append") -> DataFrame:
    """total, inserted, left_out and without_price counts of a load; inserted and left_out add up to the total.

    A product without a readable price is loaded with a null price.
    """
    inserted = load_products(existing, incoming, key, mode)
    counts = incoming.agg(F.count("*").alias("total"), F.count_if(F.col("price").isNull()).alias("without_price"))
    loaded = inserted.agg(F.count("*").alias("inserted"))
    return counts.select("total", loaded.scalar().alias("inserted"), (F.col("total") - loaded.scalar()).alias("left_out"), "without_price")


def refresh_links(catalog: DataFrame, incoming: DataFrame) -> DataFrame:
    """Catalog with links replaced by those of incoming products of the same brand, model and category.

    Several catalog rows with one identity: the first is updated. Several incoming: the last wins.
    """
    identity = ["brand", "model", "category_id"]
    latest = incoming.where("links is not null").groupBy(*identity).agg(F.max_by("links", "ord").alias("_links"))
    first = catalog.groupBy(*identity).agg(F.min("product_id").alias("product_id"))
    updates = first.join(latest, identity).select("product_id", "_links")
    return catalog.join(updates, "product_id", "left").withColumns({
        "links": F.coalesce("_links", "links"), "updated": F.col("_links").isNotNull(),
    }).drop("_links")


def unmatched_incoming(catalog: DataFrame, incoming: DataFrame) -> DataFrame:
    return incoming.where("links is not null").join(catalog, ["brand", "model", "category_id"], "left_anti")


# --- splits and counts --------------------------------------------------------------------------


def has_links(links: Column) -> Column:
    return F.coalesce(F.size(links) > 0, F.lit(False))


def has_source(links: Column, names: list[str], strict: bool = False) -> Column:
    """Does any link name contain one of `names`; `strict` compares whole words."""
    def hit(name: Column) -> Column:
        lowered = F.lower(name)
        if strict:
            return F.arrays_overlap(F.split(lowered, r"[^a-z0-9]+"), F.array(*[F.lit(n.lower()) for n in names]))
        found = F.lit(False)
        for n in names:
            found = found | F.contains(lowered, F.lit(n.lower()))
        return found

    return F.coalesce(F.exists(links, lambda link: F.coalesce(hit(link["name"]), F.lit(False))), F.lit(False))


def enrichment_gap(products: DataFrame) -> DataFrame:
    """Adds `target` = max(half the baseline, 5), its floor, and the `gap` left after `added` specs."""
    target = F.greatest(F.col("baseline") * 0.5, F.lit(5.0))
    return products.withColumns({
        "target": target,
        "target_specs": F.floor(target),
        "gap": F.greatest(target - F.coalesce("added", F.lit(0)), F.lit(0.0)),
    })


def enrichment_candidates(products: DataFrame) -> DataFrame:
    """Products without a retailer source that still miss specs."""
    return enrichment_gap(products).where("enrichment_source is null and gap > 0")


def run_summary(products: DataFrame) -> DataFrame:
    """One row of totals over the catalog; needs specs/features/images maps or structs counted beforehand."""
    return products.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("n_specs") > 0).alias("successful_enriched"),
        F.count_if(F.coalesce(F.col("n_specs"), F.lit(0)) == 0).alias("failed_enriched"),
        F.sum("n_specs").alias("total_specs_extracted"),
        F.sum("n_features").alias("total_features_extracted"),
        F.count_if(F.col("n_images") > 0).alias("products_with_images"),
        F.sum("n_images").alias("total_images"),
        F.count_if(F.col("source_url").isNotNull()).alias("products_with_url"),
        F.count_if(F.col("price") == 0).alias("zero_price"),
    )


def enrichment_summary(stats: DataFrame) -> DataFrame:
    """Products and specs added per source, successes only."""
    return stats.where("success").groupBy(F.coalesce("source", F.lit("unknown")).alias("source")).agg(
        F.count("*").alias("products"), F.sum("spec_count").alias("specs_added")
    )


def missing_links(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Categories with products that lack links, most first."""
    counts = products.groupBy("category_id").agg(F.count_if(~has_links(F.col("links"))).alias("missing")).where("missing > 0")
    return counts.join(categories, "category_id").select("category_id", "slug", "name", "missing").orderBy(
        F.desc("missing"), "category_id"
    )
