"""Choosing rows: sources with fallback, documents, images, reviews, matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.tables import first_by
from shelfwise.functions.text import contains_any
from shelfwise.rules import (
    AD_WORDS, BAD_DOCUMENT_WORDS, DOCUMENT_WEIGHTS, EMPTY_REVIEW, MANUAL_WORDS, TRUSTED_DOCUMENT_HOSTS,
)

# Rows of sources that one task sorts.
ROWS_A_TASK = 250_000


def dedupe_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """First row per key in input order."""
    return first_by(df, [key], [order], [c for c in df.columns if c != key]).select(*df.columns)


def priority_of(name: Column, order: list[str]) -> Column:
    """Position in the priority list; unlisted names come last together."""
    position = F.lit(len(order))
    for i, listed in reversed(list(enumerate(order))):
        position = F.when(name == listed, i).otherwise(position)
    return position


def quality_score(spec_count: Column) -> Column:
    return F.least(spec_count / 50.0, F.lit(1.0))


def select_source(
    attempts: DataFrame, priority_order: list[str], min_specs: int = 20, max_fallback: int = 2,
    stop_at_first: bool = True, fallback: bool = True,
) -> DataFrame:
    """One row per product: the source that wins, tried in priority order with a limited fallback.

    `attempts` has product_id, source_name, ord and spec_count. Only the first few attempts count,
    so the window keeps that many rows per product on the map side already.
    """
    limit = max_fallback + 1 if fallback else 1
    tried = (
        attempts.withColumn("_priority", priority_of(F.col("source_name"), priority_order))
        .withColumn("_n", F.row_number().over(Window.partitionBy("product_id").orderBy("_priority", "ord")))
        .where(F.col("_n") <= limit)
        .withColumn("_ok", F.col("spec_count") >= max(min_specs, 1))
        .withColumn("quality_score", quality_score(F.col("spec_count")))
    )
    rank = F.struct("_n") if stop_at_first else F.struct((-F.col("quality_score")).alias("s"), F.col("_n"))
    best = F.min_by(F.struct("source_name", "ord", "spec_count", "quality_score", "_n"), F.when(F.col("_ok"), rank))
    done = F.col("_best._n") if stop_at_first else F.col("_tried")
    return tried.groupBy("product_id").agg(best.alias("_best"), F.max("_n").alias("_tried")).select(
        "product_id",
        F.col("_best").isNotNull().alias("success"),
        F.coalesce(done, F.col("_tried")).alias("attempts"),
        "_best.source_name", "_best.ord", "_best.spec_count", "_best.quality_score",
    )


def accumulate_until(source_rows: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Take sources by rank until a product has its target number of keys.

    `source_rows` has product_id, rank, key, value; `targets` has product_id, target. Returns the
    accumulated keys (later used sources overwrite) and per used source the number of new keys.
    A product without a target, or with a null one, takes all its sources. The rows are counted and placed by product
    once, so that a task sorts about ROWS_A_TASK of them; windows and aggregates all work on that placing.
    """
    tasks = -(-source_rows.count() // ROWS_A_TASK)
    by_key = Window.partitionBy("product_id", "key").orderBy("rank")
    earlier = Window.partitionBy("product_id").orderBy("rank").rangeBetween(Window.unboundedPreceding, -1)
    limits = targets.groupBy("product_id").agg(F.max("target").alias("_target"))
    taken = (
        source_rows.repartition(max(tasks, 1), "product_id")
        .withColumn("_new", (F.row_number().over(by_key) == 1).cast("bigint"))
        .withColumn("_before", F.coalesce(F.sum("_new").over(earlier), F.lit(0)))
        .join(limits, "product_id", "left")
        .where(F.col("_target").isNull() | (F.col("_before") < F.col("_target")))
    )
    used = taken.groupBy("product_id", "rank").agg(F.sum("_new").alias("new_keys"), (F.max("_before") + F.sum("_new")).alias("total_keys"))
    merged = taken.groupBy("product_id", "key").agg(F.max_by("value", "rank").alias("value"), F.min("rank").alias("first_rank"))
    return merged, used


def match_candidates(targets: DataFrame, candidates: DataFrame, limit: int = 10) -> DataFrame:
    """Search hit per product: the first whose name holds the model, else the first; none without a link."""
    def bare(c: Column) -> Column:
        return F.translate(F.upper(c), " -", "")

    joined = targets.join(candidates.where(F.col("rank") <= limit), "product_id")
    hit = F.coalesce(F.contains(bare(F.col("name")), bare(F.col("model"))), F.lit(False))
    picked = joined.withColumn("_hit", hit).groupBy("product_id").agg(
        F.min_by(F.struct("name", "href", "rank", F.col("_hit").alias("matched")), F.struct(~F.col("_hit"), F.col("rank"))).alias("_p")
    )
    return picked.select("product_id", "_p.*").where("href is not null")


def document_score(url: Column, brand: Column, model: Column, weights: dict[str, int] = DOCUMENT_WEIGHTS) -> Column:
    lowered = F.lower(url)
    parts = F.split(lowered, "/")
    host = F.when(F.size(parts) > 2, F.get(parts, F.lit(2))).otherwise(lowered)

    def points(condition: Column, name: str) -> Column:
        return F.when(condition, weights[name]).otherwise(0)

    named = F.when((brand != "") & F.contains(host, brand), weights["brand_host"]).otherwise(
        points((brand != "") & F.contains(lowered, brand), "brand_url")
    )
    return (
        named
        + points((model != "") & F.contains(lowered, F.lower(model)), "model")
        + points(contains_any(lowered, MANUAL_WORDS), "manual")
        + points(contains_any(lowered, TRUSTED_DOCUMENT_HOSTS), "trusted")
        + points(contains_any(lowered, BAD_DOCUMENT_WORDS), "bad")
        + points(contains_any(lowered, AD_WORDS), "ad")
    )


def score_documents(urls: DataFrame, k: int = 5) -> DataFrame:
    """Best `k` document links per product; needs product_id, ord, url, brand, model."""
    window = Window.partitionBy("product_id").orderBy(F.desc("score"), "ord")
    return (
        urls.groupBy("product_id", "url", "brand", "model")
        .agg(F.min("ord").alias("ord"))
        .withColumn("score", document_score(F.col("url"), F.col("brand"), F.col("model")))
        .where("score >= 0")
        .withColumn("rank", F.row_number().over(window))
        .where(F.col("rank") <= k)
        .select("product_id", "rank", "url", "score")
    )


def pick_views(images: DataFrame, host: str, form: str = ".webp", size: str = "800x600") -> DataFrame:
    """First front, side and rear image per product among those of the right host, format and size.

    Images sort by the first view word they hold, so a `side-front` image is preferred for side too.
    """
    url = F.col("url")
    views = ["front", "side", "rear"]
    view = F.lit(len(views))
    for i, name in reversed(list(enumerate(views))):
        view = F.when(F.contains(url, F.lit(name)), i).otherwise(view)
    usable = F.contains(url, F.lit(host)) & F.contains(url, F.lit(form)) & F.contains(url, F.lit(size))
    place = F.struct(view.alias("v"), F.col("ord"))
    return images.where(usable).groupBy("product_id").agg(
        *[F.min_by("url", F.when(F.contains(url, F.lit(name)), place)).alias(name) for name in views]
    )


def pick_review_source(reviews: DataFrame, order: list[str]) -> DataFrame:
    """Usable review of the most preferred source, and the next one as alternative."""
    usable = reviews.where(F.col("summary").isNotNull() & (F.col("summary") != EMPTY_REVIEW) & F.col("source").isin(order))
    window = Window.partitionBy("product_id").orderBy(priority_of(F.col("source"), order), "ord")
    ranked = usable.withColumn("_n", F.row_number().over(window)).where(F.col("_n") <= 2)

    def at(n: int, column: str) -> Column:
        return F.max(F.when(F.col("_n") == n, F.col(column)))

    return ranked.groupBy("product_id").agg(
        at(1, "source").alias("source"), at(1, "summary").alias("summary"),
        at(2, "source").alias("alternative_source"), at(2, "summary").alias("alternative_summary"),
    )


def fan_out_pages(urls: DataFrame, pages: int) -> DataFrame:
    """One row per page of each product's review listing."""
    path = F.regexp_replace(F.regexp_extract("url", "^[^?#]*", 0), r"\.aspx.*$", "")
    listing = F.replace(path, F.lit("/product/"), F.lit("/p/reviews/"))
    return urls.withColumn("page", F.explode(F.sequence(F.lit(1), F.lit(pages)))).withColumn(
        "page_url", F.concat(listing, F.lit("?order=HelpfulnessDescending&page="), F.col("page").cast("string"))
    )


def first_n(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """First `n` rows of a total order: each task sends at most `n` rows."""
    return df.orderBy(*order).limit(n)
