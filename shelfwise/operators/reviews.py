"""Review texts and confidence-weighted ratings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.text import one_decimal, strip
from shelfwise.rules import EMPTY_REVIEW, RATING_PRIOR_MEAN, RATING_PRIOR_WEIGHT, RELATIVE_DATE


def weighted_rating(rating: Column, count: Column, prior_mean=RATING_PRIOR_MEAN, prior_weight: int = RATING_PRIOR_WEIGHT) -> Column:
    """Rating out of 5 as a percentage, pulled towards the prior while there are few reviews."""
    prior_mean = prior_mean if isinstance(prior_mean, Column) else F.lit(prior_mean)
    share = count / (count + prior_weight)
    score = F.round((share * rating + (prior_weight / (count + prior_weight)) * prior_mean) / 5.0 * 100, 1)
    return F.when((rating != 0) & (count != 0), score)


def rating_number(text: Column) -> Column:
    """`4.5/5` or `4.5` -> 4.5"""
    return F.split(text, "/")[0].try_cast("double")


def rating_score(reviews: DataFrame, prior_mean=RATING_PRIOR_MEAN, prior_weight: int = RATING_PRIOR_WEIGHT) -> DataFrame:
    """Average stars, count and weighted score per product."""
    return reviews.groupBy("product_id").agg(F.avg("stars").alias("rating"), F.count("stars").alias("count")).withColumn(
        "rating_score", weighted_rating(F.col("rating"), F.col("count"), prior_mean, prior_weight)
    )


def snapshot_score(snapshots: DataFrame, prior_mean=RATING_PRIOR_MEAN) -> DataFrame:
    """Weighted score from rating texts and counts."""
    rated = snapshots.withColumn("rating", rating_number(F.col("rating_text")))
    return rated.withColumn("rating_score", weighted_rating(F.col("rating"), F.col("count"), prior_mean))


def attach_scores(picked: DataFrame, snapshots: DataFrame, prior_mean=RATING_PRIOR_MEAN) -> DataFrame:
    """Weighted score of each picked review (product_id, source) from the rating snapshot of its source."""
    rated = snapshots.select("product_id", "source", "rating", "count")
    return picked.join(rated, ["product_id", "source"], "left").withColumn(
        "rating_score", weighted_rating(F.col("rating"), F.col("count"), prior_mean)
    )


def global_rating(snapshots: DataFrame) -> DataFrame:
    """Mean rating weighted by review counts; the prior mean where there are no reviews."""
    total = F.sum("count")
    return snapshots.agg(
        F.when(total > 0, F.round(F.sum(F.col("rating") * F.col("count")) / total, 2)).otherwise(RATING_PRIOR_MEAN).alias("global_rating"),
        F.coalesce(total, F.lit(0)).alias("total_reviews"),
    )


def review_summary(stats: DataFrame) -> DataFrame:
    """Processed, successful and failed products with the success rate as text."""
    rate = F.count_if("success") / F.count("*") * 100
    return stats.agg(
        F.count("*").alias("processed"), F.count_if("success").alias("successful"),
        F.count_if(~F.col("success")).alias("failed"), F.count_if(F.col("success") & F.col("has_text")).alias("texts_extracted"),
        F.concat(one_decimal(rate), F.lit("%")).alias("success_rate"),
    )


def review_corpus(reviews: DataFrame, cap: int = 50) -> DataFrame:
    """First `cap` reviews of a product as one text; the mean covers all of its reviews."""
    window = Window.partitionBy("product_id").orderBy("review_id")
    entry = F.concat(
        F.lit("Review "), F.col("_n").cast("string"), F.lit(" ("), F.col("stars").cast("string"), F.lit("/5 stars): "), F.col("body")
    )
    texts = (
        reviews.withColumn("_n", F.row_number().over(window))
        .where(F.col("_n") <= cap)
        .withColumn("_text", entry)
        .groupBy("product_id")
        .agg(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_n", "_text"))), lambda s: s["_text"]), "\n").alias("corpus"),
            F.count("*").alias("reviews_analyzed"),
        )
    )
    means = reviews.groupBy("product_id").agg(F.avg("stars").alias("average_rating"), F.count("*").alias("reviews_total"))
    return texts.join(means, "product_id")


def split_reviews(blobs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Single reviews of a page text, cut at `N out of 5 stars.`; the star count is kept as well."""
    parts = F.slice(F.split("text", r"\d+\s+out of 5 stars\."), 2, 2147483647)
    stars = F.regexp_extract_all("text", F.lit(r"(\d+)\s+out of 5 stars\."), F.lit(1))
    each = blobs.select(id_column, F.posexplode(F.arrays_zip(parts.alias("part"), stars.alias("stars"))).alias("ord", "r"))
    part = F.col("r.part")
    date = F.regexp_extract(part, RELATIVE_DATE, 1)
    after = strip(F.substring(part, F.instr(part, date) + F.length(date), F.length(part)))
    recommend = F.regexp_instr("_after", F.lit(r"(Yes|No), I would"))
    posted = F.instr("_after", F.lit("Originally posted"))
    text = (
        F.when(recommend > 0, F.substring("_after", F.lit(1), recommend - 1))
        .when(posted > 0, F.substring("_after", F.lit(1), posted - 1))
        .otherwise(F.substring("_after", 1, 200))
    )
    return (
        each.where(date != "")
        .select(id_column, F.col("ord").cast("bigint").alias("ord"), F.col("r.stars").cast("int").alias("stars"), after.alias("_after"))
        .withColumn("text", F.btrim(strip(text), F.lit(".,; ")))
        .where(F.length("text") > 10)
        .drop("_after")
    )


def to_review_rows(texts: DataFrame, products: DataFrame) -> DataFrame:
    """Review rows in the common shape; products without any get one empty-result row."""
    rows = texts.select("product_id", "ord", "text", F.lit(True).alias("_has"))
    return products.select("product_id").join(rows, "product_id", "left").select(
        "product_id",
        F.coalesce("ord", F.lit(0).cast("bigint")).alias("ord"),
        F.coalesce("text", F.lit(EMPTY_REVIEW)).alias("text"),
        F.lit("").alias("title"), F.lit(0).alias("rating"), F.lit(0).alias("helpful"), F.lit("").alias("date"),
        F.lit("").alias("reviewer"), F.lit(False).alias("verified"), F.col("_has").isNull().alias("is_empty"),
    )
