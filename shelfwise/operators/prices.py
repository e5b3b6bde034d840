"""Price mentions, consensus prices and repair of outliers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.arrays import running_sum
from shelfwise.rules import PRICE_FORMS, PRICE_NUMBER_LITERAL, PRICE_NUMBER_STRICT

# Offers of one product whose prices one task may sort, and width in pounds of the ranges into which more are split.
PRICES_A_TASK = 4_096
RANGE_WIDTH = 16.0


def extract_prices(pages: DataFrame, id_column: str = "doc_id", strict: bool = True) -> DataFrame:
    """Prices mentioned in `text`, in pattern order then position; only 1 to 10,000 pounds count.

    `strict` reads `£1299.99` whole; the literal patterns need comma groups and read 129.
    """
    number = PRICE_NUMBER_STRICT if strict else PRICE_NUMBER_LITERAL

    def found(form: int) -> Column:
        pattern = PRICE_FORMS[form].replace("{n}", number)
        return F.transform(
            F.regexp_extract_all("text", F.lit(pattern), F.lit(1)),
            lambda m, i: F.struct(
                F.lit(form).alias("form"), i.alias("position"), F.replace(m, F.lit(","), F.lit("")).cast("double").alias("price")
            ),
        )

    mentions = F.flatten(F.array(*[found(i) for i in range(len(PRICE_FORMS))]))
    return pages.select(id_column, F.inline(mentions)).where(F.col("price").between(1.0, 10000.0))


def _median(price: Column, cumulative: Column, total: Column, over) -> Column:
    """Median of weighted rows: mean of the two middle prices."""
    low, high = F.floor((total + 1) / 2), F.floor(total / 2) + 1
    return (
        F.min(F.when(cumulative >= low, price)).over(over) + F.min(F.when(cumulative >= high, price)).over(over)
    ) / 2


def consensus_price(offers: DataFrame, gap: float = 5.0, prices_a_task: int = PRICES_A_TASK, width: float = RANGE_WIDTH) -> DataFrame:
    """Fair price per product: median of the largest price cluster after dropping outliers.

    Offers are first counted per product and price. Products of up to `prices_a_task` offers share one partitioning by
    product. Those of more are split into ranges of `width` pounds, so that a product of any size is the work of many
    tasks; both ways give the same result. Whether there are such products is told by a job over the product column alone.
    """
    counted = offers.groupBy("product_id", "price").agg(F.count("*").alias("n"))
    large = offers.groupBy("product_id").agg(F.count("*").alias("_offers")).where(F.col("_offers") > prices_a_task).select("product_id")
    if large.isEmpty():
        return _consensus_of_whole(counted, gap)
    whole = _consensus_of_whole(counted.join(large, "product_id", "left_anti"), gap)
    return whole.unionByName(_consensus_of_split(counted.join(large, "product_id", "left_semi"), gap, width))


def _consensus_of_whole(counted: DataFrame, gap: float) -> DataFrame:
    """Consensus by windows over each product's distinct prices."""
    all_rows = Window.partitionBy("product_id")
    by_price = all_rows.orderBy("price")
    running = by_price.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    price = F.col("price")

    first = (
        counted.withColumn("_cum", F.sum("n").over(running))
        .withColumn("n_offers", F.sum("n").over(all_rows))
        .withColumn("_median", _median(price, F.col("_cum"), F.col("n_offers"), all_rows))
        .where(price.between(F.col("_median") * 0.5, F.col("_median") * 2.0))
    )
    kept = (
        first.withColumn("_cum", F.sum("n").over(running))
        .withColumn("n_kept", F.sum("n").over(all_rows))
        .withColumn("_median", _median(price, F.col("_cum"), F.col("n_kept"), all_rows))
        .withColumn("_jump", F.when(price - F.lag("price").over(by_price) > gap, 1).otherwise(0))
        .withColumn("_cluster", F.sum("_jump").over(running))
    )
    cluster = Window.partitionBy("product_id", "_cluster")
    in_cluster = cluster.orderBy("price").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    clustered = (
        kept.withColumn("_size", F.sum("n").over(cluster))
        .withColumn("_cum", F.sum("n").over(in_cluster))
        .withColumn("_mode", _median(price, F.col("_cum"), F.col("_size"), cluster))
    )
    best = F.max_by(F.struct("_size", "_mode"), F.struct(F.col("_size"), -F.col("_cluster"))).alias("_best")
    decided = F.when((F.col("n_kept") >= 3) & (F.col("_best._size") >= 2), F.col("_best._mode")).otherwise(F.col("_median"))
    return (
        clustered.groupBy("product_id")
        .agg(F.first("n_offers").alias("n_offers"), F.first("n_kept").alias("n_kept"), F.first("_median").alias("_median"), best)
        .select("product_id", "n_offers", "n_kept", F.when(F.col("n_offers") >= 2, decided).alias("target_price"))
    )


def _middle(low_to_high: DataFrame, n: str, before: str = "_before") -> DataFrame:
    """(product_id, `n`, _median) of weighted rows that know how many rows lie before them."""
    total = F.col(n)
    reached = F.col(before) + F.col("n")
    low, high = F.floor((total + 1) / 2), F.floor(total / 2) + 1
    pair = F.min(F.when(reached >= low, F.col("price"))) + F.min(F.when(reached >= high, F.col("price")))
    return low_to_high.groupBy("product_id").agg(F.first(n).alias(n), (pair / 2).alias("_median"))


def _ranged(counted: DataFrame, gap: float, total: str) -> DataFrame:
    """Rows with `_before`, `_cluster` and the product's number of offers, by ranges of prices.

    Inside a range, rows are added up and a cluster begins behind a gap. The ranges of a product, a bounded array of
    sums, then tell each range how many offers and clusters lie before it and which price ended the one before: a
    cluster goes on over the border if that price is near.
    """
    inside = Window.partitionBy("product_id", "_range").orderBy("price")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = counted.withColumns({
        "_inside": F.coalesce(F.sum("n").over(earlier), F.lit(0)),
        "_jump": F.coalesce((F.col("price") - F.lag("price").over(inside) > gap).cast("int"), F.lit(0)),
    }).withColumn("_jumps", F.sum("_jump").over(inside))
    sums = local.groupBy("product_id", "_range").agg(
        F.sum("n").alias("n"), F.sum("_jump").alias("jumps"), F.min("price").alias("low"), F.max("price").alias("high")
    )
    listed = sums.groupBy("product_id").agg(F.array_sort(F.collect_list(F.struct("_range", "n", "jumps", "low", "high"))).alias("ranges"))
    ranges = F.col("ranges")
    # A range whose lowest price is far above the range before begins a cluster of its own.
    begins = F.transform(ranges, lambda r, i: (r["low"] - F.get(ranges, i - 1)["high"] > gap).cast("int"))
    begun = listed.withColumn("_begins", F.transform(begins, lambda b: F.coalesce(b, F.lit(0)))).withColumns({
        "_n": F.aggregate(ranges, F.lit(0).cast("bigint"), lambda s, r: s + r["n"]),
        "_sums": running_sum(F.transform(ranges, lambda r: r["n"]), "bigint"),
        "_clusters": running_sum(F.transform(ranges, lambda r, i: r["jumps"] + F.get(F.col("_begins"), i)), "bigint"),
    })
    offsets = F.transform(ranges, lambda r, i: F.struct(
        r["_range"].alias("_range"), (F.get(F.col("_sums"), i) - r["n"]).alias("_offset"),
        (F.get(F.col("_clusters"), i) - r["jumps"]).alias("_first"),
    ))
    places = begun.select("product_id", F.col("_n").alias(total), F.inline(offsets))
    return local.join(places, ["product_id", "_range"]).select(
        "product_id", "price", "n", "_range", total, (F.col("_offset") + F.col("_inside")).alias("_before"), (F.col("_first") + F.col("_jumps")).alias("_cluster")
    )


def _consensus_of_split(counted: DataFrame, gap: float, width: float) -> DataFrame:
    """Consensus of products of any number of distinct prices: no step sorts a whole product."""
    placed = counted.withColumn("_range", F.floor(F.col("price") / width))
    first = _middle(_ranged(placed, gap, "n_offers"), "n_offers")
    near = placed.join(first, "product_id").where(F.col("price").between(F.col("_median") * 0.5, F.col("_median") * 2.0))
    kept = _ranged(near.select(placed.columns), gap, "n_kept")
    clusters = kept.groupBy("product_id", "_cluster").agg(F.sum("n").alias("_size"), F.min("_before").alias("_start"))
    best = clusters.groupBy("product_id").agg(F.max_by(F.struct("_cluster", "_size", "_start"), F.struct("_size", -F.col("_cluster"))).alias("_best"))
    best = best.select("product_id", "_best.*")
    mode = _middle(kept.join(best, ["product_id", "_cluster"]).withColumn("_place", F.col("_before") - F.col("_start")), "_size", "_place")
    decided = F.when((F.col("n_kept") >= 3) & (F.col("_size") >= 2), F.col("_mode")).otherwise(F.col("_median"))
    return (
        first.select("product_id", "n_offers").join(_middle(kept, "n_kept"), "product_id")
        .join(mode.withColumnRenamed("_median", "_mode"), "product_id")
        .select("product_id", "n_offers", "n_kept", F.when(F.col("n_offers") >= 2, decided).alias("target_price"))
    )


def in_range(price: Column, target: Column, tolerance_percent: float = 20.0) -> Column:
    return price.between(target * (1 - tolerance_percent / 100), target * (1 + tolerance_percent / 100))


def repair_prices(mentions: DataFrame, targets: DataFrame, tolerance_percent: float = 20.0) -> DataFrame:
    """One price per product and source: the first mention, or the first within reach of the target.

    `mentions` has product_id, source_id, ord, price; `targets` has product_id and target_price.
    Sources with no price within reach are dropped; products without a target keep first mentions.
    """
    within = in_range(F.col("price"), F.col("target_price"), tolerance_percent)
    picked = (
        mentions.join(targets.select("product_id", "target_price"), "product_id", "left")
        .groupBy("product_id", "source_id")
        .agg(
            F.min_by("price", "ord").alias("first_price"),
            F.min_by("price", F.when(within, F.col("ord"))).alias("_within"),
            F.first("target_price").alias("target_price"),
        )
    )
    return picked.select(
        "product_id", "source_id", "first_price", "target_price",
        F.when(F.col("target_price").isNull() | in_range(F.col("first_price"), F.col("target_price"), tolerance_percent), F.col("first_price"))
        .otherwise(F.col("_within")).alias("price"),
    ).where("price is not null").withColumn("repaired", F.col("price") != F.col("first_price"))


def price_summary(prices: DataFrame, products: DataFrame) -> DataFrame:
    """Products processed, products with a price, and prices found."""
    per_product = prices.groupBy("product_id").agg(F.count("*").alias("_n"))
    return products.select("product_id").join(per_product, "product_id", "left").agg(
        F.count("*").alias("products"), F.count("_n").alias("successful"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("prices"),
    )
