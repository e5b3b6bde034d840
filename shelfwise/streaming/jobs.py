"""Streams: search metrics by the hour, and standardization of arriving products."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfwise.operators import standardize as st
from shelfwise.plans.standardizing import RuleSet, StoredRules, product_rules
from shelfwise.schemas import EAV_COLUMNS


def metrics_stream(metrics: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Hourly counts, means, approximate percentiles and cache-hit share per category.

    State is one row per open hour and category; hours close once the watermark has passed them.
    """
    latency = "execution_time_ms"
    return (
        metrics.withWatermark("created_at", late)
        .groupBy(F.window("created_at", "1 hour").alias("w"), "category_id")
        .agg(
            F.count("*").alias("search_count"),
            F.avg(latency).alias("avg_latency"),
            F.percentile_approx(latency, [0.5, 0.95], 10000).alias("_p"),
            F.avg(F.col("cache_hit").cast("int")).alias("cache_hit_rate"),
        )
        .select(
            F.col("w.start").alias("hour"), "category_id", "search_count", "avg_latency",
            F.col("_p")[0].alias("p50_latency"), F.col("_p")[1].alias("p95_latency"), "cache_hit_rate",
        )
    )


# Size of a latency sketch: the rank of a quantile is off by about 0.2 percent of the rows at most, merged or not.
SKETCH_K, SKETCH_RANK_ERROR = 2_000, 0.002


def _sketched(metrics: DataFrame, *keys: Column | str) -> DataFrame:
    """Counts and sums that add up, and a sketch of latencies that merges, for each key."""
    latency = F.col("execution_time_ms").cast("double")
    return metrics.groupBy(*keys).agg(
        F.count("*").alias("search_count"), F.count(latency).alias("timed"), F.sum(latency).alias("total_latency"),
        F.count_if("cache_hit").alias("cache_hits"), F.kll_sketch_agg_double(latency, F.lit(SKETCH_K)).alias("sketch"),
    )


def hourly_sketches(metrics: DataFrame) -> DataFrame:
    """One row per hour and category, of fixed size however many searches there were."""
    return _sketched(metrics, F.date_trunc("hour", "created_at").alias("hour"), "category_id")


def sketch_stream(metrics: DataFrame, late: str = "10 minutes") -> DataFrame:
    """`hourly_sketches` of a stream: a row is written once its hour is over and the watermark has passed it."""
    hours = _sketched(metrics.withWatermark("created_at", late), F.window("created_at", "1 hour").alias("w"), "category_id")
    return hours.select(F.col("w.start").alias("hour"), "category_id", "search_count", "timed", "total_latency", "cache_hits", "sketch")


def rollup_sketches(hours: DataFrame, *keys: Column | str, shares: dict[str, float] | None = None) -> DataFrame:
    """Any span of stored hours in one row per key: counts, mean, cache-hit share and latency quantiles.

    Sketches are merged, so a day of a category is read from 24 rows. Hours without a measured latency do not count in
    the quantiles; a key without any has null ones.
    """
    merged = hours.groupBy(*keys).agg(
        F.count("*").alias("hours"), F.sum("search_count").alias("search_count"), F.sum("timed").alias("timed"),
        F.sum("total_latency").alias("_total"), F.sum("cache_hits").alias("_hits"), F.kll_merge_agg_double("sketch").alias("_sketch"),
    )
    quantiles = {
        name: F.when(F.col("timed") > 0, F.kll_sketch_get_quantile_double("_sketch", F.lit(float(share))))
        for name, share in (shares or {"p50_latency": 0.5, "p95_latency": 0.95}).items()
    }
    return merged.withColumns({
        "avg_latency": F.col("_total") / F.col("timed"), "cache_hit_rate": F.col("_hits") / F.col("search_count"), **quantiles,
    }).drop("_total", "_hits", "_sketch", "timed")


def standardize_stream(
    arriving: DataFrame, to_rows: Callable[[DataFrame], DataFrame], rules: RuleSet | StoredRules, value_map: DataFrame,
    kept_keys: DataFrame, moves: DataFrame, out: str, checkpoint: str,
) -> StreamingQuery:
    """Standardize every arriving batch of products with rules and profiles of the last full run.

    A product arrives whole, so unit and key rules need nothing from other batches. Each batch
    overwrites its own partition, which makes a retried batch harmless.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        local = st.keep_keys(product_rules(to_rows(batch), rules), kept_keys)
        valued = st.normalize_values(local, value_map).select(*EAV_COLUMNS)
        st.assign_kinds(valued, moves).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        arriving.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
