"""Ranks and percentiles inside groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Parts of a group's values; a power of two.
SPLITS = 256


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on columns of the same names in which null equals null."""
    renamed = right.select(*[F.col(k).alias(f"_right_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])


def ranked_values(df: DataFrame, keys: list[str], value: str, splits: int = SPLITS) -> DataFrame:
    """Distinct values of each group: keys, value, n (rows), below (rows of smaller values), known (rows not null) and
    total. Nulls are one value, after all others.

    Rows are counted by value first. A group's distinct values are cut into about `splits` equal parts at approximate
    quantiles, so outliers take no more than their own part: a running sum inside a part and one over the parts give the
    rank, and a group that holds most rows is the work of many tasks.
    """
    counted = df.groupBy(*keys, value).agg(F.count("*").alias("n"))
    known = F.sum(F.when(F.col(value).isNotNull(), F.col("n")).otherwise(0))
    number = F.col(value).cast("double")
    bounds = counted.groupBy(*keys).agg(
        F.percentile_approx(number, [i / splits for i in range(1, splits)], 10 * splits).alias("_cuts"), F.sum("n").alias("total"), known.alias("known")
    )
    steps = [1 << i for i in reversed(range((splits - 1).bit_length()))]
    # How many cuts are smaller, by halving.
    smaller_cuts = F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, step: F.when(F.get(F.col("_cuts"), at + step - 1) < number, at + step).otherwise(at),
    )
    part = F.when(F.col(value).isNull(), splits).otherwise(smaller_cuts)
    placed = join_on(counted, bounds, keys).withColumn("_part", part).drop("_cuts")
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy(*keys, "_part").agg(F.sum("n").alias("_size"))
    parts = parts.withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0))).drop("_size")
    smaller = Window.partitionBy(*keys, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    inside = placed.withColumn("_inside", F.coalesce(F.sum("n").over(smaller), F.lit(0)))
    below = (F.col("_before") + F.col("_inside")).alias("below")
    return join_on(inside, parts, [*keys, "_part"]).select(*keys, value, "n", below, "known", "total")


def percentiles(df: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Exact percentiles of each group, between two values in proportion; null for groups without values."""
    ranked = ranked_values(df.where(F.col(value).isNotNull()), keys, value)

    def at(position: Column) -> Column:
        return F.max(F.when((F.col("below") <= position) & (position < F.col("below") + F.col("n")), F.col(value).cast("double")))

    columns = []
    for name, share in shares.items():
        position = (F.col("known") - 1) * F.lit(share)
        low, high = at(F.floor(position)), at(F.ceil(position))
        fraction = F.max(position - F.floor(position))
        columns.append((low + (high - low) * fraction).alias(name))
    return ranked.groupBy(*keys).agg(*columns)
