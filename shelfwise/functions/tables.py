"""Small helpers to build and number tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def rule_table(spark: SparkSession, columns: dict[str, list]) -> DataFrame:
    """Local table of rules. Its size is known to the optimizer, which then broadcasts it or not."""
    return spark.createDataFrame(pa.table(columns))


def first_by(df: DataFrame, keys: list[str], order: list[str | Column], keep: list[str]) -> DataFrame:
    """For each key the row that sorts first.

    An aggregate, not a window: every task keeps one row per key before the shuffle, so one hot
    key costs no more than any other.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    picked = F.min_by(F.struct(*keep), F.struct(*order)).alias("_picked")
    return df.groupBy(*keys).agg(picked).select(*keys, "_picked.*")


def dense_ids(df: DataFrame, key: str, id_name: str, start: Column) -> DataFrame:
    """Ids `start + 1, start + 2, ...` for distinct keys, in the order of their MD5.

    Keys are numbered inside 4,096 hash buckets and shifted by the sizes of the buckets before, so
    no task sees all keys.
    """
    bucketed = df.withColumn("_md5", F.md5(key)).withColumn("_bucket", F.substring("_md5", 1, 3))
    sizes = bucketed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy("_md5", key))
    return (
        bucketed.withColumn("_inside", inside)
        .join(offsets, "_bucket")
        .withColumn(id_name, (start + F.col("_before") + F.col("_inside")).cast("bigint"))
        .drop("_md5", "_bucket", "_inside", "_before")
    )
