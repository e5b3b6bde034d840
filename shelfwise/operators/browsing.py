"""Completion of names from a stored dictionary, and paging by the last row seen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Letters that name a folder of the dictionary, and rows of a Parquet page in it.
HEAD, PAGE_ROWS = 2, 512


def write_names(products: DataFrame, path: str) -> None:
    """Store the distinct names with their number of products: folders by the first letters, sorted inside.

    A folder that holds most names is written by many tasks, each a range of names.
    """
    names = products.where("name is not null").groupBy("name").agg(F.count("*").alias("products"))
    filed = names.withColumn("low", F.lower("name")).withColumn("head", F.substring("low", 1, HEAD))
    placed = filed.repartitionByRange("head", "low").sortWithinPartitions("head", "low")
    placed.select("low", "name", "products", "head").write.option("parquet.page.row.count.limit", str(PAGE_ROWS)).partitionBy("head").parquet(path)


def read_names(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("low string, name string, products bigint, head string").parquet(path)


def complete_stored(names: DataFrame, prefix: str, n: int = 10) -> DataFrame:
    """First `n` names that begin with the prefix, ignoring case: only its folder, and in it its range, is read."""
    low = prefix.lower()
    found = names
    if low:
        head = low[:HEAD]
        found = found.where(F.col("head") == head if len(low) >= HEAD else F.startswith("head", F.lit(head)))
        found = found.where((F.col("low") >= low) & F.startswith("low", F.lit(low)))
    return found.select("name").orderBy("name").limit(n)


def page_after(rows: DataFrame, order: list[tuple[str, bool]], limit: int, after: tuple | None = None) -> DataFrame:
    """The `limit` rows behind the row `after`, or the first ones.

    `order` is a list of (column, falling), the last one unique; nulls come last. `after` holds the last row's values of
    these columns. Rows before it are ruled out by conditions that reach the files, so a late page costs no more than an
    early one and is right when rows have been added in between.
    """
    def behind(column: str, falling: bool, value) -> Column:
        c = F.col(column)
        if value is None:
            return F.lit(False)
        return ((c < value) if falling else (c > value)) | c.isNull()

    def equal(column: str, value) -> Column:
        return F.col(column).isNull() if value is None else F.col(column) == value

    if after is not None:
        alternatives = []
        for i, (column, falling) in enumerate(order):
            same = [equal(c, v) for (c, _), v in zip(order[:i], after)]
            alternatives.append(reduce(lambda a, b: a & b, same, behind(column, falling, after[i])))
        rows = rows.where(reduce(lambda a, b: a | b, alternatives))
        first, falling = order[0]
        if after[0] is None:
            rows = rows.where(F.col(first).isNull())
        else:
            # Follows from the alternatives; in this form the files' statistics can tell.
            rows = rows.where((F.col(first) <= after[0] if falling else F.col(first) >= after[0]) | F.col(first).isNull())
    return rows.orderBy(*[F.desc_nulls_last(c) if falling else F.asc_nulls_last(c) for c, falling in order]).limit(limit)
