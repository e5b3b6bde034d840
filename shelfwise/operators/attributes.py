"""The long attribute table: building it, merging sources into it and packing it again.

Columns: product_id, kind (`specs` or `features`), ord, key, value. A key occurs once per product
and kind; `ord` keeps the order in which a product lists its keys, because first-wins rules need it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.tables import first_by
from shelfwise.functions.text import is_blank, normalize_label
from shelfwise.schemas import APPENDED, EAV_COLUMNS


def to_eav(products: DataFrame, kinds: tuple[str, ...] = ("specs", "features")) -> DataFrame:
    """One row per map entry. Narrow: no shuffle."""
    def rows(kind: str):
        return F.transform(
            F.map_entries(kind),
            lambda e, i: F.struct(
                F.lit(kind).alias("kind"), i.cast("bigint").alias("ord"), e["key"].alias("key"), e["value"].alias("value")
            ),
        )

    entries = F.flatten(F.array_compact(F.array(*[rows(kind) for kind in kinds])))
    return products.select("product_id", F.inline(entries)).select(*EAV_COLUMNS)


def from_eav(eav: DataFrame) -> DataFrame:
    """Maps `specs` and `features` per product, keys in `ord` order.

    The group is one product's own attributes, which came from one record.
    """

    def packed(kind: str):
        rows = F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("ord", "key", "value"))))
        return F.map_from_entries(F.transform(rows, lambda r: F.struct(r["key"], r["value"]))).alias(kind)

    return eav.groupBy("product_id").agg(packed("specs"), packed("features"))


def normalize_labels(rows: DataFrame, drop: str = ":") -> DataFrame:
    """Labels in `key` become keys; rows whose label leaves nothing are dropped."""
    return rows.withColumn("key", normalize_label(F.col("key"), drop)).where("key <> ''")


def keep_last_value(rows: DataFrame) -> DataFrame:
    """Repeated keys: the position of the first, the value of the last."""
    return (
        rows.groupBy("product_id", "kind", "key")
        .agg(F.min("ord").alias("ord"), F.max_by("value", "ord").alias("value"))
        .select(*EAV_COLUMNS)
    )


def flatten_sections(rows: DataFrame) -> DataFrame:
    """Rows (product_id, section_ord, ord, key, value) to one level; later sections overwrite."""
    place = F.struct("section_ord", "ord")
    return rows.groupBy("product_id", "key").agg(
        F.max_by("value", place).alias("value"),
        F.min(place).alias("_first"),
    ).select("product_id", "key", "value", F.col("_first.section_ord").alias("section_ord"), F.col("_first.ord").alias("ord"))


def delete_keys(eav: DataFrame, keys: list[str]) -> DataFrame:
    return eav.where(~F.col("key").isin(keys)) if keys else eav


def remove_cross_kind(eav: DataFrame, specs: list[str], features: list[str]) -> DataFrame:
    """Drop the first list from specs and the second from features."""
    drop = (F.col("kind") == "specs") & F.col("key").isin(specs or [""])
    drop = drop | ((F.col("kind") == "features") & F.col("key").isin(features or [""]))
    return eav.where(~drop)


def filter_blacklist(eav: DataFrame, blacklist: list[str]) -> DataFrame:
    return delete_keys(eav, blacklist)


def blacklist_hits(eav: DataFrame, blacklist: list[str]) -> DataFrame:
    """Which blacklisted keys occurred, per kind."""
    return eav.where(F.col("key").isin(blacklist)).select("kind", "key").distinct()


def fill_gaps(primary: DataFrame, extra: DataFrame, strict: bool = False) -> DataFrame:
    """Union of keys; on conflict the primary value wins, even when blank.

    The extra source's keys come first, as they do when a primary record is laid over an extra one.
    `strict` puts the primary's keys first instead, so later first-wins rules favour it.
    """
    extra_shift, primary_shift = (APPENDED, 0) if strict else (0, APPENDED)
    both = primary.select(*EAV_COLUMNS, F.lit(0).alias("_rank")).withColumn("ord", F.col("ord") + primary_shift)
    both = both.unionByName(
        extra.select(*EAV_COLUMNS, F.lit(1).alias("_rank")).withColumn("ord", F.col("ord") + extra_shift)
    )
    return (
        both.groupBy("product_id", "kind", "key")
        .agg(F.min("ord").alias("ord"), F.min_by("value", "_rank").alias("value"))
        .select(*EAV_COLUMNS)
    )


def nonblank(eav: DataFrame) -> DataFrame:
    return eav.where(~is_blank(F.col("value")))


def overlay(base: DataFrame, updates: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of `base` replaced by the latest update with the same key; order and count of base kept."""
    fields = [c for c in base.columns if c not in (key, order)]
    latest = first_by(updates, [key], [-F.col(order)], fields)
    latest = latest.select(key, F.struct(*fields).alias("_new"))
    return base.join(latest, key, "left").select(
        key, order, *[F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in fields]
    )
