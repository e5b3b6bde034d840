"""Key and value profiles, duplicate-key discovery and coverage reports."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.text import is_blank, is_numeric_text, one_decimal, plain_blanks
from shelfwise.rules import (
    BLACKLIST_KEYS, STANDARD_UNIT_SPELLINGS, UNIT_BEARING_VALUE, UNIT_SPELLINGS, VARIANT_SUFFIXES, YES_NO_VARIANTS,
)
from shelfwise.session import cut_lineage


def unit_bearing(eav: DataFrame) -> DataFrame:
    return eav.where(plain_blanks(F.col("value")).rlike(UNIT_BEARING_VALUE))


def profile_values(eav: DataFrame) -> DataFrame:
    """Distinct non-blank values per key, specs and features pooled, one row per value.

    Rows rather than arrays: a free-text key may have as many values as there are products.
    """
    return eav.where(~is_blank(F.col("value"))).select("key", "value").distinct()


def normalization_candidates(profile: DataFrame) -> DataFrame:
    """Keys whose values deserve a value map, with the counts the decision rests on."""
    numeric = is_numeric_text(F.translate("value", ",", "."))
    per_spelling = (
        profile.groupBy("key", F.lower("value").alias("_lower"))
        .agg(
            F.count("*").alias("_n"),
            F.bool_and(numeric).alias("_numeric"),
        )
        .withColumn("_yes_no", F.col("_lower").isin(YES_NO_VARIANTS))
    )
    stats = per_spelling.groupBy("key").agg(
        F.sum("_n").alias("n_values"),
        F.count("*").alias("n_ignoring_case"),
        F.bool_and("_numeric").alias("_numeric"),
        F.bool_or("_yes_no").alias("has_yes_no"),
    )
    wanted = (F.col("n_ignoring_case") < F.col("n_values")) | F.col("has_yes_no") | (F.col("n_values") >= 3)
    return stats.where(
        (F.col("n_values") > 1) & ~F.col("key").endswith("_value") & ~F.col("_numeric") & wanted
    ).drop("_numeric")


def _place() -> Column:
    return F.struct("product_id", "ord")


def key_table(eav: DataFrame, blacklist: list[str] = BLACKLIST_KEYS) -> DataFrame:
    """Per kind and key: product count and the place where the key first appears."""
    return eav.where(~F.col("key").isin(blacklist)).groupBy("kind", "key").agg(
        F.count("*").alias("products"), F.min(_place()).alias("first_place")
    )


def _first_values(rows: DataFrame, order: list[Column], limit: int, name: str) -> DataFrame:
    """First `limit` values per key in `order`, as one array of bounded length."""
    window = Window.partitionBy("kind", "key").orderBy(*order)
    return (
        rows.withColumn("_n", F.row_number().over(window))
        .where(F.col("_n") <= limit)
        .groupBy("kind", "key")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", "value"))), lambda s: s["value"]).alias(name))
    )


def analyze_keys(eav: DataFrame, blacklist: list[str] = BLACKLIST_KEYS, samples: int = 10) -> DataFrame:
    """Per kind and key: product count, first samples in input order, count of unit-bearing values."""
    rows = eav.where(~F.col("key").isin(blacklist))
    counts = rows.groupBy("kind", "key").agg(F.count("*").alias("products"))
    sampled = _first_values(rows, [F.col("product_id"), F.col("ord")], samples, "samples")
    units = unit_values(rows, []).groupBy("key").agg(F.count("*").alias("_n")).withColumn("kind", F.lit("specs"))
    return (
        counts.join(sampled, ["kind", "key"])
        .join(units, ["kind", "key"], "left")
        .select("kind", "key", "products", "samples", F.coalesce("_n", F.lit(0).cast("bigint")).alias("unit_values"))
    )


def unit_values(eav: DataFrame, blacklist: list[str] = BLACKLIST_KEYS) -> DataFrame:
    """All distinct specs values that still carry a unit, one row each."""
    rows = eav.where("kind = 'specs'")
    if blacklist:
        rows = rows.where(~F.col("key").isin(blacklist))
    return unit_bearing(rows).select("key", "value").distinct()


def _without_suffix(key: Column) -> Column:
    return F.regexp_replace(key, "(" + "|".join(VARIANT_SUFFIXES) + ")$", "")


def _variants(keys: DataFrame, *extra: str) -> Column:
    """Variants by count, then first appearance; a base has at most one key per suffix."""
    entry = F.struct((-F.col("products")).alias("o"), F.col("first_place"), F.col("key"), F.col("products"), *extra)
    return F.array_sort(F.collect_list(entry))


def _joined(variants: str, name: str) -> Column:
    return F.array_join(F.transform(variants, lambda s: s[name].cast("string")), ",")


def suffix_clusters(keys: DataFrame) -> DataFrame:
    """Keys that are equal after dropping one generic suffix."""
    grouped = (
        keys.withColumn("base", _without_suffix(F.col("key")))
        .groupBy("base")
        .agg(_variants(keys).alias("_v"))
        .where(F.size("_v") > 1)
    )
    base_is_key = F.exists("_v", lambda s: s["key"] == F.col("base"))
    ratio = F.col("_v")[0]["products"] / F.element_at("_v", -1)["products"]
    return grouped.select(
        "base",
        _joined("_v", "key").alias("variants"),
        _joined("_v", "products").alias("coverage"),
        F.size("_v").cast("bigint").alias("size"),
        F.when(base_is_key, F.col("base")).otherwise(F.col("_v")[0]["key"]).alias("suggested_canonical"),
        F.concat(one_decimal(ratio), F.lit(":1")).alias("coverage_ratio"),
    )


def unit_inconsistencies(keys: DataFrame, spellings: dict[str, list[str]] = UNIT_SPELLINGS) -> DataFrame:
    """Keys that differ only in how their unit is spelled."""
    unit_of = F.create_map(*[F.lit(x) for unit, all_ in spellings.items() for s in all_ for x in (s, unit)])
    grouped = (
        keys.withColumn("suffix", F.regexp_extract("key", "_[^_]*$", 0))
        .withColumn("unit", unit_of[F.col("suffix")])
        .where("unit is not null")
        .withColumn("base", F.substring("key", F.lit(1), F.length("key") - F.length("suffix")))
        .groupBy("base")
        .agg(_variants(keys, "suffix", "unit").alias("_v"))
        .where(F.size("_v") > 1)
    )
    standard = F.filter("_v", lambda s: s["suffix"].isin(STANDARD_UNIT_SPELLINGS))
    return grouped.select(
        "base",
        _joined("_v", "key").alias("variants"),
        _joined("_v", "products").alias("coverage"),
        F.coalesce(F.get(standard, F.lit(0))["key"], F.col("_v")[0]["key"]).alias("suggested_canonical"),
        F.concat(F.lit("inconsistent_"), F.col("_v")[0]["unit"], F.lit("_suffix")).alias("reason"),
    )


def redundant_pairs(keys: DataFrame) -> DataFrame:
    """`k` next to `k_value`."""
    base = keys.select(F.col("key").alias("key1"), F.col("products").alias("products1"))
    value = keys.where(F.col("key").endswith("_value")).select(
        F.col("key").alias("key2"), F.col("products").alias("products2"),
        F.regexp_replace("key", "_value$", "").alias("key1"),
    )
    return base.join(value, "key1").select(
        "key1", "key2", "products1", "products2",
        F.when(F.col("products2") > F.col("products1"), F.col("key2")).otherwise(F.col("key1")).alias("suggested_canonical"),
    )


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio; it depends on the order of its arguments."""
    from difflib import SequenceMatcher

    return pd.Series([SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")


def _least_shared(length: Column, ratio: float) -> Column:
    """Fewest bigrams a key of this length shares with any partner that reaches `ratio`.

    A ratio fixes the least number of matched characters for two lengths. Every unmatched character
    breaks at most two bigrams of its own string and one of the other, which bounds what is lost.
    """
    low = F.ceil(length * (ratio / (2 - ratio)) - 1e-9)
    high = F.floor(length * ((2 - ratio) / ratio) + 1e-9)

    def bound(other: Column) -> Column:
        matched = F.ceil((length + other) * (ratio / 2) - 1e-9)
        mine, theirs = length - matched, other - matched
        shared = F.greatest(length - 1 - 2 * mine - theirs, other - 1 - 2 * theirs - mine)
        return F.when((mine >= 0) & (theirs >= 0), shared)

    return F.array_min(F.transform(F.sequence(low.cast("int"), high.cast("int")), bound))


def similar_keys(keys: DataFrame, min_similarity: float = 0.85) -> DataFrame:
    """Key pairs with a Ratcliff-Obershelp ratio of at least `min_similarity`, first key first seen.

    Pairs are not enumerated. Each key offers only its rarest bigrams, enough of them that two keys
    reaching the ratio must offer a common one, and the ratio is computed for pairs that meet. Where a low
    ratio does not guarantee a common bigram, keys offer their characters as well.
    """
    if not 0 < min_similarity <= 1:
        raise ValueError("min_similarity must lie above 0 and not above 1")
    length = F.col("_len")
    keys = keys.select(
        "key", "products", "first_place", F.length("key").alias("_len"), _without_suffix(F.col("key")).alias("_base")
    ).withColumn("_least", F.coalesce(_least_shared(length, min_similarity), length))
    keys = cut_lineage(keys)  # read six times below; one row per key

    def pieces(df: DataFrame, size: int) -> DataFrame:
        starts = F.sequence(F.lit(1), F.greatest(length - size + 1, F.lit(1)))
        return df.select("key", "_len", "_least", F.explode(F.transform(starts, lambda i: F.substring("key", i, F.lit(size)))).alias("_g"))

    # Repeated bigrams of one key are told apart by a running number.
    counted = pieces(keys, 2).groupBy("key", "_len", "_least", "_g").agg(F.count("*").cast("int").alias("_times"))
    numbered = counted.select("key", "_len", "_least", F.explode(
        F.transform(F.sequence(F.lit(1), F.col("_times")), lambda i: F.concat("_g", F.lit("#"), i.cast("string")))
    ).alias("_g"))
    frequency = numbered.groupBy("_g").agg(F.count("*").alias("_f"))
    per_key = Window.partitionBy("key").orderBy("_f", "_g")
    rarest = (
        numbered.join(frequency, "_g")
        .withColumn("_rarity", F.row_number().over(per_key))
        .where(F.col("_rarity") <= length - F.greatest("_least", F.lit(1)))
        .select("key", "_len", "_g")
    )
    # Keys of a few characters may match without a common bigram; they offer their characters too.
    characters = pieces(keys.where("_least <= 0"), 1).select("key", "_len", "_g").distinct()
    offered = rarest.unionByName(characters)
    left = offered.select(F.col("key").alias("k1"), F.col("_len").alias("l1"), "_g")
    right = offered.select(F.col("key").alias("k2"), F.col("_len").alias("l2"), "_g")
    lengths_allow = 2 * F.least("l1", "l2") >= (F.col("l1") + F.col("l2")) * min_similarity - 1e-9
    met = left.join(right, "_g").where((F.col("k1") < F.col("k2")) & lengths_allow).select("k1", "k2").distinct()

    def side(n: int) -> DataFrame:
        return keys.select(
            F.col("key").alias(f"k{n}"), F.struct("first_place", "key", "products", "_base").alias(f"s{n}")
        )

    pairs = met.join(side(1), "k1").join(side(2), "k2").where("s1._base <> s2._base")
    swap = F.col("s2.first_place") < F.col("s1.first_place")
    ordered = pairs.select(
        F.when(swap, F.col("s2")).otherwise(F.col("s1")).alias("a"), F.when(swap, F.col("s1")).otherwise(F.col("s2")).alias("b")
    )
    return (
        ordered.withColumn("_ratio", sequence_ratio("a.key", "b.key"))
        .where(F.col("_ratio") >= min_similarity)
        .select(
            F.col("a.key").alias("key1"), F.col("b.key").alias("key2"), F.round("_ratio", 2).alias("similarity"),
            F.col("a.products").alias("products1"), F.col("b.products").alias("products2"),
        )
    )


def key_report(eav: DataFrame, n_products: Column, percent: float = 10.0, blacklist: list[str] = BLACKLIST_KEYS) -> DataFrame:
    """Keys of at least `max(2, floor(n * percent / 100))` products with up to 20 unit values or 5 samples."""
    least = F.greatest(F.lit(2), F.floor(n_products * percent / 100))
    rows = eav.where(~F.col("key").isin(blacklist))
    analysis = analyze_keys(eav, blacklist).where(F.col("products") >= least)
    units = unit_values(rows, []).withColumn("kind", F.lit("specs"))
    shown_units = _first_values(units, [F.col("value")], 20, "_units")
    more = F.when(F.col("unit_values") > 20, F.concat(F.lit(" ... ("), F.col("unit_values").cast("string"), F.lit(" total unique values)"))).otherwise("")
    return analysis.join(shown_units, ["kind", "key"], "left").select(
        "kind", "key", "products",
        F.when(F.col("unit_values") > 0, F.concat(F.array_join("_units", ", "), more))
        .otherwise(F.array_join(F.slice("samples", 1, 5), ", ")).alias("shown"),
    )


def key_consistency(eav: DataFrame, n_products: Column) -> DataFrame:
    """Per key: count, floored percent, present in all products, below half of them."""
    counts = eav.groupBy("kind", "key").agg(F.count("*").alias("products"))
    return counts.select(
        "kind", "key", "products",
        F.floor(F.col("products") * 100 / n_products).alias("percent"),
        (F.col("products") == n_products).alias("in_all"),
        (F.col("products") < n_products * 0.5).alias("below_half"),
    )
