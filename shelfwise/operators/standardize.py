"""Attribute standardization on the long table: units, keys, values, kinds and checks."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.arrays import bind
from shelfwise.functions.text import (
    bare_key, clean_number_text, comparable_key, is_blank, plain_blanks, strip, whole_or_decimal_text,
)
from shelfwise.operators.attributes import keep_last_value
from shelfwise.rules import BOOLEAN_WORDS, RESIDUAL_UNITS, UNIT_PATTERNS
from shelfwise.schemas import APPENDED, EAV_COLUMNS

# Every unit pattern needs one of these, so most plain values skip the whole cascade.
_MAY_HOLD_UNIT = r"\d\.?\s*[A-Za-z°%]|£"


def _unit_patterns(strict: bool):
    """`strict` lets `%` and `°` match without a following word character."""
    for name, suffix, regex, divisor in UNIT_PATTERNS:
        if strict and name in ("degrees", "percent"):
            regex = regex.removesuffix(r"\b")
        yield name, suffix, "(?i)" + regex, divisor


def _detected(value: Column, strict: bool) -> Column:
    """Struct (number, suffix) of the first pattern that matches, else null.

    One expression of linear size: a filter pushed below it repeats it once, not once per pattern.
    """
    chain = F.when(~value.rlike(_MAY_HOLD_UNIT), F.lit(None))
    for _, suffix, regex, divisor in _unit_patterns(strict):
        text = F.regexp_extract(value, regex, 1)
        number = whole_or_decimal_text(text.cast("double") / divisor) if divisor else text
        chain = chain.when(value.rlike(regex), F.struct(number.alias("number"), F.lit(suffix).alias("suffix")))
    return chain


def _with_auto_units(eav: DataFrame, strict: bool) -> DataFrame:
    """Adds `_auto_key` and `_auto_value`."""
    suffix = F.col("_unit.suffix")
    return (
        eav.withColumn("_unit", _detected(plain_blanks(strip(F.col("value"))), strict))
        .withColumn("_auto_value", F.coalesce("_unit.number", "value"))
        .withColumn("_auto_key", F.when(suffix.isNull() | F.col("key").endswith(suffix), F.col("key")).otherwise(F.concat("key", suffix)))
        .drop("_unit")
    )


def extract_units_auto(eav: DataFrame, strict: bool = False) -> DataFrame:
    """Values with a recognised unit become numbers and their keys gain the unit's suffix."""
    return _with_auto_units(eav, strict).select(
        "product_id", "kind", "ord", F.col("_auto_key").alias("key"), F.col("_auto_value").alias("value")
    )


def _with_ruled_value(df: DataFrame, strict: bool) -> DataFrame:
    """Adds `_ruled_value`: the number left after removing the unit the rule in `_units` names.

    `_units` is sorted longest first. `strict` treats `mm` as millimetres only behind a digit;
    otherwise any `mm` is cut, also inside a word. Steps are columns of their own, so each is
    computed once; without a rule they stay null.
    """
    text, lowered, new_key = F.col("_text"), F.lower("_text"), F.col("_new_key")
    if strict:
        millimetres, cut = text.rlike(r"(?i)\d\s*mm"), F.regexp_replace(text, r"(?i)(\d)\s*mm\s*", "$1")
    else:
        millimetres, cut = text.rlike("(?i)mm"), F.regexp_replace(text, r"(?i)\s*mm\s*", "")
    df = df.withColumn("_text", F.when(new_key.isNotNull(), plain_blanks(strip(F.col("value"))))).withColumns({
        "_cut": F.when(millimetres, clean_number_text(strip(cut))),
        "_at_end": F.get(F.filter("_units", lambda u: lowered.endswith(F.lower(u))), F.lit(0)),
        "_anywhere": F.get(F.filter("_units", lambda u: F.contains(lowered, F.lower(u))), F.lit(0)),
    })
    cut = F.col("_cut")
    tenth = F.when(new_key.endswith("_cm") & cut.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)$"), cut.cast("double") / 10)
    pattern = F.concat(F.lit(r"(?i)\s*\Q"), "_anywhere", F.lit(r"\E\s*"))
    bare = (
        F.when(F.col("_at_end").isNotNull(), F.substring(text, F.lit(1), F.length(text) - F.length("_at_end")))
        .when(F.col("_anywhere").isNotNull(), F.regexp_replace(text, pattern, F.lit("")))
        .otherwise(text)
    )
    value = F.coalesce(F.when(cut.isNotNull(), F.coalesce(whole_or_decimal_text(tenth), cut)), clean_number_text(strip(bare)))
    return df.withColumn("_ruled_value", value).drop("_text", "_cut", "_at_end", "_anywhere")


def _with_rules(eav: DataFrame, rules: DataFrame) -> DataFrame:
    longest_first = F.transform(
        F.array_sort(F.transform("units", lambda u, i: F.struct((-F.length(u)).alias("l"), i.alias("i"), u.alias("u")))),
        lambda s: s["u"],
    )
    sorted_rules = rules.select("key", longest_first.alias("_units"), F.col("new_key").alias("_new_key"))
    return eav.join(sorted_rules, "key", "left")


def extract_units_rules(eav: DataFrame, rules: DataFrame, strict: bool = True) -> DataFrame:
    """Apply unit rules (key, units array, new_key); keys without a rule pass unchanged."""
    return _with_ruled_value(_with_rules(eav, rules), strict).select(
        "product_id", "kind", "ord",
        F.coalesce("_new_key", "key").alias("key"),
        F.coalesce("_ruled_value", "value").alias("value"),
    )


def extract_units(eav: DataFrame, rules: DataFrame | None = None, strict_rules: bool = True, strict_auto: bool = False) -> DataFrame:
    """Rules first, detection for the other keys. Narrow apart from the rule join; keys may repeat after."""
    if rules is None:
        return extract_units_auto(eav, strict_auto)
    return _with_auto_units(_with_ruled_value(_with_rules(eav, rules), strict_rules), strict_auto).select(
        "product_id", "kind", "ord",
        F.coalesce("_new_key", "_auto_key").alias("key"),
        F.coalesce("_ruled_value", "_auto_value").alias("value"),
    )


def resolve_collisions(eav: DataFrame) -> DataFrame:
    """Keys that became equal: position of the first, value of the last."""
    return keep_last_value(eav)


def _canonical(eav: DataFrame, merges: DataFrame) -> DataFrame:
    renamed = merges.select(F.col("alias").alias("key"), "canonical")
    return eav.join(renamed, "key", "left").withColumn("_canonical", F.coalesce("canonical", "key"))


def unify_keys(eav: DataFrame, merges: DataFrame) -> DataFrame:
    """Aliases take their canonical name, then the first of all comparable keys is kept."""
    return (
        _canonical(eav, merges)
        .withColumn("_same", comparable_key(F.col("_canonical")))
        .groupBy("product_id", "kind", "_same")
        .agg(F.min_by(F.struct("ord", F.col("_canonical").alias("key"), "value"), "ord").alias("_first"))
        .select("product_id", "kind", "_first.*")
        .select(*EAV_COLUMNS)
    )


def resolve_and_unify(eav: DataFrame, merges: DataFrame) -> DataFrame:
    """`resolve_collisions` then `unify_keys` behind one shuffle.

    Equal keys are always comparable, so hashing on the comparable key serves both groupings.
    """
    placed = (
        _canonical(eav, merges)
        .withColumn("_same", comparable_key(F.col("_canonical")))
        .select(*EAV_COLUMNS, "_canonical", "_same")
        .repartition("product_id", "kind", "_same")
    )
    resolved = placed.groupBy("product_id", "kind", "_same", "key", "_canonical").agg(
        F.min("ord").alias("ord"), F.max_by("value", "ord").alias("value")
    )
    return (
        resolved.groupBy("product_id", "kind", "_same")
        .agg(F.min_by(F.struct("ord", F.col("_canonical").alias("key"), "value"), "ord").alias("_first"))
        .select("product_id", "kind", "_first.*")
        .select(*EAV_COLUMNS)
    )


def boolean_word(value: Column) -> Column:
    return F.lower(strip(value)).isin(BOOLEAN_WORDS)


def key_stats(eav: DataFrame) -> DataFrame:
    """Per kind and key: how many products have it, and whether all its non-blank values are boolean."""
    boolean = boolean_word(F.col("value"))
    all_boolean = F.bool_and(F.when(~is_blank(F.col("value")), boolean))
    return eav.groupBy("kind", "key").agg(F.count("*").alias("products"), F.coalesce(all_boolean, F.lit(False)).alias("boolean"))


def covered_keys(stats: DataFrame, n_products: Column, percent: float) -> DataFrame:
    """Adds `kept`: the key reaches `max(1, floor(n * percent / 100))` products."""
    least = F.greatest(F.lit(1), F.floor(n_products * percent / 100))
    return stats.withColumn("kept", F.col("products") >= least)


def key_coverage(eav: DataFrame, n_products: Column, percent: float) -> DataFrame:
    return covered_keys(eav.groupBy("kind", "key").agg(F.count("*").alias("products")), n_products, percent)


def filter_coverage(eav: DataFrame, n_products: Column, percent: float = 10.0) -> DataFrame:
    """Keep keys that enough products have; 0 percent keeps all."""
    if percent <= 0:
        return eav
    return keep_keys(eav, key_coverage(eav, n_products, percent).where("kept").select("kind", "key"))


def keep_keys(eav: DataFrame, kept: DataFrame) -> DataFrame:
    return eav.join(kept, ["kind", "key"], "left_semi").select(*EAV_COLUMNS)


def coverage_stats(eav: DataFrame, n_products: Column, percent: float = 10.0) -> DataFrame:
    return key_coverage(eav, n_products, percent).groupBy("kind").agg(
        F.count_if("kept").alias("kept"), F.count_if(~F.col("kept")).alias("removed")
    )


def normalize_values(eav: DataFrame, value_map: DataFrame) -> DataFrame:
    """Replace values by (key, value) -> normalized; adds `changed`.

    A map that names a pair more than once gives the pair's smallest text, so an attribute never becomes two.
    """
    once = value_map.groupBy("key", "value").agg(F.min("normalized").alias("normalized"))
    return eav.join(once, ["key", "value"], "left").select(
        "product_id", "kind", "ord", "key",
        F.coalesce("normalized", "value").alias("value"),
        (F.coalesce("normalized", "value") != F.col("value")).alias("changed"),
    )


def moves_of(stats: DataFrame) -> DataFrame:
    """Per key: does its specs column hold only booleans, does its features column hold others."""
    return stats.groupBy("key").agg(
        F.bool_or((F.col("kind") == "specs") & F.col("boolean")).alias("to_features"),
        F.bool_or((F.col("kind") == "features") & ~F.col("boolean")).alias("to_specs"),
        (F.count("*") > 1).alias("in_both"),
    )


def kind_moves(eav: DataFrame) -> DataFrame:
    return moves_of(key_stats(eav))


def assign_kinds(eav: DataFrame, moves: DataFrame | None = None) -> DataFrame:
    """Boolean specs move to features, then non-boolean features move to specs; moved values overwrite.

    Only keys seen under both kinds can meet, so only their rows are grouped by product. `moves`
    replaces the moves found in `eav` itself; keys it does not know stay where they are.
    """
    no = F.lit(False)
    rows = eav.join(kind_moves(eav) if moves is None else moves, "key", "left").withColumns(
        {name: F.coalesce(name, no) for name in ("to_features", "to_specs", "in_both")}
    )
    from_specs = F.col("kind") == "specs"
    target = (
        F.when(from_specs & (~F.col("to_features") | F.col("to_specs")), "specs")
        .when(from_specs, "features")
        .when(F.col("to_specs"), "specs")
        .otherwise("features")
    )
    moved = F.when(from_specs, F.col("to_features")).otherwise(F.col("to_specs"))
    rank = F.when(from_specs, F.when(F.col("to_features"), 3).otherwise(1)).otherwise(2)
    placed = rows.select(
        "product_id",
        target.alias("kind"),
        F.when(moved, F.col("ord") + APPENDED).otherwise(F.col("ord")).alias("ord"),
        "key", "value", rank.alias("_rank"), "in_both",
    )
    alone = placed.where(~F.col("in_both")).select(*EAV_COLUMNS)
    meeting = (
        placed.where("in_both")
        .groupBy("product_id", "kind", "key")
        .agg(F.min("ord").alias("ord"), F.max_by("value", "_rank").alias("value"))
        .select(*EAV_COLUMNS)
    )
    return alone.unionByName(meeting)


def kind_stats(eav: DataFrame) -> DataFrame:
    """Fields that move each way, and values lost because a moved field overwrote another."""
    # One read: per product and key what is in both kinds, then per key which way it goes.
    boolean = F.lower(strip(F.col("value"))).isin(BOOLEAN_WORDS)

    def only_boolean(kind: str) -> Column:
        return F.bool_and(F.when((F.col("kind") == kind) & ~is_blank(F.col("value")), boolean))

    per_product = eav.groupBy("product_id", "key").agg(
        F.bool_or(F.col("kind") == "specs").alias("in_specs"), F.bool_or(F.col("kind") == "features").alias("in_features"),
        only_boolean("specs").alias("specs"), only_boolean("features").alias("features"),
    )
    per_key = per_product.groupBy("key").agg(
        (F.bool_or("in_specs") & F.coalesce(F.bool_and("specs"), F.lit(False))).alias("to_features"),
        (F.bool_or("in_features") & ~F.coalesce(F.bool_and("features"), F.lit(False))).alias("to_specs"),
        F.count_if(F.col("in_specs") & F.col("in_features")).alias("meeting"),
    )
    # A key that moves either way ends up in one kind: every product that had it in both loses one value.
    lost = F.sum(F.when(F.col("to_features") | F.col("to_specs"), F.col("meeting")).otherwise(0))
    return per_key.agg(
        F.count_if("to_features").alias("boolean_fields_in_specs"), F.count_if("to_specs").alias("non_boolean_fields_in_features"),
        F.coalesce(lost, F.lit(0)).alias("values_lost"),
    )


def residual_units(value: Column, units: list[str] = RESIDUAL_UNITS) -> Column:
    """Names of the units that still follow a number in the value."""
    value = plain_blanks(value)
    found = [F.when(value.rlike(rf"(?i)\b(\d+\.?\d*)\s*{re.escape(u)}\b"), u) for u in units]
    return F.array_compact(F.array(*found))


def validate(eav: DataFrame, units: list[str] = RESIDUAL_UNITS) -> DataFrame:
    """Issues: values that still hold a unit, and specs keys that differ only in case or separators."""
    def issues(value: Column) -> Column:
        return bind(residual_units(value, units), lambda found: F.when(value.rlike(r"\d") & (F.size(found) > 0), F.array(F.array_join(found, ","))))

    # Rows without a unit leave by `explode`, not by a filter: a filter is pushed below the columns it reads and would work
    # out an extracted value once for every unit looked for.
    with_units = eav.select(
        F.when(F.col("kind") == "specs", "units_in_values").otherwise("units_in_features").alias("issue"),
        "product_id", "key", "value", F.explode(bind(F.col("value"), issues)).alias("detail"),
    )
    per_name = Window.partitionBy("product_id", "_same").orderBy("ord")
    repeated = (
        eav.where("kind = 'specs'")
        .withColumn("_same", bare_key(F.col("key")))
        .withColumn("detail", F.first("key").over(per_name))
        .withColumn("_n", F.row_number().over(per_name))
        .where("_n > 1")
        .select(F.lit("duplicate_keys").alias("issue"), "product_id", "key", "value", "detail")
    )
    return with_units.unionByName(repeated)


def validation_summary(issues: DataFrame) -> DataFrame:
    return issues.agg(
        F.count("*").alias("issues"),
        F.count_if(F.col("issue") == "duplicate_keys").alias("duplicate_keys"),
        (F.count("*") == 0).alias("passed"),
    )
