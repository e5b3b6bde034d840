"""Filter metadata: which values each attribute of a category offers, and of what type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.text import is_blank, plain_number_text, strip
from shelfwise.rules import BOOLEAN_FIELDS, METADATA_EXCLUDED_SPECS, NUMERIC_FIELD


def field_type(key: Column) -> Column:
    """Type by name: listed boolean fields, then numeric name patterns, else text."""
    return F.when(key.isin(BOOLEAN_FIELDS), "boolean").when(key.rlike(NUMERIC_FIELD), "number").otherwise("string")


def type_fields(eav: DataFrame) -> DataFrame:
    return eav.select("kind", "key").distinct().withColumn("field_type", field_type(F.col("key")))


def distinct_values(eav: DataFrame) -> DataFrame:
    """Distinct typed values per category, kind and key, one row each.

    A boolean field keeps yes/true/1 and no/false/0 only; a numeric field falls back to the text.
    Input needs a `category_id` column.
    """
    kept = eav.where(
        ~is_blank(F.col("value")) & ~((F.col("kind") == "specs") & F.col("key").isin(METADATA_EXCLUDED_SPECS))
    )
    typed = kept.withColumn("_type", field_type(F.col("key")))
    word = F.lower(strip(F.col("value")))
    boolean = F.when(word.isin("yes", "true", "1"), True).when(word.isin("no", "false", "0"), False)
    digits = F.regexp_extract(F.translate("value", "£$€", ""), r"^(-?\d+(?:\.\d+)?)", 1)
    as_number = F.when((F.col("_type") == "number") & (digits != ""), digits.cast("double"))
    as_boolean = F.when(F.col("_type") == "boolean", boolean)
    as_text = F.when((F.col("_type") != "boolean") & as_number.isNull(), F.col("value"))
    return (
        typed.select(
            "category_id", "kind", "key",
            as_number.alias("num_value"), as_boolean.alias("bool_value"), as_text.alias("text_value"),
        )
        .where("num_value is not null or bool_value is not null or text_value is not null")
        .distinct()
    )


def resolve_types(values: DataFrame) -> DataFrame:
    """One type per field: numbers only when they are at least as many as the texts, else all as text."""
    field = ["category_id", "kind", "key"]
    counts = values.groupBy(*field).agg(F.count("num_value").alias("_numbers"), F.count("text_value").alias("_texts"))
    mixed = (F.col("_numbers") > 0) & (F.col("_texts") > 0)
    numbers_win = F.col("_numbers") >= F.col("_texts")
    kept = values.join(counts, field).where(~mixed | ~numbers_win | F.col("num_value").isNotNull())
    to_text = mixed & ~numbers_win & F.col("num_value").isNotNull()
    return kept.select(
        *field,
        F.when(F.col("bool_value").isNotNull(), "boolean")
        .when(F.col("num_value").isNotNull() & ~to_text, "number").otherwise("string").alias("value_type"),
        F.when(~to_text, F.col("num_value")).alias("num_value"),
        "bool_value",
        F.when(to_text, plain_number_text(F.col("num_value"))).otherwise(F.col("text_value")).alias("text_value"),
    ).distinct()


def build_metadata(eav: DataFrame) -> DataFrame:
    """Value rows of every field of every category, ready to be written by category."""
    return resolve_types(distinct_values(eav))


def metadata_counts(metadata: DataFrame) -> DataFrame:
    """Fields and values per category and kind."""
    per_field = metadata.groupBy("category_id", "kind", "key").agg(F.count("*").alias("_n"))
    return per_field.groupBy("category_id", "kind").agg(F.count("*").alias("fields"), F.sum("_n").alias("values"))


def upsert_metadata(existing: DataFrame, new: DataFrame, preserve: list[str]) -> DataFrame:
    """Replace `field_values` per category; columns in `preserve` keep their stored content."""
    old = existing.select("category_id", F.lit(True).alias("_known"), *[F.col(c).alias(f"_old_{c}") for c in ["field_values", *preserve]])
    return new.withColumn("_fresh", F.lit(True)).join(old, "category_id", "full_outer").select(
        "category_id",
        F.when(F.col("_fresh"), F.col("field_values")).otherwise(F.col("_old_field_values")).alias("field_values"),
        *[F.coalesce(f"_old_{c}", c).alias(c) for c in preserve],
        F.when(F.col("_fresh").isNull(), "kept").when(F.col("_known"), "updated").otherwise("inserted").alias("action"),
    )
