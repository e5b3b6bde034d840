"""Stored model replies to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.rules import JSON_OBJECT

_REQUIRED = ["summary", "pros", "cons", "themes", "insights"]
_LISTS = ["pros", "cons", "themes"]


def unfenced(text: Column) -> Column:
    """Content of the first code fence, or the text itself."""
    tagged = F.contains(text, F.lit("```json"))
    after = F.when(tagged, F.split_part(text, F.lit("```json"), F.lit(2))).when(
        F.contains(text, F.lit("```")), F.split_part(text, F.lit("```"), F.lit(2))
    )
    return F.coalesce(F.split_part(after, F.lit("```"), F.lit(1)), text)


def ingest_responses(raw: DataFrame, column: str = "reply") -> DataFrame:
    """Adds the typed fields of a review reply; broken replies get the default row and an error.

    Lists that are not lists become empty, confidence is clamped to 0..1 and is 0.5 when absent.
    """
    body = F.regexp_extract(unfenced(F.col(column)), r"(?s)\{.*\}", 0)
    df = raw.withColumn("_v", F.try_parse_json(F.nullif(body, F.lit(""))))
    fields = {name: F.try_variant_get("_v", f"$.{name}", "variant") for name in _REQUIRED}
    complete = F.col("_v").isNotNull()
    for field in fields.values():
        complete = complete & field.isNotNull()
    missing = F.coalesce(*[F.when(fields[n].isNull(), F.concat(F.lit("Missing required field: "), F.lit(n))) for n in _REQUIRED])
    error = F.when(F.col("_v").isNull(), "No valid JSON found in response").otherwise(missing)
    confidence = F.coalesce(F.try_variant_get("_v", "$.confidence", "double"), F.lit(0.5))
    empty = F.array().cast("array<string>")
    df = df.withColumn("_ok", complete)

    def listed(name: str) -> Column:
        return F.coalesce(F.when(F.col("_ok"), F.try_variant_get("_v", f"$.{name}", "array<string>")), empty).alias(name)

    return df.select(
        *raw.columns,
        F.when(F.col("_ok"), F.try_variant_get("_v", "$.summary", "string")).otherwise("Unable to analyze reviews").alias("summary"),
        *[listed(name) for name in _LISTS],
        F.when(F.col("_ok"), F.try_variant_get("_v", "$.insights", "string")).otherwise("Analysis failed").alias("insights"),
        F.when(F.col("_ok"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), confidence))).otherwise(0.0).alias("confidence"),
        F.when(~F.col("_ok"), error).alias("error"),
    )


def pick_largest_object(raw: DataFrame, column: str = "reply") -> DataFrame:
    """Adds the JSON object with most keys among those in the text (one nesting level), earliest on a tie."""
    found = F.regexp_extract_all(column, F.lit(JSON_OBJECT), F.lit(0))
    valid = F.filter(
        F.transform(found, lambda j, i: F.struct((-F.size(F.json_object_keys(j))).alias("n"), i.alias("i"), j.alias("object"), F.try_parse_json(j).isNotNull().alias("valid"))),
        lambda s: s["valid"] & (s["n"] < 0),
    )
    return raw.withColumn("_best", F.array_min(valid)).select(
        *raw.columns, F.col("_best.object").alias("object"), (-F.col("_best.n")).alias("keys")
    )
