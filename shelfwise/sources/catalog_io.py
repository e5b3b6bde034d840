"""Catalog files and the stage outputs derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.tables import dense_ids
from shelfwise.schemas import CATALOG_COUNTS, PRODUCT_FIELDS, nested_schema
from shelfwise.session import cut_lineage

STAGES = ("raw", "key_analysis", "unification_map", "standardized", "metadata")


def _documents(spark: SparkSession, path: str, multi_line: bool, fields: dict[str, list[str]] | None) -> tuple[DataFrame, dict]:
    places = {name: ((fields or {}).get(name, default), kind) for name, (default, kind) in PRODUCT_FIELDS.items()}
    leaves = {place: kind for found, kind in places.values() for place in found}
    schema = T.StructType([
        T.StructField("products", T.ArrayType(nested_schema(leaves))), *CATALOG_COUNTS.fields, T.StructField("_broken", T.StringType()),
    ])
    files = spark.read.schema(schema).option("columnNameOfCorruptRecord", "_broken").json(path, multiLine=multi_line)
    return files.withColumn("source_file", F.col("_metadata.file_path")), places


def read_catalog(spark: SparkSession, path: str, multi_line: bool = True, fields: dict[str, list[str]] | None = None) -> DataFrame:
    """Products of catalog files, one row each, with the file and position they came from.

    With `multi_line` every file is one JSON document and one task; land large catalogs as many
    files, or as lines with one document per line and `multi_line=False`, which can be split.
    `fields` says where files have a field, as `{"reviews.ratingScore": ["rating.value"]}`; see `PRODUCT_FIELDS`.
    Documents that cannot be read as a whole are left to `rejected_documents`.
    """
    files, places = _documents(spark, path, multi_line, fields)
    envelope = [F.col(c).alias(f"file_{c}") for c in ("total", "url")]
    whole = files.where("_broken is null and products is not null")
    exploded = whole.select("source_file", *envelope, F.posexplode("products").alias("position", "p"))

    def field(name: str) -> Column:
        found = [F.col(f"p.{place}") for place in places[name][0]]
        return F.coalesce(*found) if len(found) > 1 else found[0]

    plain = [field(n).alias(n) for n in places if "." not in n]
    reviews = F.struct(*[field(n).alias(n.partition(".")[2]) for n in places if n.startswith("reviews.")])
    empty = F.lit(True)
    for name in places:
        if name.startswith("reviews."):
            empty = empty & field(name).isNull()
    return exploded.select("source_file", "position", "file_total", "file_url", *plain, F.when(~empty, reviews).alias("reviews"))


def rejected_documents(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Documents that `read_catalog` does not read: source_file, reason, and the document if it is no JSON.

    Read and rejected documents together are all that landed.
    """
    files, _ = _documents(spark, path, multi_line, None)
    reason = F.when(F.col("_broken").isNotNull(), "broken document").when(F.col("products").isNull(), "no products")
    return files.select("source_file", reason.alias("reason"), F.col("_broken").alias("document")).where("reason is not null")


def number_products(products: DataFrame) -> DataFrame:
    """Dense product ids, one for each row: products of one name in several places keep ids of their own.

    Runs a job: rows are numbered as they are written to the shared folder, so a row keeps its number.
    """
    rows = cut_lineage(products.withColumn("_row", F.monotonically_increasing_id().cast("string")))
    return dense_ids(rows, "_row", "product_id", F.lit(0)).drop("_row")


def stage_path(base: str, stage: str) -> str:
    """`out/air-fryers.json` and `metadata` -> `out/air-fryers.metadata`"""
    if stage not in STAGES:
        raise ValueError(f"unknown stage {stage!r}")
    stem = base.removesuffix(".json")
    return stem if stage == "raw" else f"{stem}.{stage}"


def write_stage(df: DataFrame, base: str, stage: str, partition_by: list[str] | None = None, format: str = "parquet") -> str:
    """Write one stage output, replacing an earlier one; returns its path."""
    path = stage_path(base, stage)
    writer = df.write.mode("overwrite").format(format)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)
    return path

