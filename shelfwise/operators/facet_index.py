"""Facet counts under any structured filter, from stored bitmaps instead of products.

Products of a category are numbered without gaps; 32,768 numbers are one bucket. Facets keep a bitmap for each label and
bucket; attributes keep (value, bucket, bit) rows sorted by value, from which a condition's bitmap is made. A filter is
the intersection of its conditions, and counting a label is counting the bits it shares with that.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.operators.search import FilterSpec, facet_labels

PAGE_ROWS = 2_048
_SCHEMAS = {
    "bitmaps": "facet string, label string, bucket bigint, bitmap binary, category_id bigint",
    "values": "attribute string, number double, text string, bucket bigint, bit bigint, category_id bigint",
}


def numbered(products: DataFrame) -> DataFrame:
    """`products` with `bucket` and `bit`: their number in their category, from 1, without gaps, in the order of a hash.

    Numbers are counted inside 4,096 parts of a category's hashes and shifted by the sizes of the parts before.
    """
    hashed = products.withColumn("_md5", F.md5(F.col("product_id").cast("string"))).withColumn("_part", F.substring("_md5", 1, 3))
    before = Window.partitionBy("category_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = hashed.groupBy("category_id", "_part").agg(F.count("*").alias("_n"))
    offsets = sizes.select("category_id", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("category_id", "_part").orderBy("_md5", "product_id"))
    place = F.col("_before") + F.col("_inside")
    return hashed.withColumn("_inside", inside).join(offsets, ["category_id", "_part"]).withColumns({
        "bucket": F.bitmap_bucket_number(place), "bit": F.bitmap_bit_position(place),
    }).drop("_md5", "_part", "_inside", "_before")


def _values(products: DataFrame) -> Column:
    """(attribute, number, text) of everything that a filter may ask for."""
    def value(attribute: Column, number: Column, text: Column) -> Column:
        return F.struct(attribute.alias("attribute"), number.alias("number"), text.alias("text"))

    none, empty = F.lit(None).cast("double"), F.array().cast("array<struct<key:string,value:string>>")
    specs = F.transform(F.coalesce(F.map_entries("specs"), empty), lambda e: value(F.concat(F.lit("specs."), e["key"]), e["value"].try_cast("double"), e["value"]))
    features = F.transform(F.coalesce(F.map_entries("features"), empty), lambda e: value(F.concat(F.lit("features."), e["key"]), none, e["value"]))
    own = F.array(
        value(F.lit("price"), F.col("price").cast("double"), F.lit(None).cast("string")), value(F.lit("score"), F.col("score").cast("double"), F.lit(None).cast("string")),
        value(F.lit("brand"), none, F.col("brand")), value(F.lit("all"), none, F.lit("")),
    )
    return F.filter(F.concat(own, specs, features), lambda v: v["number"].isNotNull() | v["text"].isNotNull())


def write_facet_index(products: DataFrame, path: str, price_step: int = 100) -> None:
    """Store both tables by category, sorted as they are asked for."""
    placed = numbered(products)

    def store(df: DataFrame, name: str, *order: str) -> None:
        sorted_rows = df.repartitionByRange("category_id", *order).sortWithinPartitions("category_id", *order)
        sorted_rows.write.option("parquet.page.row.count.limit", str(PAGE_ROWS)).partitionBy("category_id").parquet(f"{path}/{name}")

    labels = placed.select("category_id", "bucket", "bit", F.inline(facet_labels(price_step))).where("label is not null")
    store(labels.groupBy("category_id", "facet", "label", "bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap")), "bitmaps", "facet", "label", "bucket")
    store(placed.select("category_id", "bucket", "bit", F.inline(_values(placed))).select(*_order("values")), "values", "attribute", "number", "text")


def _order(name: str) -> list[str]:
    return [c.strip().split(" ")[0] for c in _SCHEMAS[name].split(",")]


@dataclass(frozen=True)
class FacetIndex:
    bitmaps: DataFrame
    values: DataFrame

    def _bits(self, category_id: int, condition: Column) -> DataFrame:
        """(bucket, bitmap) of the products with a value that meets the condition."""
        rows = self.values.where((F.col("category_id") == category_id) & condition)
        return rows.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))

    def matches(self, category_id: int, spec: FilterSpec) -> DataFrame:
        """(bucket, bitmap, out): products that meet all conditions, and those that an excluded feature takes out again."""
        wanted = [F.col("attribute") == "all"]
        for key, rule in spec.specs.items():
            wanted += _conditions(f"specs.{key}", rule)
        wanted += [_text(f"features.{f}", ["Yes"]) for f in spec.required]
        wanted += _conditions("price", {"min": spec.price_min, "max": spec.price_max}) if spec.price_min is not None or spec.price_max is not None else []
        wanted += [_text("brand", spec.brands)] if spec.brands else []
        wanted += _conditions("score", {"min": spec.score_min}) if spec.score_min is not None else []
        every = reduce(DataFrame.unionAll, [self._bits(category_id, c) for c in wanted])
        met = every.groupBy("bucket").agg(F.bitmap_and_agg("bitmap").alias("bitmap"), F.count("*").alias("_n")).where(F.col("_n") == len(wanted))
        out = self._bits(category_id, reduce(lambda a, b: a | b, [_text(f"features.{f}", ["Yes"]) for f in spec.excluded], F.lit(False)))
        return met.drop("_n").join(out.withColumnRenamed("bitmap", "out"), "bucket", "left")

    def count(self, category_id: int, spec: FilterSpec) -> DataFrame:
        """One row: how many products meet the filter."""
        matched = self.matches(category_id, spec)
        return _shared(matched.select("bucket", "bitmap", "out"), ["bucket"], ["bitmap"]).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("products"))

    def facets(self, category_id: int, spec: FilterSpec) -> DataFrame:
        """(facet, label, products) of the products that meet the filter, as a scan of them would count."""
        labels = self.bitmaps.where(F.col("category_id") == category_id).select("facet", "label", "bucket", F.col("bitmap").alias("own"))
        both = labels.join(self.matches(category_id, spec), "bucket")
        counted = _shared(both, ["facet", "label", "bucket"], ["own", "bitmap"]).groupBy("facet", "label").agg(F.sum("n").alias("products"))
        return counted.where("products > 0")


def _shared(rows: DataFrame, keys: list[str], bitmaps: list[str]) -> DataFrame:
    """(keys, n): bits that a row's bitmaps share, less those that `out` shares with them, too."""
    def bits(columns: list[str], among: DataFrame, sign: int) -> DataFrame:
        each = among.select(*keys, F.explode(F.array(*columns)).alias("_map"))
        return each.groupBy(*keys).agg((F.bitmap_count(F.bitmap_and_agg("_map")) * sign).alias("n"))

    return bits(bitmaps, rows, 1).unionByName(bits([*bitmaps, "out"], rows.where("out is not null"), -1))


def _text(attribute: str, texts: list) -> Column:
    return (F.col("attribute") == attribute) & F.col("text").isin([str(t) for t in texts])


def _conditions(attribute: str, rule: dict) -> list[Column]:
    """Conditions of one rule of a filter, {min, max}, {in} or {exact}, over the rows of an attribute."""
    own = F.col("attribute") == attribute
    if "min" in rule or "max" in rule:
        low, high = rule.get("min"), rule.get("max")
        ends = ([F.col("number") >= float(low)] if low is not None else []) + ([F.col("number") <= float(high)] if high is not None else [])
        return [reduce(lambda a, b: a & b, ends, own)] if ends else []
    if "in" in rule:
        return [_text(attribute, rule["in"])]
    return [_text(attribute, [rule["exact"]])] if "exact" in rule else []


def read_facet_index(spark: SparkSession, path: str) -> FacetIndex:
    return FacetIndex(**{name: spark.read.schema(schema).parquet(f"{path}/{name}") for name, schema in _SCHEMAS.items()})
