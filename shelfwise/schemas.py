"""Schemas of the catalog tables and the long attribute table."""

from pyspark.sql import types as T

LINK = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("url", T.StringType()),
])

IMAGES = T.StructType([T.StructField(view, T.StringType()) for view in ("front", "side", "rear")])

ATTRIBUTES = T.MapType(T.StringType(), T.StringType())
TEXTS = T.ArrayType(T.StringType())

# Fields of a product and where a catalog file has them: the first place that is not null counts. specs and features
# stay maps: their keys are data, not schema.
PRODUCT_FIELDS = {
    "name": (["name"], T.StringType()),
    "price": (["price"], T.StringType()),
    "sourceUrl": (["sourceUrl"], T.StringType()),
    "specs": (["specs"], ATTRIBUTES),
    "features": (["features"], ATTRIBUTES),
    "retailerLinks": (["retailerLinks"], T.ArrayType(LINK)),
    "images": (["images"], IMAGES),
    "reviews.summary": (["reviews.sentiment.summary", "reviews.summary"], T.StringType()),
    "reviews.pros": (["reviews.sentiment.pros", "reviews.pros"], TEXTS),
    "reviews.cons": (["reviews.sentiment.cons", "reviews.cons"], TEXTS),
    "reviews.ratingScore": (["reviews.ratingScore"], T.DoubleType()),
}

CATALOG_COUNTS = T.StructType([
    T.StructField("total", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("successful_enriched", T.LongType()),
    T.StructField("failed_enriched", T.LongType()),
    T.StructField("total_specs_extracted", T.LongType()),
    T.StructField("total_features_extracted", T.LongType()),
])


def nested_schema(leaves: dict[str, T.DataType]) -> T.StructType:
    """Struct type with the given dotted leaf paths."""
    tree: dict[str, dict[str, T.DataType] | T.DataType] = {}
    for path, kind in leaves.items():
        head, _, rest = path.partition(".")
        if rest:
            tree.setdefault(head, {})[rest] = kind
        else:
            tree[head] = kind
    return T.StructType([T.StructField(k, nested_schema(v) if isinstance(v, dict) else v) for k, v in tree.items()])


# The long attribute table. `ord` is the position of the key inside its product and kind.
EAV = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("kind", T.StringType()),
    T.StructField("ord", T.LongType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])
EAV_COLUMNS = EAV.fieldNames()

# Keys appended after all existing keys of a product get `ord + APPENDED`; positions inside one
# product are 32-bit, so the two ranges cannot meet.
APPENDED = 1 << 32
