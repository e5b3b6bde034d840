"""A catalog that follows a stream: its rows, and a key profile that is right after every batch.

The profile is a sum of changes. A product that arrives again takes its earlier rows out of the counts and puts its new ones
in; one that arrives late, with an older version than the stored one, changes nothing. A batch first commits its change
of the profile and then its rows, both under the batch's number, so a batch that is run again counts once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfwise.functions.text import is_blank
from shelfwise.operators import standardize as st
from shelfwise.plans.standardizing import RuleSet, StoredRules, product_rules
from shelfwise.schemas import EAV_COLUMNS
from shelfwise.session import cut_lineage
from shelfwise.sources.loads import LoadedTable

_ROWS = "product_id bigint, kind string, ord bigint, key string, value string, version bigint"
_PROFILE = "kind string, key string, products bigint, valued bigint, boolean bigint"
# Kind and key of the row that stands for a product itself, so that one without attributes is counted.
_PRODUCT = ""


class LiveCatalog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self._rows = LoadedTable(spark, f"{path}/rows", _ROWS, ["product_id"])
        self._profile = LoadedTable(spark, f"{path}/profile", _PROFILE, ["kind", "key"])

    def absorb(self, products: DataFrame, eav: DataFrame, load_id: str) -> None:
        """Take in products (product_id, version) and their rows (EAV columns); of a product's versions the highest counts."""
        latest = products.groupBy("product_id").agg(F.max("version").alias("version"))
        stored = self._rows.near(latest)
        known = stored.where(F.col("kind") == _PRODUCT).select("product_id", F.col("version").alias("_stored"))
        accepted = latest.join(known, "product_id", "left").where("_stored is null or version >= _stored").select("product_id", "version")
        own = eav.select(*EAV_COLUMNS, "version").join(accepted, ["product_id", "version"], "left_semi")
        itself = accepted.select(
            "product_id", F.lit(_PRODUCT).alias("kind"), F.lit(0).cast("bigint").alias("ord"), F.lit(_PRODUCT).alias("key"), F.lit(None).cast("string").alias("value"), "version"
        )
        fresh = cut_lineage(own.unionByName(itself))
        gone = stored.join(fresh.select("product_id").distinct(), "product_id", "left_semi")
        self._profile.append(_changes(fresh, gone), load_id)
        self._rows.upsert(fresh, load_id, lambda old, new: old.join(new.select("product_id").distinct(), "product_id", "left_anti").unionByName(new))

    def rows(self) -> DataFrame:
        """Attribute rows of all products, each in its highest version."""
        return self._rows.read().where(F.col("kind") != _PRODUCT).select(*EAV_COLUMNS)

    def stats(self) -> DataFrame:
        """Like `key_stats` of `rows`, from the profile alone."""
        sums = self._profile.read().where(F.col("kind") != _PRODUCT).groupBy("kind", "key").agg(*[F.sum(c).alias(c) for c in ("products", "valued", "boolean")])
        whole = (F.col("valued") > 0) & (F.col("valued") == F.col("boolean"))
        return sums.where("products > 0").select("kind", "key", "products", whole.alias("boolean"))

    def n_products(self) -> int:
        return self._profile.read().where(F.col("kind") == _PRODUCT).agg(F.coalesce(F.sum("products"), F.lit(0))).first()[0]

    def standardized(self, percent: float = 10.0) -> DataFrame:
        """Rows with covered keys in the kinds that the present profile gives them: what a full run over the same products gives."""
        stats = st.covered_keys(self.stats(), F.lit(self.n_products()), percent)
        kept = stats.where("kept") if percent > 0 else stats
        return st.assign_kinds(st.keep_keys(self.rows(), kept.select("kind", "key")), st.moves_of(kept))


def _changes(fresh: DataFrame, gone: DataFrame) -> DataFrame:
    """What the profile gains by the one and loses by the other."""
    signed = fresh.withColumn("_sign", F.lit(1)).unionByName(gone.withColumn("_sign", F.lit(-1)))
    valued = ~is_blank(F.col("value"))
    counts = signed.groupBy("kind", "key").agg(
        F.sum("_sign").alias("products"), F.sum(F.when(valued, F.col("_sign")).otherwise(0)).alias("valued"),
        F.sum(F.when(valued & st.boolean_word(F.col("value")), F.col("_sign")).otherwise(0)).alias("boolean"),
    )
    return counts.where("products <> 0 or valued <> 0 or boolean <> 0")


def live_stream(
    arriving: DataFrame, catalog: LiveCatalog, to_rows: Callable[[DataFrame], DataFrame], rules: RuleSet | StoredRules, value_map: DataFrame, checkpoint: str,
) -> StreamingQuery:
    """Every arriving batch of products (product_id, version, ...) through the product-local rules into the live catalog.

    `to_rows` gives a batch's attribute rows. Several versions of a product may come in one batch; the highest counts.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        newest = batch.groupBy("product_id").agg(F.max_by(F.struct(*[c for c in batch.columns if c != "product_id"]), "version").alias("_row"))
        newest = cut_lineage(newest.select("product_id", "_row.*"))
        local = st.normalize_values(product_rules(to_rows(newest), rules), value_map).select(*EAV_COLUMNS)
        catalog.absorb(newest.select("product_id", "version"), local.join(newest.select("product_id", "version"), "product_id"), f"batch-{batch_id}")

    return arriving.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
