"""The whole standardization job."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.tables import rule_table
from shelfwise.operators import standardize as st
from shelfwise.schemas import EAV_COLUMNS
from shelfwise.session import cut_lineage


@dataclass
class RuleSet:
    """Rules of one catalog; merges maps alias to canonical, unit_rules key to (units, new key)."""

    merges: dict[str, str] = field(default_factory=dict)
    deletions: list[str] = field(default_factory=list)
    unit_rules: dict[str, tuple[list[str], str]] = field(default_factory=dict)
    remove_specs: list[str] = field(default_factory=list)
    remove_features: list[str] = field(default_factory=list)

    def merge_table(self, spark) -> DataFrame:
        pairs = self.merges or {"": ""}
        return rule_table(spark, {"alias": list(pairs), "canonical": list(pairs.values())})

    def unit_table(self, spark) -> DataFrame:
        rules = self.unit_rules or {"": (["?"], "")}
        return rule_table(spark, {
            "key": list(rules),
            "units": [units for units, _ in rules.values()],
            "new_key": [new_key for _, new_key in rules.values()],
        })

    def drop_table(self, spark) -> DataFrame:
        drops = [("specs", k) for k in [*self.deletions, *self.remove_specs]] + [("features", k) for k in [*self.deletions, *self.remove_features]]
        kinds, keys = zip(*(drops or [("", "")]))
        return rule_table(spark, {"kind": list(kinds), "key": list(keys)})


@dataclass
class StoredRules:
    """Rules as tables, of any size: merges (alias, canonical), units (key, units, new_key), drops (kind, key)."""

    merges: DataFrame
    units: DataFrame
    drops: DataFrame

    def merge_table(self, spark) -> DataFrame:
        return self.merges

    def unit_table(self, spark) -> DataFrame:
        return self.units

    def drop_table(self, spark) -> DataFrame:
        return self.drops


MAP_SCHEMA = """merges map<string,string>, deletions array<string>, unit_extractions map<string,struct<units:array<string>,new_key:string>>,
  cross_category_removals struct<specs:array<string>,features:array<string>>"""


def read_rules(spark: SparkSession, path: str) -> StoredRules:
    """Rules of a stored unification map, one JSON document or a folder of them; parts that are missing hold no rules.

    Where documents disagree on an alias or on a key's units, the document whose file name sorts last decides.
    """
    maps = spark.read.schema(MAP_SCHEMA).json(path, multiLine=True, mode="FAILFAST").select("*", F.col("_metadata.file_name").alias("file"))

    def last(rules: DataFrame, key: str, rule: str) -> DataFrame:
        return rules.groupBy(key).agg(F.max_by(rule, "file").alias(rule))

    both = maps.select(F.explode("deletions").alias("key")).select(F.explode(F.array(F.lit("specs"), F.lit("features"))).alias("kind"), "key")
    drops = both
    for kind in ("specs", "features"):
        drops = drops.unionByName(maps.select(F.lit(kind).alias("kind"), F.explode(f"cross_category_removals.{kind}").alias("key")))
    units = last(maps.select("file", F.explode("unit_extractions").alias("key", "rule")), "key", "rule")
    return StoredRules(
        last(maps.select("file", F.explode("merges").alias("alias", "canonical")), "alias", "canonical"),
        units.select("key", "rule.units", "rule.new_key"),
        drops.distinct(),
    )


def write_rules(spark: SparkSession, rules: RuleSet, path: str) -> None:
    """Store a rule set as a unification map."""
    document = {
        "merges": rules.merges, "deletions": rules.deletions,
        "unit_extractions": {key: {"units": units, "new_key": new_key} for key, (units, new_key) in rules.unit_rules.items()},
        "cross_category_removals": {"specs": rules.remove_specs, "features": rules.remove_features},
    }
    spark.range(1).select(F.lit(json.dumps(document)).alias("value")).write.mode("overwrite").text(path)


def product_rules(eav: DataFrame, rules: RuleSet | StoredRules) -> DataFrame:
    """The product-local part: units, merges, deletions, cross-kind removals. One shuffle where the rules are small."""
    spark = eav.sparkSession
    units = st.extract_units(eav, rules.unit_table(spark))
    unified = st.resolve_and_unify(units, rules.merge_table(spark))
    return unified.join(rules.drop_table(spark), ["kind", "key"], "left_anti").select(*EAV_COLUMNS)


def standardize(eav: DataFrame, products: DataFrame, rules: RuleSet | StoredRules, value_map: DataFrame, percent: float = 10.0) -> DataFrame:
    """Units, keys, coverage, values and kinds.

    Runs a job: the product-local result is written once to the shared folder, as columns. Coverage and kind moves
    follow from counts of its keys, which the plan computes once and uses twice; a table of keys that is small when
    it has been computed is broadcast by the adaptive join.
    """
    n_products = products.agg(F.count("*").alias("n")).scalar()
    local = cut_lineage(product_rules(eav, rules))
    valued = st.normalize_values(local, value_map).select(*EAV_COLUMNS)
    stats = st.covered_keys(st.key_stats(valued), n_products, percent)
    kept = stats.where("kept") if percent > 0 else stats
    covered = st.keep_keys(valued, kept.select("kind", "key"))
    return st.assign_kinds(covered, st.moves_of(kept))
