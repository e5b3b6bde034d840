"""English search over a stored index: stems, stop words, weights by field, positions, and the best rows by block maxima.

Products of a category lie in blocks of falling score. The index knows each term's largest weight in each block, so a
search first scores the blocks that promise most, and then only those that can still reach the rows found so far.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import english
from shelfwise.operators.search import Clause, postings_of, price_points, query_clauses, stand_in_order, terms_of
from shelfwise.session import cut_lineage

FIELD_WEIGHTS = {"name": 1.0, "brand": 0.4, "model": 0.4, "specs": 0.2, "features": 0.1}
BLOCK_ROWS = 256
# Blocks scored first; enough for a page of results, whatever the size of the category.
FIRST_BLOCKS = 16
SCORE_BANDS = 100
# Rows of a Parquet page: how finely a condition on term and block is answered.
PAGE_ROWS = 512


def english_tokens(products: DataFrame, weights: dict[str, float] = FIELD_WEIGHTS) -> Column:
    """Tokens (term, position, weight) of a product's fields in the order of `weights`; positions count stop words, too."""
    def text(field: str) -> Column:
        if not products.schema[field].dataType.typeName() == "map":
            return F.coalesce(F.col(field), F.lit(""))
        entries = F.coalesce(F.map_entries(field), F.array().cast("array<struct<key:string,value:string>>"))
        return F.array_join(F.transform(entries, lambda e: F.concat_ws(" ", e["key"], e["value"])), " ")

    def words(field: str, weight: float) -> Column:
        return F.transform(terms_of(text(field)), lambda t: F.struct(t.alias("word"), F.lit(weight).alias("weight")))

    placed = F.transform(F.concat(*[words(f, w) for f, w in weights.items() if f in products.columns]), lambda t, i: F.struct(t["word"].alias("word"), i.alias("position"), t["weight"].alias("weight")))
    return F.transform(F.filter(placed, lambda t: ~english.stop_word(t["word"])), lambda t: F.struct(
        english.stem(t["word"]).alias("term"), t["position"].alias("position"), t["weight"].alias("weight")
    ))


def english_index(products: DataFrame, weights: dict[str, float] = FIELD_WEIGHTS) -> DataFrame:
    """Postings (category_id, product_id, term, weight, positions), inside each product's row.

    `weight` adds up the weights of the fields in which the term occurs; positions are distances, each from the one before.
    """
    return products.select("category_id", "product_id", F.inline(postings_of(english_tokens(products, weights))))


def in_blocks(products: DataFrame, rows: int = BLOCK_ROWS) -> DataFrame:
    """`products` with `block`: bands of falling score, each cut by a hash into blocks of about `rows` products.

    Bands are counted before they are cut, so a score that most products share is many blocks, not one.
    """
    whole = F.floor(F.coalesce("score", F.lit(0.0)) / 100 * SCORE_BANDS)
    band = (F.lit(SCORE_BANDS) - F.least(F.greatest(whole, F.lit(0)), F.lit(SCORE_BANDS))).cast("bigint")
    banded = products.withColumn("_band", band)
    parts = banded.groupBy("category_id", "_band").agg((F.floor(F.count("*") / rows) + 1).alias("_parts"))
    cut = F.pmod(F.xxhash64("product_id"), F.col("_parts"))
    placed = banded.join(parts, ["category_id", "_band"])
    return placed.withColumn("block", F.shiftleft("_band", 32) + cut).drop("_band", "_parts")


@dataclass(frozen=True)
class RankedIndex:
    """Four tables by category: postings and term bounds by term and block, what ranking needs of products, and block bounds."""

    postings: DataFrame
    bounds: DataFrame
    products: DataFrame
    blocks: DataFrame


_SCHEMAS = {
    "postings": "term string, block bigint, product_id bigint, weight double, positions array<int>, category_id bigint",
    "bounds": "term string, block bigint, n bigint, max_weight double, category_id bigint",
    "products": "block bigint, product_id bigint, price double, brand string, score double, category_id bigint",
    "blocks": "block bigint, n bigint, max_score double, min_price double, max_price double, category_id bigint",
}


def write_ranked_index(products: DataFrame, path: str, weights: dict[str, float] = FIELD_WEIGHTS, block_rows: int = BLOCK_ROWS) -> None:
    """Store the index in four folders under `path`. A category that holds most products is written by many tasks."""
    placed = in_blocks(products, block_rows)

    def store(df: DataFrame, name: str, *order: str) -> DataFrame:
        sorted_rows = df.repartitionByRange("category_id", *order).sortWithinPartitions("category_id", *order)
        sorted_rows.write.option("parquet.page.row.count.limit", str(PAGE_ROWS)).partitionBy("category_id").parquet(f"{path}/{name}")
        return df.sparkSession.read.schema(_SCHEMAS[name]).parquet(f"{path}/{name}")

    slim = placed.select("category_id", "block", "product_id", F.col("price").cast("double").alias("price"), "brand", F.col("score").cast("double").alias("score"))
    rows = placed.select("category_id", "block", "product_id", F.inline(postings_of(english_tokens(products, weights))))
    # Ranges are found from a sample, which walks over all rows first: they are stored, so that stems are worked out once.
    found = cut_lineage(rows.select("category_id", "term", "block", "product_id", "weight", "positions"))
    postings = store(found, "postings", "term", "block")
    bounds = postings.groupBy("category_id", "term", "block").agg(F.count("*").alias("n"), F.max("weight").alias("max_weight"))
    store(bounds, "bounds", "term", "block")
    stored = store(slim, "products", "block")
    stats = stored.groupBy("category_id", "block").agg(
        F.count("*").alias("n"), F.max("score").alias("max_score"), F.min("price").alias("min_price"), F.max("price").alias("max_price")
    )
    store(stats, "blocks", "block")


def read_ranked_index(spark: SparkSession, path: str) -> RankedIndex:
    return RankedIndex(**{name: spark.read.schema(schema).parquet(f"{path}/{name}") for name, schema in _SCHEMAS.items()})


@dataclass(frozen=True)
class _Analysed:
    """A query in stems: clauses of required and excluded terms and of phrases, a phrase being (term, offset) pairs."""

    clauses: list[tuple[set[str], set[str], list[list[tuple[str, int]]], list[list[tuple[str, int]]]]]

    @property
    def wanted(self) -> list[str]:
        return sorted(set().union(*[c[0] for c in self.clauses]))

    @property
    def placed(self) -> list[str]:
        return sorted({t for c in self.clauses for p in c[2] + c[3] for t, _ in p})

    @property
    def known(self) -> list[str]:
        return sorted({t for c in self.clauses for t in c[0] | c[1]} | set(self.placed))


def analyse(spark: SparkSession, query: str) -> _Analysed:
    """The query's words go through the same column expressions as the products'. Stop words ask for nothing, but keep
    their place in a phrase; an alternative of stop words only is none."""
    clauses = query_clauses(query)
    words = sorted({w for c in clauses for w in c.required + c.excluded + [w for p in c.phrases + c.excluded_phrases for w in p]})
    listed = F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")
    stems = spark.sql("select 1").select(F.transform(F.filter(listed, lambda w: ~english.stop_word(w)), lambda w: F.struct(w.alias("w"), english.stem(w).alias("s"))))
    stem = {r.w: r.s for r in stems.first()[0]}

    def phrase(words: list[str]) -> list[tuple[str, int]]:
        return [(stem[w], i) for i, w in enumerate(words) if w in stem]

    def of(c: Clause):
        phrases, excluded = [phrase(p) for p in c.phrases], [phrase(p) for p in c.excluded_phrases]
        return {stem[w] for w in c.required if w in stem}, {stem[w] for w in c.excluded if w in stem}, [p for p in phrases if len(p) > 1], [p for p in excluded if p]

    return _Analysed([c for c in map(of, clauses) if c[0] or c[1] or c[3]])


def _saturated(weight: Column) -> Column:
    return weight / (weight + 1.0)


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


@dataclass(frozen=True)
class RankedSearch:
    """One search; `candidates`, `scored` and `best` are its steps."""

    index: RankedIndex
    category_id: int
    query: _Analysed | None = None
    price_min: float | None = None
    price_max: float | None = None
    brands: list[str] | None = None
    soft_price: bool = False

    def _of_category(self, table: DataFrame) -> DataFrame:
        return table.where(F.col("category_id") == self.category_id)

    def candidates(self) -> DataFrame:
        """(block, n, bound): blocks that may hold a match, and what no product of theirs can exceed."""
        blocks = self._of_category(self.index.blocks)
        low, high = self.price_min, self.price_max
        if low is not None and not self.soft_price:
            blocks = blocks.where(F.col("max_price") >= low)
        if high is not None and not self.soft_price:
            blocks = blocks.where(F.col("min_price") <= high)
        nearest = F.col("min_price")
        if low is not None:
            nearest = F.when(F.col("max_price") < low, F.col("max_price")).when(F.col("min_price") > low, F.col("min_price")).otherwise(F.lit(float(low)))
        bound = F.coalesce(price_points(nearest, low, high), F.lit(0.0)) + (20.0 if self.brands is not None else 0.0)
        bound = bound + F.coalesce(F.col("max_score") / 10, F.lit(0.0))
        if self.query is None:
            return blocks.select("block", "n", bound.alias("bound"))
        wanted = self.query.wanted
        terms = self._of_category(self.index.bounds).where(F.col("term").isin(wanted)).groupBy("block").agg(
            F.lit(1).alias("_any"), *[F.max(F.when(F.col("term") == t, _saturated(F.col("max_weight")))).alias(f"_w{i}") for i, t in enumerate(wanted)]
        )
        place = {t: F.col(f"_w{i}") for i, t in enumerate(wanted)}
        possible = reduce(lambda a, b: a | b, [_all([place[t].isNotNull() for t in sorted(c[0])]) for c in self.query.clauses], F.lit(False))
        text = sum((F.coalesce(w, F.lit(0.0)) for w in place.values()), F.lit(0.0)) / max(len(wanted), 1) * 40
        return blocks.join(terms, "block", "left").where(possible).select("block", "n", (bound + text).alias("bound"))

    def scored(self, blocks: DataFrame | None = None, first: int | None = None, last: int | None = None) -> DataFrame:
        """Every match with its relevance, of all blocks or of the given ones, which lie between `first` and `last`."""
        def among(table: DataFrame) -> DataFrame:
            table = self._of_category(table)
            if first is not None:
                table = table.where(F.col("block").between(first, last))
            return table if blocks is None else table.join(blocks.select("block"), "block", "left_semi")

        found = among(self.index.products)
        if self.price_min is not None and not self.soft_price:
            found = found.where(F.col("price") >= self.price_min)
        if self.price_max is not None and not self.soft_price:
            found = found.where(F.col("price") <= self.price_max)
        if self.brands is not None:
            found = found.where(F.col("brand").isin(self.brands))
        found = self._matched(found, among) if self.query is not None else found.withColumn("text_score", F.lit(0.0))
        relevance = (
            F.col("text_score") * 40 + price_points(F.col("price"), self.price_min, self.price_max)
            + (20.0 if self.brands is not None else 0.0) + F.coalesce(F.col("score") / 10, F.lit(0.0))
        )
        return found.withColumn("relevance_score", relevance)

    def _matched(self, products: DataFrame, among) -> DataFrame:
        q = self.query
        wanted = F.when(F.col("term").isin(q.wanted), _saturated(F.col("weight")))
        hits = among(self.index.postings.where(F.col("term").isin(q.known))).groupBy("product_id").agg(
            F.collect_set("term").alias("_terms"), (F.coalesce(F.sum(wanted), F.lit(0.0)) / max(len(q.wanted), 1)).alias("text_score"),
            *[F.max(F.when(F.col("term") == t, F.col("positions"))).alias(f"_at{i}") for i, t in enumerate(q.placed)],
        )
        at = {t: F.col(f"_at{i}") for i, t in enumerate(q.placed)}

        def stands(phrase: list[tuple[str, int]]) -> Column:
            return stand_in_order([(at[t], offset) for t, offset in phrase])

        accepted = F.lit(False)
        for required, excluded, phrases, excluded_phrases in q.clauses:
            holds = [F.array_contains("_terms", t) for t in sorted(required)] + [~F.array_contains("_terms", t) for t in sorted(excluded)]
            accepted = accepted | _all(holds + [stands(p) for p in phrases] + [~stands(p) for p in excluded_phrases])
        open_ended = any(not c[0] for c in q.clauses)
        joined = products.join(hits, "product_id", "left" if open_ended else "inner")
        joined = joined.withColumn("_terms", F.coalesce("_terms", F.array().cast("array<string>")))
        return joined.where(accepted).withColumn("text_score", F.coalesce("text_score", F.lit(0.0))).drop("_terms", *[f"_at{i}" for i in range(len(at))])

    def best(self, limit: int = 200) -> DataFrame:
        """The first `limit` matches by relevance, score and id, the same as of all blocks.

        The most promising blocks are scored first. If they hold `limit` matches, only blocks whose bound reaches the last of
        these are scored; the driver gets one row of each step, and FIRST_BLOCKS block numbers.
        """
        candidates = self.candidates()
        promising = [r["block"] for r in candidates.orderBy(F.desc("bound"), "block").limit(FIRST_BLOCKS).collect()]
        if not promising:
            return self._ordered(self.scored(candidates), limit)
        trial = self.scored(candidates.where(F.col("block").isin(promising)), min(promising), max(promising))
        n, least = self._ordered(trial, limit).agg(F.count("*"), F.min(F.coalesce("relevance_score", F.lit(float("-inf"))))).first()
        reach = candidates if n < limit else candidates.where(F.col("bound") >= least - 1e-9)
        first, last = reach.agg(F.min("block"), F.max("block")).first()
        return self._ordered(self.scored(reach, first, last), limit)

    @staticmethod
    def _ordered(found: DataFrame, limit: int) -> DataFrame:
        return found.orderBy(F.desc("relevance_score"), F.desc_nulls_last("score"), "product_id").limit(limit)


def ranked_search(
    index: RankedIndex, category_id: int, text: str | None = None, price_min: float | None = None, price_max: float | None = None,
    brands: list[str] | None = None, limit: int = 200, soft_price: bool = False,
) -> DataFrame:
    """Products of a category by relevance: text up to 40, price 30, brand 20, rating 10 points.

    Text relevance is the mean over the query's stems of w / (w + 1), w adding up the weights of the fields that hold the
    stem. A query of stop words only finds nothing. Join the result to the catalog for more columns.
    """
    spark = index.products.sparkSession
    query = None if text is None or not re.search(r"\S", text) else analyse(spark, text)
    return RankedSearch(index, category_id, query, price_min, price_max, brands, soft_price).best(limit)
