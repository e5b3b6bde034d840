"""Catalog search, facets, rankings and statistics."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.functions.arrays import bind, differences, running_sum
from shelfwise.functions.ranks import join_on, percentiles, ranked_values
from shelfwise.rules import CAPACITY_TIERS, INTENT_WORDS, PRICE_INTENTS, SCORE_TIERS, SIZE_INTENTS

# --- index --------------------------------------------------------------------------------------


def terms_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def search_text(products: DataFrame) -> Column:
    """Name, brand, model and the keys and values of both attribute maps as one text."""
    def flat(m: str) -> Column:
        return F.array_join(F.transform(F.map_entries(m), lambda e: F.concat_ws(" ", e["key"], e["value"])), " ")

    parts = [F.col(c) for c in ("name", "brand", "model") if c in products.columns]
    return F.concat_ws(" ", *parts, *[flat(c) for c in ("specs", "features") if c in products.columns])


def build_index(products: DataFrame, text: Column | None = None, positions: bool = False) -> DataFrame:
    """Term table (category_id, product_id, term, tf). A product is one row: its terms are counted inside it.

    With `positions` also the places of the term among the product's terms, each as its distance from the one before.
    """
    text = search_text(products) if text is None else text
    if positions:
        tokens = F.transform(terms_of(text), lambda t, i: F.struct(t.alias("term"), i.alias("position"), F.lit(1.0).alias("weight")))
        found = products.select("category_id", "product_id", F.inline(postings_of(tokens)))
        return found.select("category_id", "product_id", "term", F.size("positions").cast("bigint").alias("tf"), "positions")
    sorted_terms = products.select("category_id", "product_id", F.array_sort(terms_of(text)).alias("_terms")).where(F.size("_terms") > 0)
    terms, n = F.col("_terms"), F.size("_terms")
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(terms, i) != F.get(terms, i - 1)))
    runs = sorted_terms.withColumn("_starts", starts)
    ends = F.concat(F.slice("_starts", F.lit(2), F.size("_starts")), F.array(n))
    counted = F.zip_with("_starts", ends, lambda i, j: F.struct(F.get(terms, i).alias("term"), (j - i).cast("bigint").alias("tf")))
    return runs.select("category_id", "product_id", F.inline(counted))


def postings_of(tokens: Column) -> Column:
    """Of tokens (term, position, weight): one struct a term, with the sum of its weights and its positions as distances."""
    def runs(sorted_tokens: Column) -> Column:
        n = F.size(sorted_tokens)
        places = F.filter(
            F.transform(sorted_tokens, lambda t, i: F.when((i == 0) | (t["term"] != F.get(sorted_tokens, i - 1)["term"]), i)), lambda i: i.isNotNull()
        )

        def posting(run: Column) -> Column:
            return F.struct(
                F.get(run, 0)["term"].alias("term"), F.aggregate(run, F.lit(0.0), lambda s, t: s + t["weight"]).alias("weight"),
                differences(F.transform(run, lambda t: t["position"])).alias("positions"),
            )

        return bind(places, lambda at: F.transform(at, lambda i, k: bind(F.slice(sorted_tokens, i + 1, F.coalesce(F.get(at, k + 1), n) - i), posting)))

    return bind(F.array_sort(tokens), runs)


def write_index(index: DataFrame, path: str) -> None:
    """Store the term table by category, sorted by term, so that a search reads few row groups of one category.

    Ranges of category and term, so that a category that holds most products is written by many tasks.
    """
    placed = index.repartitionByRange("category_id", "term").sortWithinPartitions("category_id", "term")
    placed.write.mode("overwrite").partitionBy("category_id").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """A stored term table. Conditions on category and term reach the files; positions are there if they were stored."""
    return spark.read.schema("product_id bigint, term string, tf bigint, positions array<int>, category_id bigint").parquet(path)


def stand_in_order(positions: list[tuple[Column, int]]) -> Column:
    """Does some place have every word at its offset? Pairs of a word's stored positions and its offset in the phrase."""
    def start(stored: Column, offset: int) -> Column:
        return F.transform(running_sum(stored), lambda at: at - offset)

    starts = [start(p, offset) for p, offset in positions]
    common = starts[0]
    for more in starts[1:]:
        common = F.array_intersect(common, more)
    return F.coalesce(F.size(common) > 0, F.lit(False))


@dataclass
class Clause:
    required: list[str] = field(default_factory=list)
    excluded: list[str] = field(default_factory=list)
    phrases: list[list[str]] = field(default_factory=list)
    excluded_phrases: list[list[str]] = field(default_factory=list)


def query_clauses(query: str) -> list[Clause]:
    """Words that must all occur, `-word`, `"a phrase"`, `-"a phrase"`; `or` separates alternatives."""
    clauses = [Clause()]
    for minus, phrase, word in re.findall(r'(-?)(?:"([^"]*)"|(\S+))', query.lower()):
        words = re.findall(r"[^\W_]+", phrase or word)
        if word == "or" and not minus:
            clauses.append(Clause())
        elif minus and len(words) > 1:
            clauses[-1].excluded_phrases.append(words)
        elif minus:
            clauses[-1].excluded += words
        else:
            clauses[-1].required += words
            if phrase and len(words) > 1:
                clauses[-1].phrases.append(words)
    return [c for c in clauses if c.required or c.excluded or c.excluded_phrases]


def _phrase(words: list[str]) -> str:
    gap = r"[^\p{L}\p{N}]+"
    return r"(?i)(^|[^\p{L}\p{N}])" + gap.join(words) + r"($|[^\p{L}\p{N}])"


def match_text(products: DataFrame, index: DataFrame, query: str, text: Column | None = None) -> DataFrame:
    """Products that satisfy the query, with `text_score` in 0..1.

    The score is the mean of tf / (tf + 1) over the query's words. Only index rows of those words
    are read, and they are grouped to at most one row per product before the join. Phrases come from the
    index's positions; only an index without them needs the products' text.
    """
    clauses = query_clauses(query)
    wanted = sorted({t for c in clauses for t in c.required})
    has_phrases = any(c.phrases or c.excluded_phrases for c in clauses)
    placed = has_phrases and text is None and "positions" in index.columns
    in_phrases = {t for c in clauses for words in c.phrases + c.excluded_phrases for t in words} if placed else set()
    known = sorted({t for c in clauses for t in c.required + c.excluded} | in_phrases)
    text = text if text is not None or placed else (search_text(products) if has_phrases else None)
    saturation = F.when(F.col("term").isin(wanted), F.col("tf") / (F.col("tf") + 1.0))
    hits = (
        index.where(F.col("term").isin(known))
        .groupBy("product_id")
        .agg(
            F.collect_set("term").alias("_terms"), (F.coalesce(F.sum(saturation), F.lit(0.0)) / max(len(wanted), 1)).alias("text_score"),
            *[F.max(F.when(F.col("term") == t, F.col("positions"))).alias(f"_at_{t}") for t in sorted(in_phrases)],
        )
    )

    def phrase(words: list[str]) -> Column:
        return stand_in_order([(F.col(f"_at_{t}"), i) for i, t in enumerate(words)]) if placed else text.rlike(_phrase(words))

    accepted = F.lit(False)
    for c in clauses:
        holds = F.lit(True)
        for t in c.required:
            holds = holds & F.array_contains("_terms", t)
        for t in c.excluded:
            holds = holds & ~F.array_contains("_terms", t)
        for words in c.phrases:
            holds = holds & phrase(words)
        for words in c.excluded_phrases:
            holds = holds & ~phrase(words)
        accepted = accepted | holds
    needs_all = any(not c.required for c in clauses)
    joined = products.join(hits, "product_id", "left" if needs_all else "inner")
    if needs_all:
        joined = joined.withColumn("_terms", F.coalesce("_terms", F.array().cast("array<string>")))
    return joined.where(accepted).withColumn("text_score", F.coalesce("text_score", F.lit(0.0))).drop("_terms", *[f"_at_{t}" for t in in_phrases])


# --- smart search -------------------------------------------------------------------------------


def price_points(price: Column, low: float | None, high: float | None, most: float = 30.0) -> Column:
    """Full points inside the range, one point less per 50 pounds outside; none without an upper bound."""
    def falling(distance: Column) -> Column:
        return F.greatest(F.lit(0.0), F.lit(most) - distance / 50)

    if low is not None and high is not None:
        return F.when(price.between(low, high), F.lit(most)).when(price < low, falling(low - price)).otherwise(falling(price - high))
    if high is not None:
        return F.when(price <= high, F.lit(most)).otherwise(falling(price - high))
    return F.lit(0.0)


def smart_search(
    products: DataFrame, index: DataFrame, category_id: int, text: str | None = None, price_min: float | None = None,
    price_max: float | None = None, brands: list[str] | None = None, limit: int = 200, soft_price: bool = False,
) -> DataFrame:
    """Filtered products by relevance: text up to 40, price 30, brand 20, rating 10 points.

    The price filter makes the falling price points unreachable; `soft_price` ranks instead of filtering.
    """
    found = products.where(F.col("category_id") == category_id)
    if price_min is not None and not soft_price:
        found = found.where(F.col("price") >= price_min)
    if price_max is not None and not soft_price:
        found = found.where(F.col("price") <= price_max)
    if brands is not None:
        found = found.where(F.col("brand").isin(brands))
    if text is not None:
        found = match_text(found, index.where(F.col("category_id") == category_id), text)
    else:
        found = found.withColumn("text_score", F.lit(0.0))
    relevance = (
        F.col("text_score") * 40
        + price_points(F.col("price"), price_min, price_max)
        + (F.when(F.col("brand").isin(brands), 20.0).otherwise(0.0) if brands is not None else F.lit(0.0))
        + F.coalesce(F.col("score") / 10, F.lit(0.0))
    )
    return (
        found.withColumn("relevance_score", relevance)
        .orderBy(F.desc("relevance_score"), F.desc_nulls_last("score"), "product_id")
        .limit(limit)
    )


# --- structured filter and ranking --------------------------------------------------------------


@dataclass
class FilterSpec:
    specs: dict[str, dict] = field(default_factory=dict)  # key -> {min, max} | {in: [...]} | {exact: value}
    required: list[str] = field(default_factory=list)
    preferred: list[str] = field(default_factory=list)
    excluded: list[str] = field(default_factory=list)
    price_min: float | None = None
    price_max: float | None = None
    brands: list[str] | None = None
    score_min: float | None = None
    sort_priority: tuple[str, ...] = ()


def _value(column: str, key: str) -> Column:
    return F.col(column)[key]


def _has(feature: str) -> Column:
    return F.coalesce(_value("features", feature) == "Yes", F.lit(False))


def filter_catalog(products: DataFrame, spec: FilterSpec) -> DataFrame:
    """Every product that meets the structured filter; never limited."""
    conditions = []
    for key, rule in spec.specs.items():
        number = _value("specs", key).try_cast("double")
        if "min" in rule or "max" in rule:
            if rule.get("min") is not None:
                conditions.append(number >= rule["min"])
            if rule.get("max") is not None:
                conditions.append(number <= rule["max"])
        elif "in" in rule:
            conditions.append(_value("specs", key).isin([str(x) for x in rule["in"]]))
        elif "exact" in rule:
            conditions.append(_value("specs", key) == str(rule["exact"]))
    conditions += [_has(f) for f in spec.required] + [~_has(f) for f in spec.excluded]
    if spec.price_min is not None:
        conditions.append(F.col("price") >= spec.price_min)
    if spec.price_max is not None:
        conditions.append(F.col("price") <= spec.price_max)
    if spec.brands:
        conditions.append(F.col("brand").isin(spec.brands))
    if spec.score_min is not None:
        conditions.append(F.col("score") >= spec.score_min)
    for condition in conditions:
        products = products.where(condition)
    return products


def rank_matches(products: DataFrame, spec: FilterSpec) -> DataFrame:
    """Adds match points: required features 40, preferred share 20, rating 20, price 20."""
    required = F.lit(True)
    for f in spec.required:
        required = required & _has(f)
    preferred = F.lit(0)
    for f in spec.preferred:
        preferred = preferred + F.when(_has(f), 1).otherwise(0)
    points = F.when(required, 40.0).otherwise(0.0) + preferred * (20.0 / max(len(spec.preferred), 1))
    points = points + F.coalesce(F.col("score"), F.lit(0.0)) / 100 * 20
    if any("price" in s for s in spec.sort_priority):
        points = points + price_points(F.col("price"), spec.price_min, spec.price_max, 1.0) * 20
    return products.withColumns({
        "relevance_score": points, "required_met": required, "preferred_matched": preferred,
    }).orderBy(F.desc("relevance_score"), "product_id")


def score_products(products: DataFrame, requirements: list[str], price_min=None, price_max=None, brands: list[str] | None = None) -> DataFrame:
    """Adds a 0..95 score: price 40, requirements 30, brand 15, rating 10, and its tier.

    A requirement found in a `Yes` feature counts fully, one found in a specs key or value 0.8.
    """
    yes = F.map_keys(F.map_filter("features", lambda k, v: v == "Yes"))
    specs = F.flatten(F.transform(F.map_entries("specs"), lambda e: F.array(e["key"], e["value"])))
    share = 30.0 / max(len(requirements), 1)
    features = F.lit(0.0)
    for requirement in requirements:
        wanted = F.lit(requirement.lower())
        features = features + F.when(F.exists(yes, lambda f: F.contains(f, wanted)), share).when(
            F.exists(specs, lambda s: F.contains(F.lower(s), wanted)), share * 0.8
        ).otherwise(0.0)
    has_range = price_min is not None or price_max is not None
    price = price_points(F.col("price"), price_min, price_max) * (40.0 / 30.0) if has_range else F.lit(0.0)
    brand = F.when(F.col("brand").isin(brands), 15.0).otherwise(0.0) if brands else F.lit(0.0)
    total = price + F.least(features, F.lit(30.0)) + brand + F.coalesce(F.col("score"), F.lit(0.0)) / 100 * 10
    tier = F.lit("alternative")
    for least, name in sorted(SCORE_TIERS):
        tier = F.when(F.col("match_score") >= least, name).otherwise(tier)
    return products.withColumn("match_score", total).withColumn("tier", tier)


# --- rankings and statistics --------------------------------------------------------------------


def product_rankings(products: DataFrame, tiers=CAPACITY_TIERS) -> DataFrame:
    """Price percentile and tier inside the category, number of `Yes` features, capacity tier.

    Products without a price rank after all others and count, as in a ranking of all rows with nulls last. The
    percentile comes from ranks of distinct prices, not from sorting a category's products in one task.
    """
    ranked = ranked_values(products, ["category_id"], "price")
    share = F.when(F.col("total") > 1, F.col("below") / (F.col("total") - 1)).otherwise(0.0)
    placed = ranked.select("category_id", "price", share.alias("price_percentile"))
    capacity = F.lit(None).cast("string")
    for category_id, (key, small, medium) in tiers.items():
        amount = _value("specs", key).try_cast("double")
        tier = F.when(amount < small, "small").when(amount < medium, "medium").otherwise("large")
        capacity = F.when(F.col("category_id") == category_id, tier).otherwise(capacity)
    return join_on(products, placed, ["category_id", "price"], "left").withColumns({
        "feature_count": F.size(F.map_filter("features", lambda k, v: v == "Yes")),
        "price_tier": F.when(F.col("price_percentile") < 0.33, "budget").when(F.col("price_percentile") < 0.66, "mid-range").otherwise("premium"),
        "capacity_tier": capacity,
    })


def category_stats(products: DataFrame) -> DataFrame:
    """Count, mean price, price quartiles, mean rating and number of brands per category; a category without any
    brand or price stays, with 0 brands and null quartiles."""
    keys = ["category_id"]
    quartiles = percentiles(products, keys, "price", {"price_q1": 0.25, "price_median": 0.5, "price_q3": 0.75})
    basics = products.groupBy(*keys).agg(
        F.count("*").alias("product_count"), F.round(F.avg("price"), 2).alias("avg_price"), F.avg("score").alias("avg_score")
    )
    brands = category_brands(products).groupBy(*keys).agg(F.count("*").alias("n_brands"))
    every = join_on(join_on(basics, quartiles, keys, "left"), brands, keys, "left")
    return every.select(
        "category_id", "product_count", "avg_price", "price_q1", "price_median", "price_q3", "avg_score", F.coalesce("n_brands", F.lit(0)).alias("n_brands")
    )


def category_brands(products: DataFrame) -> DataFrame:
    return products.where("brand is not null").select("category_id", "brand").distinct()


def common_features(feature_rows: DataFrame, k: int = 20) -> DataFrame:
    """Most frequent `Yes` features per category; rows (category_id, key, value)."""
    counts = feature_rows.where("value = 'Yes'").groupBy("category_id", "key").agg(F.count("*").alias("products"))
    window = Window.partitionBy("category_id").orderBy(F.desc("products"), "key")
    return counts.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def facet_labels(price_step: int = 100) -> Column:
    """(facet, label) of a product: its brand, its price range and its `Yes` features; the label may be null."""
    low = (F.floor(F.col("price") / price_step) * price_step).cast("bigint")
    price = F.concat(low.cast("string"), F.lit("-"), (low + price_step).cast("string"))
    return F.concat(
        F.array(F.struct(F.lit("brand").alias("facet"), F.col("brand").alias("label")), F.struct(F.lit("price").alias("facet"), price.alias("label"))),
        F.transform(F.map_keys(F.map_filter("features", lambda k, v: v == "Yes")), lambda k: F.struct(F.lit("feature").alias("facet"), k.alias("label"))),
    )


def facets(products: DataFrame, price_step: int = 100) -> DataFrame:
    """Counts per brand, price range and `Yes` feature, from one pass over the products."""
    return products.select(F.inline(facet_labels(price_step))).where("label is not null").groupBy("facet", "label").agg(F.count("*").alias("products"))


def complete(products: DataFrame, prefix: str, n: int = 10) -> DataFrame:
    """First `n` distinct names that start with the prefix, ignoring case."""
    return products.where(F.lower("name").startswith(prefix.lower())).select("name").distinct().orderBy("name").limit(n)


def page(products: DataFrame, order: list[Column], limit: int, offset: int) -> DataFrame:
    return products.orderBy(*order).offset(offset).limit(limit)


def lookup(products: DataFrame, ids: DataFrame) -> DataFrame:
    return products.join(ids.select("product_id").distinct(), "product_id", "left_semi")


def coverage(matched: DataFrame, products: DataFrame) -> DataFrame:
    """Matched share per category in percent."""
    found = matched.groupBy("category_id").agg(F.count("*").alias("matched"))
    total = products.groupBy("category_id").agg(F.count("*").alias("total"))
    return total.join(found, "category_id", "left").select(
        "category_id", F.coalesce("matched", F.lit(0).cast("bigint")).alias("matched"), "total",
        F.round(F.coalesce("matched", F.lit(0)) / F.col("total") * 100, 1).alias("percent"),
    )


# --- queries and metrics ------------------------------------------------------------------------


def _first_intent(text: Column, intents) -> Column:
    result = None
    for name, pattern in intents:
        result = F.when(text.rlike(pattern), name) if result is None else result.when(text.rlike(pattern), name)
    return result


def parse_queries(queries: DataFrame, brands: list[str]) -> DataFrame:
    """Price and size intent, known brands and remaining search terms of each `query_text`."""
    text = F.lower("query_text")
    named = F.filter(F.array(*[F.lit(b) for b in brands]), lambda b: F.contains(text, F.lower(b)))
    rest = F.filter(F.split(F.regexp_replace(text, INTENT_WORDS, ""), r"\s+"), lambda t: F.length(t) > 2)
    return queries.withColumns({
        "price_intent": _first_intent(text, PRICE_INTENTS), "size_intent": _first_intent(text, SIZE_INTENTS),
        "brands": named, "search_terms": rest,
    })


def metrics_rollup(metrics: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """Searches per hour and category of the last day: count, mean, p50, p95 and cache-hit share.

    Latencies are counted by value and ranked in parts of their range, so an hour and category that hold most searches
    are the work of many tasks.
    """
    recent = metrics.where(F.col("created_at") > now - F.make_dt_interval(F.lit(0), F.lit(hours)))
    recent = recent.withColumn("hour", F.date_trunc("hour", "created_at"))
    keys, ms = ["hour", "category_id"], F.col("execution_time_ms")
    basics = recent.groupBy(*keys).agg(
        F.count("*").alias("search_count"), F.round(F.avg(ms), 6).alias("avg_latency"), (F.count_if("cache_hit") / F.count("*")).alias("cache_hit_rate")
    )
    latency = percentiles(recent, keys, "execution_time_ms", {"p50_latency": 0.5, "p95_latency": 0.95})
    return join_on(basics, latency, keys, "left").select(*keys, "search_count", "avg_latency", "p50_latency", "p95_latency", "cache_hit_rate")


def popular_searches(metrics: DataFrame, k: int = 21) -> DataFrame:
    """Most frequent (category, query) pairs."""
    counts = metrics.groupBy("category_id", "query_text").agg(F.count("*").alias("hits"))
    return counts.orderBy(F.desc("hits"), "category_id", "query_text").limit(k)
