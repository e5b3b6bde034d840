"""Reading, writing and streaming queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.operators import standardize as st
from shelfwise.operators.attributes import to_eav
from shelfwise.plans.queries_attributes import RULES, STANDARDIZE_SQL, n_products, value_map_table
from shelfwise.plans.registry import REGISTRY
from shelfwise.plans.standardizing import product_rules, read_rules, write_rules
from shelfwise.plans.views import SPEC_ROWS, spark_row_array
from shelfwise.session import new_shared_path
from shelfwise.sources.catalog_io import number_products, read_catalog, rejected_documents, write_stage
from shelfwise.streaming.jobs import SKETCH_RANK_ERROR, hourly_sketches, metrics_stream, rollup_sketches, sketch_stream, standardize_stream
from shelfwise.streaming.live import LiveCatalog, live_stream


def _landed_catalog(v) -> str:
    """Catalog documents of two products each, written as lines to the shared folder."""
    rows = v.part.selectExpr("*", f"{spark_row_array(SPEC_ROWS)} as rows")

    def flat(kind):
        return F.map_from_entries(F.transform(F.filter("rows", lambda r: r["kind"] == kind), lambda r: F.struct(r["key"], r["value"])))

    product = F.struct(
        F.concat("p_name", F.lit(" MX"), F.col("p_partkey").cast("string")).alias("name"), F.col("p_retailprice").alias("price"),
        flat("specs").alias("specs"), flat("features").alias("features"),
    )
    twin = F.struct(
        F.concat("p_name", F.lit(" twin"), F.col("p_partkey").cast("string")).alias("name"), F.col("p_retailprice").alias("price"),
        flat("features").alias("specs"), flat("features").alias("features"),
    )
    document = F.struct(F.array(product, twin).alias("products"), F.lit(2).alias("total"), F.lit("https://x.example.com").alias("url"))
    path = new_shared_path(v.spark, "catalog")
    rows.select(F.to_json(document).alias("value")).write.text(path)
    return path


@REGISTRY.add("A01_read_catalog", """
select p_name || ' MX' || cast(p_partkey as varchar) as name, cast(p_retailprice as varchar) as price, cast(2 as bigint) as file_total, s.kind, s.key, s.value
from part join fx_spec s on s.product_id = p_partkey
union all
select p_name || ' twin' || cast(p_partkey as varchar), cast(p_retailprice as varchar), 2, k.kind, s.key, s.value
from part join fx_spec s on s.product_id = p_partkey and s.kind = 'features', (values ('specs'), ('features')) k(kind)""")
def _(v):
    products = number_products(read_catalog(v.spark, _landed_catalog(v), multi_line=False))
    eav = to_eav(products)
    return eav.join(products.select("product_id", "name", "price", "file_total"), "product_id").select(
        "name", "price", "file_total", "kind", "key", "value"
    )


@REGISTRY.add("A01_reviews_and_rejects", """
select 'read' as outcome, 'Good ' || cast(p_partkey as varchar) as summary, 'p' || cast(p_partkey as varchar) as pro, cast(p_partkey as double) as rating
from part where p_partkey % 7 <> 0 and p_partkey % 11 <> 0
union all select 'broken document', null, null, null from part where p_partkey % 7 = 0
union all select 'no products', null, null, null from part where p_partkey % 7 <> 0 and p_partkey % 11 = 0""")
def _(v):
    """Review texts below `sentiment`, a score under a name of its own, documents cut short, and documents without products."""
    number = F.col("p_partkey").cast("string")
    whole = F.concat(
        F.lit('{"products": [{"name": "same", "stars": {"mean": '), number, F.lit('}, "reviews": {"sentiment": {"summary": "Good '), number,
        F.lit('", "pros": ["p'), number, F.lit('"]}}}]}'),
    )
    line = F.when(F.expr("p_partkey % 7 = 0"), F.substring(whole, 1, 60)).when(F.expr("p_partkey % 11 = 0"), F.lit('{"total": 0}')).otherwise(whole)
    path = new_shared_path(v.spark, "catalog")
    v.part.select(line.alias("value")).write.text(path)
    products = number_products(read_catalog(v.spark, path, multi_line=False, fields={"reviews.ratingScore": ["stars.mean"]}))
    read = products.groupBy("product_id").agg(F.first("reviews").alias("r")).select(
        F.lit("read").alias("outcome"), "r.summary", F.col("r.pros")[0].alias("pro"), F.col("r.ratingScore").alias("rating")
    )
    none = [F.lit(None).cast(kind).alias(name) for name, kind in (("summary", "string"), ("pro", "string"), ("rating", "double"))]
    return read.unionByName(rejected_documents(v.spark, path, multi_line=False).select(F.col("reason").alias("outcome"), *none))


@REGISTRY.add("A02_stage_round_trip", "select product_id, ord, key, value, kind from fx_spec")
def _(v):
    path = write_stage(v.fx_spec, new_shared_path(v.spark, "stage") + ".json", "standardized", ["kind"])
    return v.spark.read.schema("product_id bigint, ord bigint, key string, value string, kind string").parquet(path)


@REGISTRY.add("X01_metrics_stream", """
select date_trunc('hour', created_at) as hour, category_id, count(*) as search_count, round(avg(execution_time_ms), 6) as avg_latency,
  round(avg(cast(cache_hit as int)), 6) as cache_hit_rate, true as p50_fits, true as p95_fits
from fx_metrics group by hour, category_id having hour + interval 1 hour <= (select max(created_at) - interval 10 minutes from fx_metrics)""")
def _(v):
    spark = v.spark
    events = spark.readStream.schema(v.events.schema).option("pathGlobFilter", "events.parquet").parquet(v.sf_dir)
    metrics = events.selectExpr(
        "event_id as search_id", "cast(user_id % 5 + 1 as bigint) as category_id", "event_type as query_text",
        "value * 10 as execution_time_ms", "event_id % 3 = 0 as cache_hit", "cast(ts as timestamp) as created_at",
    )
    out = new_shared_path(spark, "metrics")
    query = (
        metrics_stream(metrics).writeStream.format("parquet").outputMode("append").option("path", out)
        .option("checkpointLocation", out + "-checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    hourly = spark.read.schema(
        "hour timestamp, category_id bigint, search_count bigint, avg_latency double, p50_latency double, p95_latency double, cache_hit_rate double"
    ).parquet(out)
    # The stream's percentiles are approximate: at most one in 10,000 rows may lie between them and the true place.
    rows = v.fx_metrics.withColumn("hour", F.date_trunc("hour", "created_at"))
    placed = hourly.join(rows, ["hour", "category_id"]).groupBy("hour", "category_id", *hourly.columns[2:]).agg(
        *[F.count_if(F.col("execution_time_ms") < F.col(c)).alias(f"{c}_below") for c in ("p50_latency", "p95_latency")],
        *[F.count_if(F.col("execution_time_ms") <= F.col(c)).alias(f"{c}_upto") for c in ("p50_latency", "p95_latency")],
    )

    def fits(column: str, share: float) -> Column:
        place, slack = F.col("search_count") * share, 1 + F.col("search_count") / 10000
        return (F.col(f"{column}_below") <= place + slack) & (F.col(f"{column}_upto") >= place - slack)

    return placed.select(
        "hour", "category_id", "search_count", F.round("avg_latency", 6).alias("avg_latency"), F.round("cache_hit_rate", 6).alias("cache_hit_rate"),
        fits("p50_latency", 0.5).alias("p50_fits"), fits("p95_latency", 0.95).alias("p95_fits"),
    )


def metrics_events(v):
    """The event table as a stream of searches."""
    events = v.spark.readStream.schema(v.events.schema).option("pathGlobFilter", "events.parquet").parquet(v.sf_dir)
    return events.selectExpr(
        "event_id as search_id", "cast(user_id % 5 + 1 as bigint) as category_id", "event_type as query_text",
        "value * 10 as execution_time_ms", "event_id % 3 = 0 as cache_hit", "cast(ts as timestamp) as created_at",
    )


def ranks_fit(rollup, rows, keys):
    """Do the quantiles lie at their rank, give or take the sketch's error and a row?"""
    placed = rollup.join(rows, keys).groupBy(*keys, *[c for c in rollup.columns if c not in keys]).agg(
        *[F.count_if(F.col("execution_time_ms") < F.col(c)).alias(f"{c}_below") for c in ("p50_latency", "p95_latency")],
        *[F.count_if(F.col("execution_time_ms") <= F.col(c)).alias(f"{c}_upto") for c in ("p50_latency", "p95_latency")],
    )

    def fits(column: str, share: float) -> Column:
        place, slack = F.col("search_count") * share, 1 + F.col("search_count") * SKETCH_RANK_ERROR
        return (F.col(f"{column}_below") <= place + slack) & (F.col(f"{column}_upto") >= place - slack)

    return placed.withColumns({"p50_fits": fits("p50_latency", 0.5), "p95_fits": fits("p95_latency", 0.95)})


@REGISTRY.add("X01_sketch_stream", """
with closed as (select *, date_trunc('hour', created_at) as hour from fx_metrics
                where date_trunc('hour', created_at) + interval 1 hour <= (select max(created_at) - interval 10 minutes from fx_metrics))
select category_id, count(distinct hour) as hours, count(*) as search_count, round(avg(execution_time_ms), 6) as avg_latency,
  round(avg(cast(cache_hit as int)), 6) as cache_hit_rate, true as p50_fits, true as p95_fits from closed group by category_id""")
def _(v):
    """Sketches of a stream, stored by the hour; all closed hours of a category from one row an hour."""
    out = new_shared_path(v.spark, "sketches")
    query = (
        sketch_stream(metrics_events(v)).writeStream.format("parquet").outputMode("append").option("path", out)
        .option("checkpointLocation", out + "-checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    hours = v.spark.read.schema(
        "hour timestamp, category_id bigint, search_count bigint, timed bigint, total_latency double, cache_hits bigint, sketch binary"
    ).parquet(out)
    rows = v.fx_metrics.withColumn("hour", F.date_trunc("hour", "created_at")).join(hours.select("hour", "category_id"), ["hour", "category_id"], "left_semi")
    fitted = ranks_fit(rollup_sketches(hours, "category_id"), rows, ["category_id"])
    return fitted.select(
        "category_id", "hours", "search_count", F.round("avg_latency", 6).alias("avg_latency"), F.round("cache_hit_rate", 6).alias("cache_hit_rate"), "p50_fits", "p95_fits"
    )


@REGISTRY.add("K13_sketch_rollup", """
with now as (select max(created_at) as now from fx_metrics)
select category_id, date_trunc('day', created_at) as day, count(distinct date_trunc('hour', created_at)) as hours, count(*) as search_count,
  round(avg(execution_time_ms), 6) as avg_latency, round(cast(count(*) filter (where cache_hit) as double) / count(*), 6) as cache_hit_rate, true as p50_fits, true as p95_fits
from fx_metrics group by category_id, day""")
def _(v):
    """Days from the hours' stored sketches."""
    out = new_shared_path(v.spark, "hours")
    hourly_sketches(v.fx_metrics).write.parquet(out)
    days = rollup_sketches(v.spark.read.parquet(out), "category_id", F.date_trunc("day", "hour").alias("day"))
    fitted = ranks_fit(days, v.fx_metrics.withColumn("day", F.date_trunc("day", "created_at")), ["category_id", "day"])
    return fitted.select(
        "category_id", "day", "hours", "search_count", F.round("avg_latency", 6).alias("avg_latency"), F.round("cache_hit_rate", 6).alias("cache_hit_rate"), "p50_fits", "p95_fits"
    )


@REGISTRY.add("X02_standardize_stream", STANDARDIZE_SQL)
def _(v):
    spark = v.spark
    local = product_rules(v.fx_spec, RULES)
    rules_path = new_shared_path(spark, "unification_map")
    write_rules(spark, RULES, rules_path)
    kept = st.key_coverage(local, n_products(v), 10).where("kept").select("kind", "key")
    profile = new_shared_path(spark, "profile")
    kept.write.parquet(profile + "/kept")
    covered = st.keep_keys(local, spark.read.parquet(profile + "/kept"))
    st.kind_moves(st.normalize_values(covered, value_map_table(spark)).drop("changed")).write.parquet(profile + "/moves")

    def to_rows(batch):
        return batch.selectExpr("p_partkey as product_id", f"inline({spark_row_array(SPEC_ROWS)})")

    parts = spark.readStream.schema(v.part.schema).option("pathGlobFilter", "part.parquet").parquet(v.sf_dir)
    out = new_shared_path(spark, "standardized")
    standardize_stream(
        parts, to_rows, read_rules(spark, rules_path), value_map_table(spark), spark.read.parquet(profile + "/kept"), spark.read.parquet(profile + "/moves"),
        out, out + "-checkpoint",
    ).awaitTermination()
    return spark.read.schema("product_id bigint, kind string, ord bigint, key string, value string").parquet(f"{out}/batch=*")


@REGISTRY.add("X02_live_profile", STANDARDIZE_SQL)
def _(v):
    """Products arrive in three files: two thirds in an old form, then all, then a few late in a form older still."""
    spark, landing, live = v.spark, new_shared_path(v.spark, "landing"), new_shared_path(v.spark, "live")
    parts = v.part.withColumn("product_id", F.col("p_partkey"))
    old = parts.where("p_partkey % 3 <> 0").withColumns({"p_size": F.col("p_size") + 7, "p_name": F.concat("p_name", F.lit(" old")), "version": F.lit(1).cast("bigint")})
    for arrived in (old, parts.withColumn("version", F.lit(2).cast("bigint")), old.where("p_partkey % 5 = 0").withColumn("version", F.lit(0).cast("bigint"))):
        arrived.coalesce(1).write.mode("append").parquet(landing)

    def to_rows(batch):
        return batch.selectExpr("product_id", f"inline({spark_row_array(SPEC_ROWS)})")

    schema = spark.read.parquet(landing).schema
    arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing)
    catalog = LiveCatalog(spark, live)
    live_stream(arriving, catalog, to_rows, RULES, value_map_table(spark), live + "-checkpoint").awaitTermination()
    return catalog.standardized(10.0)
