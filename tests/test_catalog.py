from pyspark.sql import functions as F

from shelfwise.functions.tables import dense_ids
from shelfwise.operators import catalog as ct
from shelfwise.operators import metadata as md
from shelfwise.operators import reviews as rv
from shelfwise.operators import selecting as se


def test_queries_from_names(spark):
    rows = [("Tower T17190 Vortx 11L", None), ("Ninja Crispi FN101UKGY", "air-fryers"), ("Ninja AF180UK", None)]
    got = ct.build_queries(spark.createDataFrame(rows, "name string, category string")).collect()
    assert {r.name: (r.search_query, r.target_model) for r in got} == {
        "Tower T17190 Vortx 11L": ("tower vortx", "T17190"),
        "Ninja Crispi FN101UKGY": ("ninja crispi air fryer", "FN101UKGY"),
        "Ninja AF180UK": ("ninja AF180UK", "AF180UK"),
    }


def test_brand_prefix_has_no_boundary_unless_strict(spark):
    df = spark.createDataFrame([("Sharpener X",), ("fisher & paykel W1",), ("Solo",)], "name string")
    loose = [(r.brand, r.model) for r in ct.split_brand_model(df).collect()]
    assert loose == [("Sharp", "ener X"), ("Fisher & Paykel", "W1"), ("Solo", "Solo")]
    assert ct.split_brand_model(df, strict=True).first().brand == "Sharpener"


def test_slugs(spark):
    names = ["Café  Crème_Ⅳ!", "###", "x" * 120, "a--b", "ﬁne ½"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    assert [r.slug for r in ct.build_slugs(df).collect()] == ["cafe-creme-iv", "product", "x" * 100, "a-b", "fine-12"]


def test_weighted_ratings(spark):
    df = spark.createDataFrame([("5.0", 2), ("4.5/5", 1000), ("4.2", 31), ("0", 5)], "rating_text string, count long")
    assert [r.rating_score for r in rv.snapshot_score(df).collect()] == [81.3, 89.7, 82.0, None]


def test_dense_ids_are_dense(spark):
    df = spark.range(5000).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("slug"))
    ids = sorted(r.category_id for r in dense_ids(df, "slug", "category_id", F.lit(10)).collect())
    assert ids == list(range(11, 5011))


def test_sources_fall_back_in_order(spark):
    rows = [(1, "B", 0, 30), (1, "A", 1, 5), (1, "X", 2, 60), (2, "X", 0, 1), (2, "X", 1, 2), (3, "X", 0, 1), (3, "X", 1, 2), (3, "X", 2, 3), (3, "A", 3, 4), (3, "X", 4, 90)]
    df = spark.createDataFrame(rows, "product_id long, source_name string, ord long, spec_count long")
    got = {r.product_id: (r.success, r.source_name, r.attempts) for r in se.select_source(df, ["A", "B"]).collect()}
    assert got == {1: (True, "B", 2), 2: (False, None, 2), 3: (False, None, 3)}
    best = {r.product_id: r.source_name for r in se.select_source(df, ["A", "B"], stop_at_first=False).collect()}
    assert best == {1: "X", 2: None, 3: None}


def test_accumulate_stops_after_the_source_that_reaches_the_target(spark):
    rows = [(1, 1, f"a{i}", "1") for i in range(3)] + [(1, 2, "a0", "2"), (1, 2, "b", "2"), (1, 2, "c", "2")] + [(1, 3, "d", "3")]
    merged, used = se.accumulate_until(
        spark.createDataFrame(rows, "product_id long, rank long, key string, value string"), spark.createDataFrame([(1, 5)], "product_id long, target long")
    )
    assert {r.key: r.value for r in merged.collect()} == {"a0": "2", "a1": "1", "a2": "1", "b": "2", "c": "2"}
    assert [(r.rank, r.new_keys, r.total_keys) for r in used.orderBy("rank").collect()] == [(1, 3, 3), (2, 2, 5)]


def test_mixed_metadata_types(spark):
    rows = [(1, "specs", "unit_price", v) for v in ("£5.50", "7", "from 3", "cheap", "dear")] + [(1, "specs", "width", v) for v in ("60 cm", "61", "wide")]
    rows += [(1, "features", "smart", v) for v in ("Yes", "no", "maybe")]
    got = md.build_metadata(spark.createDataFrame(rows, "category_id long, kind string, key string, value string")).collect()
    assert {(r.text_value or r.num_value) for r in got if r.key == "unit_price"} == {"5.5", "7.0", "from 3", "cheap", "dear"}
    assert {(r.value_type, r.num_value) for r in got if r.key == "width"} == {("number", 60.0), ("number", 61.0)}
    assert {r.bool_value for r in got if r.key == "smart"} == {True, False}


def test_review_splitting(spark):
    text = "4.5 average 5 out of 5 stars. by A 3 days ago Great machine overall, Yes, I would buy 2 out of 5 stars. B 1 week ago ok. 1 out of 5 stars. no date here at all"
    got = rv.split_reviews(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [(r.ord, r.stars, r.text) for r in got] == [(0, 5, "Great machine overall")]


def test_sources_are_placed_in_tasks_of_bounded_size(spark, monkeypatch):
    source = spark.range(400).selectExpr("id % 20 as product_id", "id div 20 as rank", "'k' || cast((id * 7) % 11 as string) as key", "cast(id as string) as value")
    targets = spark.range(20).selectExpr("id as product_id", "3L as target")
    whole = {n: sorted(map(tuple, df.collect())) for n, df in zip("mu", se.accumulate_until(source, targets))}
    monkeypatch.setattr(se, "ROWS_A_TASK", 50)
    merged, used = se.accumulate_until(source, targets)
    assert merged.rdd.getNumPartitions() == 8
    assert {n: sorted(map(tuple, df.collect())) for n, df in zip("mu", (merged, used))} == whole
    assert se.accumulate_until(source.limit(0), targets)[0].count() == 0
