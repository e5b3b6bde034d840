"""Rows that are easily lost: broken documents, missing prices, brands and targets, odd blanks, very long replies."""

import pytest
from pyspark.sql import functions as F

from shelfwise.functions.ranks import percentiles, ranked_values
from shelfwise.operators import catalog as ct
from shelfwise.operators import search as sc
from shelfwise.operators import selecting as se
from shelfwise.operators import standardize as st
from shelfwise.plans.standardizing import RuleSet, product_rules, read_rules, write_rules
from shelfwise.session import new_shared_path
from shelfwise.sources.catalog_io import number_products, read_catalog, rejected_documents
from shelfwise.sources.responses import pick_largest_object


def test_broken_documents_are_rejected_and_same_names_keep_their_ids(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"products": [{"name": "x", "reviews": {"sentiment": {"pros": ["p"]}}}, {"name": "x"}], "total": 2}')
    (tmp_path / "b.json").write_text('{"products": [{"name": "x"}], "tot')
    (tmp_path / "c.json").write_text("{}")
    path = f"file://{tmp_path}"
    rows = number_products(read_catalog(spark, path)).orderBy("position").collect()
    assert [(r.name, r.position) for r in rows] == [("x", 0), ("x", 1)] and sorted(r.product_id for r in rows) == [1, 2]
    assert rows[0].reviews.pros == ["p"] and rows[0].reviews.summary is None and rows[1].reviews is None
    assert sorted(r.reason for r in rejected_documents(spark, path).collect()) == ["broken document", "no products"]


def test_loading_appends_and_tells_what_it_leaves_out(spark):
    rows = spark.createDataFrame([(1, "a", 1.0), (2, "a", None), (3, "b", 2.0)], "product_id long, name string, price double")
    existing = rows.where("product_id = 3")
    assert ct.load_products(existing, rows, ["name"]).count() == 3
    assert [r.product_id for r in ct.load_products(existing, rows, ["name"], "new").collect()] == [1]
    left = {(r.product_id, r.reason) for r in ct.left_out(existing, rows, ["name"]).collect()}
    assert left == {(2, "repeated in this load"), (3, "loaded before")}
    assert tuple(ct.load_counts(existing, rows, ["name"], "new").first()) == (3, 1, 2, 1)


def test_products_without_price_or_brand_stay(spark):
    rows = [(1, 7, 10.0, None, None), (2, 7, 20.0, None, 4.0), (3, 7, None, None, None), (4, None, None, None, None)]
    products = spark.createDataFrame(rows, "product_id long, category_id long, price double, brand string, score double")
    products = products.withColumn("features", F.create_map(F.lit("a"), F.lit("Yes")))
    ranked = {r.product_id: (r.price_percentile, r.price_tier) for r in sc.product_rankings(products, {}).collect()}
    assert ranked == {1: (0.0, "budget"), 2: (0.5, "mid-range"), 3: (1.0, "premium"), 4: (0.0, "budget")}
    stats = {r.category_id: tuple(r)[1:] for r in sc.category_stats(products).collect()}
    assert stats == {7: (3, 15.0, 12.5, 15.0, 17.5, 4.0, 0), None: (1, None, None, None, None, None, 0)}


def test_products_without_a_target_take_all_sources(spark):
    source = spark.createDataFrame([(p, r, f"k{r}", "v") for p in (1, 2, 3) for r in (1, 2)], "product_id long, rank long, key string, value string")
    targets = spark.createDataFrame([(1, 1), (3, None)], "product_id long, target long")
    merged, used = se.accumulate_until(source, targets)
    assert {(r.product_id, r.key) for r in merged.collect()} == {(1, "k1"), (2, "k1"), (2, "k2"), (3, "k1"), (3, "k2")}
    assert used.where("product_id = 2").agg(F.max("total_keys")).first()[0] == 2


def test_one_group_with_most_rows_is_ranked_in_parts(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 10 == 0, "small").otherwise("hot").alias("g"), (F.col("id") * 7 % 2999).cast("double").alias("x"))
    ranked = ranked_values(rows, ["g"], "x", splits=64).where("g = 'hot'").orderBy("x").collect()
    below = 0
    for r in ranked:
        assert r.below == below and r.total == 2700
        below += r.n
    for g, values in (("hot", sorted(r.x for r in rows.where("g = 'hot'").collect())), ("small", sorted(r.x for r in rows.where("g = 'small'").collect()))):
        place = 0.95 * (len(values) - 1)
        want = values[int(place)] + (values[int(place) + 1] - values[int(place)]) * (place - int(place))
        assert percentiles(rows, ["g"], "x", {"p": 0.95}).where(F.col("g") == g).first().p == pytest.approx(want)


def test_replies_with_very_many_inner_objects(spark):
    reply = 'x {"list": [' + '{"a": 1}, ' * 100_000 + "0]} y"
    got = pick_largest_object(spark.createDataFrame([(reply,), ("{ a {} {",)], "reply string")).collect()
    assert len(got[0].object) == len(reply) - 4 and got[1].object is None


def test_excluded_phrases(spark):
    rows = [(1, 1, "kettle red"), (2, 1, "washer steel"), (3, 1, "kettle washer pro")]
    products = spark.createDataFrame(rows, "product_id long, category_id long, name string")
    index = sc.build_index(products)
    found = sc.match_text(products, index, '-"kettle washer"')
    assert {r.product_id for r in found.collect()} == {1, 2}
    assert {r.product_id for r in sc.match_text(products, index, 'kettle -"kettle washer"').collect()} == {1}


def test_stored_index_gives_what_the_fresh_one_gives(spark):
    products = spark.createDataFrame([(1, 1, "a b a"), (2, 2, "b"), (3, 2, "")], "product_id long, category_id long, name string")
    path = new_shared_path(spark, "index-test")
    sc.write_index(sc.build_index(products), path)
    stored = {(r.category_id, r.product_id, r.term, r.tf) for r in sc.read_index(spark, path).collect()}
    assert stored == {(1, 1, "a", 2), (1, 1, "b", 1), (2, 2, "b", 1)}


def test_blanks_of_any_kind(spark, eav):
    rows = eav((1, "specs", 0, "w", "5\u00a0kg"), (1, "specs", 1, "d", "\u202f630\u2009mm\u00a0"))
    assert {(r.key, r.value) for r in st.extract_units_auto(rows).collect()} == {("w_kg", "5"), ("d_cm", "63")}


def test_rules_from_storage(spark, eav, tmp_path):
    rows = eav((1, "specs", 0, "weight", "5 kg"), (1, "specs", 1, "old", "x"), (1, "features", 0, "gone", "x"), (1, "features", 1, "alias", "y"))
    rules = RuleSet({"alias": "name"}, ["old"], {"weight": (["kg"], "weight_kg")}, [], ["gone"])
    path = new_shared_path(spark, "rules-test")
    write_rules(spark, rules, path)
    results = [{(r.kind, r.key, r.value) for r in product_rules(rows, x).collect()} for x in (rules, read_rules(spark, path))]
    assert results[0] == results[1] == {("specs", "weight_kg", "5"), ("features", "name", "y")}
    (tmp_path / "m.json").write_text('{"merges": {"a": "b"}}')
    assert read_rules(spark, f"file://{tmp_path}").drops.count() == 0


def test_an_outlier_does_not_put_all_values_into_one_part(spark):
    from shelfwise.functions import ranks

    values = spark.range(20_000).selectExpr("1 as g", "cast(id as double) as v").unionByName(
        spark.sql("select 1 as g, 1e300 as v union all select 1, -1e300 union all select 1, null union all select 2, 5.0D union all select 3, null")
    )
    got = ranks.ranked_values(values, ["g"], "v")
    rows = {(r.g, r.v): (r.n, r.below, r.known, r.total) for r in got.collect()}
    assert rows[(1, -1e300)] == (1, 0, 20_002, 20_003) and rows[(1, 0.0)] == (1, 1, 20_002, 20_003)
    assert rows[(1, 12_345.0)] == (1, 12_346, 20_002, 20_003) and rows[(1, 1e300)] == (1, 20_001, 20_002, 20_003)
    assert rows[(1, None)] == (1, 20_002, 20_002, 20_003) and rows[(2, 5.0)] == (1, 0, 1, 1) and rows[(3, None)] == (1, 0, 0, 1)
    assert len(rows) == 20_005
    shares = {r.g: (r.low, r.mid) for r in ranks.percentiles(values, ["g"], "v", {"low": 0.25, "mid": 0.5}).collect()}
    assert shares[1] == (4_999.25, 9_999.5) and shares[2] == (5.0, 5.0)
