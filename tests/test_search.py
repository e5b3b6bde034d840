import pytest

from shelfwise.operators import search as sc


@pytest.fixture
def shop(spark):
    rows = [
        (1, 1, "Red quiet washer", "Bosch", 500.0, 80.0, {"capacity": "9"}, {"quiet": "Yes", "steam": "No"}),
        (2, 1, "Blue washer", "LG", 700.0, None, {"capacity": "7"}, {"quiet": "No"}),
        (3, 1, "Red kettle washer pro", "Bosch", 300.0, 90.0, {"capacity": "x"}, {"quiet": "Yes", "steam": "Yes"}),
        (4, 2, "Red kettle", "LG", 30.0, 10.0, {}, {}),
    ]
    return spark.createDataFrame(rows, "product_id long, category_id long, name string, brand string, price double, score double, specs map<string,string>, features map<string,string>")


def ids(df):
    return [r.product_id for r in df.collect()]


def test_query_forms(shop):
    index = sc.build_index(shop)
    for query, expected in [
        ("red washer", [1, 3]), ("washer -red", [2]), ("blue or kettle", [2, 3, 4]), ('"kettle washer"', [3]), ('"washer kettle"', []), ("-red", [2]), ("RED, quiet!", [1, 3]),
    ]:
        assert sorted(ids(sc.match_text(shop, index, query))) == expected, query


def test_smart_search_order_and_points(shop):
    index = sc.build_index(shop)
    found = sc.smart_search(shop, index, 1, "washer", 200, 600, ["Bosch"]).collect()
    assert [(r.product_id, round(r.relevance_score, 6)) for r in found] == [(3, 20 + 30 + 20 + 9), (1, 20 + 30 + 20 + 8)]
    assert ids(sc.smart_search(shop, index, 1)) == [3, 1, 2]
    soft = {r.product_id: r.relevance_score for r in sc.smart_search(shop, index, 1, price_max=600, soft_price=True).collect()}
    assert soft == {1: 38.0, 2: 28.0, 3: 39.0}


def test_structured_filter(shop):
    spec = sc.FilterSpec(specs={"capacity": {"min": 8}}, required=["quiet"], excluded=["steam"])
    assert ids(sc.filter_catalog(shop, spec)) == [1]
    ranked = sc.rank_matches(shop, sc.FilterSpec(required=["quiet"])).collect()
    assert [(r.product_id, r.preferred_matched) for r in ranked][:2] == [(3, 0), (1, 0)]


def test_percentile_matches_percent_rank(spark, shop):
    ranked = {r.product_id: r.price_percentile for r in sc.product_rankings(shop, {}).collect()}
    assert ranked == {3: 0.0, 1: 0.5, 2: 1.0, 4: 0.0}


def test_popular_searches_keep_21(spark):
    metrics = spark.createDataFrame([(1, f"q{i:02d}") for i in range(25) for _ in range(i + 1)], "category_id long, query_text string")
    top = sc.popular_searches(metrics).collect()
    assert len(top) == 21 and top[0].query_text == "q24"
