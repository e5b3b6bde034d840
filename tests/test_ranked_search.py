import random
import re

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import ranked_search as rs
from shelfwise.operators import search as sc
from tests.conftest import plan_of

SCHEMA = "product_id long, category_id long, name string, brand string, price double, score double, specs map<string,string>, features map<string,string>"


@pytest.fixture(scope="module")
def shop(spark):
    random.seed(9)
    words = "quiet washer dryers drying steam the washed energy rating capacity of kettle pro smart".split()
    rows = []
    for i in range(4000):
        name = " ".join(random.choices(words, k=5)) if i % 7 else "washer"
        # Most products share one score; some have none, some no price.
        score = random.choice([None, 50.0, 50.0, 50.0, 50.0, float(random.randrange(101))])
        price = None if i % 31 == 0 else float(random.randrange(50, 2000))
        rows.append((i, i % 3, name, f"B{i % 5}", price, score, {"colour": random.choice(words)}, {"timer": random.choice(["Yes", "No"])}))
    rows.append((9000, 1, None, None, None, None, None, None))
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def index(spark, shop, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("ranked"))
    rs.write_ranked_index(shop, path, block_rows=32)
    return rs.read_ranked_index(spark, path)


def rows(df):
    return [(r.product_id, round(r.relevance_score, 9) if r.relevance_score is not None else None) for r in df.collect()]


SEARCHES = [
    ("washers", {}), ("quiet the drying", {"price_min": 300.0, "price_max": 700.0}), ("steam or kettles -pro", {"price_max": 400.0, "soft_price": True}),
    ('"energy ratings"', {}), ('washer -"energy rating"', {"brands": ["B1", "B2"]}), ("-quiet", {}), (None, {"price_min": 900.0}), ("the of", {}),
    ("nosuchword", {}), ("smart quiet steam washing", {"limit": 5}), (None, {"limit": 7}), ("washer", {"price_min": 100.0, "price_max": 120.0, "soft_price": True, "limit": 10}),
]


@pytest.mark.parametrize("text,how", SEARCHES)
def test_blocks_give_the_same_rows_as_scoring_everything(spark, index, text, how):
    how = dict(how)
    limit = how.pop("limit", 200)
    got = rows(rs.ranked_search(index, 1, text, limit=limit, **how))
    search = rs.RankedSearch(index, 1, rs.analyse(spark, text) if text else None, **how)
    assert got == rows(search._ordered(search.scored(), limit))
    assert len(got) == len(set(got)) and (got or text in ("the of", "nosuchword"))


def test_matches_are_those_of_the_stems(spark, shop, index):
    got = {r.product_id for r in rs.ranked_search(index, 2, "dryer washes", limit=5000).collect()}
    # `dryers` and `dryer` are one stem, `drying` is another one; `washed` and `washes` are one, `washer` is not.
    want = {
        r.product_id for r in shop.where("category_id = 2").collect()
        if {"dryers"} & set(f"{r.name} {r.specs['colour']}".split()) and {"washed"} & set(f"{r.name} {r.specs['colour']}".split())
    }
    assert got == want and want


def test_no_block_is_hot_and_bounds_hold(index):
    sizes = [r.n for r in index.blocks.collect()]
    assert max(sizes) < 3 * 32 and len(sizes) > 60
    worst = index.postings.groupBy("category_id", "term", "block").agg(F.max("weight").alias("w")).join(index.bounds, ["category_id", "term", "block"])
    assert worst.where("w > max_weight").count() == 0 and worst.count() == index.bounds.count()


def scanned(df, column):
    """Rows that the scan with this column has put out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found, todo = 0, [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if "Scan" in name and column in node.output().mkString(","):
            found += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_fewer_index_rows_are_read(spark, tmp_path):
    rows_ = [(i, 1, f"washer {i % 50}", "B", 100.0, float(i % 101), {}, {}) for i in range(20_000)]
    products = spark.createDataFrame(rows_, SCHEMA)
    rs.write_ranked_index(products, str(tmp_path / "a"), block_rows=128)
    index = rs.read_ranked_index(spark, str(tmp_path / "a"))
    search = rs.RankedSearch(index, 1, rs.analyse(spark, "washers"))
    best = search.best(100)
    everything = search._ordered(search.scored(), 100)
    assert rows(best) == rows(everything)
    assert 0 < scanned(search.best(100), "weight") < 0.25 * scanned(search._ordered(search.scored(), 100), "weight")


def test_phrases_come_from_the_index(spark, shop, tmp_path):
    sc.write_index(sc.build_index(shop, positions=True), str(tmp_path / "index"))
    index = sc.read_index(spark, str(tmp_path / "index"))
    plain = sc.build_index(shop)
    for query in ('"energy rating" washer', 'quiet -"smart steam"', '"the quiet" or "kettle pro"', '"washer washer"', '"pro b1"', '"rating capacity of"'):
        placed = sc.match_text(shop, index, query)
        by_text = sc.match_text(shop, plain, query, text=sc.search_text(shop))
        assert sorted(r.product_id for r in placed.collect()) == sorted(r.product_id for r in by_text.collect()), query
        assert "RLIKE" not in plan_of(placed).upper() and "RLIKE" in plan_of(by_text).upper()
        assert re.search(r"PushedFilters: \[[^]]*term", plan_of(placed))


def test_postings_are_worked_out_once(spark, shop, tmp_path):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(name):
        read.add(1)
        return name

    products = shop.limit(200).localCheckpoint()
    rs.write_ranked_index(products.withColumn("name", counted("name")), f"{tmp_path}/index", block_rows=32)
    assert read.value == 200
    assert rs.read_ranked_index(spark, f"{tmp_path}/index").postings.select("product_id").distinct().count() == 200
