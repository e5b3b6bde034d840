import random
import re
from statistics import median

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import prices as pr


def plain_consensus(prices):
    """Restated on one list, to compare with the DataFrame form."""
    if len(prices) < 2:
        return None
    middle = median(prices)
    kept = sorted(p for p in prices if middle * 0.5 <= p <= middle * 2)
    if len(kept) >= 3:
        groups = []
        for p in kept:
            if groups and p - groups[-1][-1] <= 5:
                groups[-1].append(p)
            else:
                groups.append([p])
        biggest = max(len(g) for g in groups)
        if biggest > 1:
            return median(next(g for g in groups if len(g) == biggest))
    return median(kept)


def consensus(spark, offers):
    df = spark.createDataFrame(offers, "product_id long, price double")
    return {r.product_id: r.target_price for r in pr.consensus_price(df).collect()}


def test_known_targets(spark):
    known = {1: ([5.0], None), 2: ([1.0, 100.0], 100.0), 3: ([100.0, 102.0, 104.0, 150.0, 900.0], 102.0)}
    assert consensus(spark, [(p, x) for p, (prices, _) in known.items() for x in prices]) == {p: t for p, (_, t) in known.items()}


def test_random_offers_match_a_plain_loop(spark):
    rng = random.Random(7)
    offers = {p: [round(rng.choice([20, 200, 900]) * rng.uniform(0.8, 1.3), rng.choice([0, 2])) for _ in range(rng.randint(1, 14))] for p in range(300)}
    offers[999] = [round(rng.gauss(300, 40), 1) for _ in range(3000)]  # one product with most offers
    got = consensus(spark, [(p, x) for p, xs in offers.items() for x in xs])
    for p, xs in offers.items():
        want = plain_consensus(xs)
        assert got[p] == (None if want is None else pytest.approx(want)), p


def test_split_products_match_a_plain_loop(spark):
    rng = random.Random(8)
    offers = {p: [round(rng.choice([20, 200, 900]) * rng.uniform(0.7, 1.4), rng.choice([0, 2])) for _ in range(rng.randint(1, 40))] for p in range(200)}
    offers[500] = [round(rng.gauss(300, 60), 2) for _ in range(4000)]
    offers[501] = [float(x) for x in range(100, 400, 5)] + [500.0, 505.01, 510.0]  # one cluster over all range borders
    df = spark.createDataFrame([(p, x) for p, xs in offers.items() for x in xs], "product_id long, price double")
    for width in (3.0, 16.0, 1000.0):
        got = {r.product_id: r for r in pr.consensus_price(df, prices_a_task=0, width=width).collect()}
        whole = {r.product_id: r for r in pr.consensus_price(df).collect()}
        assert set(got) == set(whole) == set(offers)
        for p, xs in offers.items():
            want = plain_consensus(xs)
            assert got[p].target_price == (None if want is None else pytest.approx(want)), (p, width)
            assert (got[p].n_offers, got[p].n_kept) == (whole[p].n_offers, whole[p].n_kept)


def test_a_product_of_very_many_prices_is_many_tasks(spark):
    rows = spark.range(200_000).selectExpr("7L as product_id", "1 + (id * 7919 % 200000) / 100 as price").unionByName(
        spark.range(50).selectExpr("id as product_id", "cast(id as double) as price").where("product_id <> 7")
    )
    got = {r.product_id: r.target_price for r in pr.consensus_price(rows).collect()}
    assert len(got) == 50
    # The middle of 1.00 to 2000.99 is 1001; half to twice that is 500.50 to 2000.99, one cluster.
    assert got[7] == pytest.approx((500.5 + 2000.99) / 2, abs=0.02)
    plan = pr._consensus_of_split(rows.groupBy("product_id", "price").agg(F.count("*").alias("n")), 5.0, 16.0)._jdf.queryExecution().executedPlan().toString()
    assert "windowspecdefinition(product_id" in plan
    assert not re.search(r"windowspecdefinition\(product_id#\d+L?, price", plan)


def test_price_mentions(spark):
    pages = spark.createDataFrame([(1, "Was £1299.99 now £1,099.50, GBP 45, 0.50 GBP, 78 GBP and £20000")], "doc_id long, text string")
    assert [r.price for r in pr.extract_prices(pages).orderBy("form", "position").collect()] == [1299.99, 1099.5, 45.0, 78.0]
    assert [r.price for r in pr.extract_prices(pages, strict=False).orderBy("form", "position").collect()] == [129.0, 1099.5, 200.0, 45.0, 78.0]


def test_repair(spark):
    mentions = spark.createDataFrame([(1, 1, 0, 100.0), (1, 2, 0, 10.0), (1, 2, 1, 105.0), (1, 3, 0, 500.0), (2, 1, 0, 7.0)], "product_id long, source_id long, ord int, price double")
    targets = spark.createDataFrame([(1, 100.0), (2, None)], "product_id long, target_price double")
    got = {(r.product_id, r.source_id): (r.price, r.repaired) for r in pr.repair_prices(mentions, targets).collect()}
    assert got == {(1, 1): (100.0, False), (1, 2): (105.0, True), (2, 1): (7.0, False)}
