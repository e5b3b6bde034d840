import random
import re

import pytest

from shelfwise.operators import facet_index as fi
from shelfwise.operators import search as sc
from tests.conftest import plan_of

SCHEMA = "product_id long, category_id long, name string, brand string, price double, score double, specs map<string,string>, features map<string,string>"


@pytest.fixture(scope="module")
def shop(spark):
    random.seed(12)
    yes = lambda: random.choice(["Yes", "No", "yes"])
    rows = [
        (
            i, i % 2, f"p{i}", random.choice([None, "A", "B", "C"]), random.choice([None, random.randrange(100, 1500) / 1.0]),
            random.choice([None, float(random.randrange(100))]), {"size": random.choice(["7", "8.5", "12", "big"]), "colour": random.choice(["Red", "Blue"])},
            {k: yes() for k in random.sample(["quiet", "steam", "smart"], 2)},
        )
        for i in range(3000)
    ]
    rows.append((9999, 0, None, None, None, None, None, None))
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def index(spark, shop, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("facets"))
    fi.write_facet_index(shop, path)
    return fi.read_facet_index(spark, path)


SPECS = [
    sc.FilterSpec(), sc.FilterSpec(specs={"size": {"min": 8}, "colour": {"in": ["Red"]}}, required=["quiet"], excluded=["steam"], price_max=1200.0),
    sc.FilterSpec(excluded=["quiet", "steam", "smart"]), sc.FilterSpec(specs={"size": {"exact": "big"}}, brands=["A", "C"], score_min=50.0),
    sc.FilterSpec(price_min=300.0, price_max=310.0), sc.FilterSpec(required=["nothing"]), sc.FilterSpec(specs={"size": {"min": 7, "max": 9}}),
]


@pytest.mark.parametrize("spec", SPECS)
def test_counts_are_those_of_a_scan(shop, index, spec):
    kept = sc.filter_catalog(shop.where("category_id = 0"), spec)
    want = sorted((r.facet, r.label, r.products) for r in sc.facets(kept).collect())
    assert sorted((r.facet, r.label, r.products) for r in index.facets(0, spec).collect()) == want
    assert index.count(0, spec).first().products == kept.count()


def test_numbers_have_no_gaps(shop):
    rows = fi.numbered(shop).collect()
    for category in (0, 1):
        assert sorted((r.bucket - 1) * 32768 + r.bit for r in rows if r.category_id == category) == list(range(sum(r.category_id == category for r in rows)))


def test_only_the_index_is_read(index):
    plan = plan_of(index.facets(0, SPECS[1]))
    assert "bitmaps" in plan and "values" in plan and "name#" not in plan and "Python" not in plan
    assert re.search(r"PushedFilters: \[[^]]*EqualTo\(attribute,specs.size\)[^]]*GreaterThan", plan)
