import pytest

from shelfwise.operators import links as lk
from shelfwise.rules import SOURCES, Source, check_sources

WRAPPED = "https://clicks.trx-hub.com/xid/a?q=https%3A%2F%2Fgo.digidip.net%2Fvisit%3Furl%3Dhttps%253A%252F%252Fwww.appliancesdirect.co.uk%252Fp%252Fhp6"


CLEANED = [
    ("Amazon Marketplace", "https://www.amazon.co.uk/dp/B0F677DTFL?tag=a-21&th=1", "https://www.amazon.co.uk/dp/B0F677DTFL", "item"),
    ("AO", "https://clicks.trx-hub.com/xid/a?q=https%3A%2F%2Fwww.awin1.com%2Fp%3D1", "https://ao.com", "home_page"),
    ("Marks Electrical", "https://visit.markselectrical.co.uk/click?a(1)url(https%3A%2F%2Fmarkselectrical.co.uk%2F1_x%3Fa%3Db%26c%3Dd)", "https://markselectrical.co.uk/1_x?a=b&c=d", "embedded"),
    ("Ryman UK", "https://go.digidip.net/visit?url=https%3A%2F%2Fwww.ryman.co.uk%2Fkettle", "https://www.ryman.co.uk/kettle", "embedded"),
    ("Appliances Direct", WRAPPED, "https://www.appliancesdirect.co.uk", "home_page"),
    ("John Lewis", "https://www.pricerunner.com/uk/goto/1", "https://www.pricerunner.com/uk/goto/1", "unchanged"),
    ("George at ASDA", "https://zeta-live.getsquirrel.co/marketplace/96?click_ref=1", "https://direct.asda.com", "home_page"),
    ("Unknown Store", "https://clicks.trx-hub.com/xid/a?q=https%3A%2F%2Fwww.awin1.com", "https://clicks.trx-hub.com/xid/a?q=https%3A%2F%2Fwww.awin1.com", "unchanged"),
    ("Nowhere", "not a url", "not a url", "unchanged"),
]


def test_clean_links(spark):
    rows = lk.clean_links(spark.createDataFrame([c[:2] for c in CLEANED], "name string, url string")).collect()
    assert [(r.name, r.url, r.clean_url, r.method) for r in rows] == CLEANED


def test_nested_targets_unwrap(spark):
    row = lk.unwrap_links(spark.createDataFrame([(WRAPPED,)], "url string")).first()
    assert row.target_url == "https://www.appliancesdirect.co.uk/p/hp6"


def test_redirect_chains_loops_and_limits(spark):
    edges = [(f"h{i}", f"h{i + 1}") for i in range(15)] + [("a", "b"), ("b", "a"), ("https://x.com/p?q=1", "/next"), ("https://x.com/next", "//y.com/z")]
    urls = ["h0", "h12", "a", "b", "https://x.com/p?q=1", "lonely"]
    got = lk.resolve_redirects(spark.createDataFrame([(u,) for u in urls], "url string"), spark.createDataFrame(edges, "src string, dst string"))
    assert {r.url: (r.final_url, r.hops) for r in got.collect()} == {
        "h0": ("h10", 10), "h12": ("h15", 3), "a": ("a", 10), "b": ("b", 10), "https://x.com/p?q=1": ("https://y.com/z", 2), "lonely": ("lonely", 0),
    }


def test_pick_links_takes_one_manufacturer(spark):
    urls = ["https://philips.com/1", "https://www.philips.com/2", "https://shop.example/3", "https://techradar.com/4", "https://ao.com/5", "https://z.example/6"]
    links = spark.createDataFrame([(1, i, u) for i, u in enumerate(urls)], "product_id long, ord long, url string")
    picked = lk.pick_links(lk.classify_links(links)).orderBy("pick").collect()
    assert [r.url for r in picked] == [urls[0], urls[3], urls[2]]


def test_sources_are_unique():
    assert check_sources(SOURCES) is SOURCES
    with pytest.raises(ValueError):
        check_sources([Source("AO", ("x",)), Source("ao", ("y",))])


def test_route_by_name_then_pattern(spark):
    links = spark.createDataFrame([("ao", "https://x"), ("Other", "https://www.AMAZON.co.uk/dp/1"), ("Other", "https://nobody")], "name string, url string")
    assert [(r.source, r.priority) for r in lk.route_links(links).orderBy("priority").collect()] == [("AO", 0), ("Amazon", 999)]
