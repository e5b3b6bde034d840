import random

import pytest

from shelfwise.operators import standardize as st
from shelfwise.sources.loads import LoadedTable
from shelfwise.streaming.live import LiveCatalog

EAV = "product_id long, kind string, ord long, key string, value string, version long"


def load(spark, catalog, versions, name):
    """Absorbs {(product, version): [(kind, key, value), ...]}."""
    products = spark.createDataFrame([(p, v) for p, v in versions], "product_id long, version long")
    rows = [(p, kind, i, key, value, v) for (p, v), attributes in versions.items() for i, (kind, key, value) in enumerate(attributes)]
    catalog.absorb(products, spark.createDataFrame(rows, EAV), name)


def state(catalog):
    stats = sorted(map(tuple, catalog.stats().collect()))
    assert stats == sorted(tuple(r) for r in st.key_stats(catalog.rows()).select("kind", "key", "products", "boolean").collect())
    return catalog.n_products(), stats, sorted(map(tuple, catalog.rows().select("product_id", "key", "value").collect()), key=str)


def test_profile_follows_repeated_and_late_products(spark, tmp_path):
    catalog = LiveCatalog(spark, str(tmp_path))
    assert state(catalog) == (0, [], [])
    load(spark, catalog, {(1, 1): [("specs", "a", "Yes"), ("specs", "b", "5")], (2, 1): [("specs", "a", "no")], (3, 1): []}, "0")
    assert state(catalog) == (3, [("specs", "a", 2, True), ("specs", "b", 1, False)], [(1, "a", "Yes"), (1, "b", "5"), (2, "a", "no")])
    # Product 1 loses b, changes a; two versions of 2 in one batch; 3 comes late.
    load(spark, catalog, {(1, 2): [("specs", "a", "7")], (2, 2): [("specs", "c", "x")], (2, 5): [("features", "c", " ")], (3, 0): [("specs", "z", "1")]}, "1")
    want = (3, [("features", "c", 1, False), ("specs", "a", 1, False)], [(1, "a", "7"), (2, "c", " ")])
    assert state(catalog) == want
    load(spark, catalog, {(9, 9): [("specs", "q", "1")]}, "1")
    assert state(catalog) == want, "a batch counts once"
    load(spark, catalog, {(2, 5): []}, "2")
    assert state(catalog) == (3, [("specs", "a", 1, False)], [(1, "a", "7")])


def test_a_batch_cut_off_between_its_commits_is_made_whole(spark, tmp_path, monkeypatch):
    random.seed(1)
    catalog = LiveCatalog(spark, str(tmp_path))
    load(spark, catalog, {(p, 1): [("specs", "a", str(p))] for p in range(5)}, "0")
    batch = {(p, 2): [("specs", "b", "Yes")] for p in range(3, 8)}
    with monkeypatch.context() as m:
        m.setattr(LoadedTable, "upsert", lambda *_: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            load(spark, catalog, batch, "1")
    load(spark, catalog, batch, "1")
    assert state(catalog)[:2] == (8, [("specs", "a", 3, False), ("specs", "b", 5, True)])
