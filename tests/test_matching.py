import random

from pyspark.sql import functions as F

from shelfwise.operators import catalog as ct
from shelfwise.operators import links as lk
from shelfwise.operators import matching as mt
from tests.conftest import plan_of


def tables(spark, texts, patterns):
    return (
        spark.createDataFrame([(t,) for t in texts], "text string").repartition(3),
        spark.createDataFrame([(p, i) for i, p in enumerate(patterns)], "pattern string, ord long").repartition(2),
    )


def found(df):
    return {r.text: (r.pattern, r.ord) for r in df.collect()}


def brute(texts, patterns, hit):
    first = {}
    for i, p in enumerate(patterns):
        if p:
            first.setdefault(p, i)
    out = {}
    for t in set(texts) - {None}:
        hits = [(i, p) for p, i in first.items() if hit(t, p)]
        if hits:
            i, p = min(hits)
            out[t] = (p, i)
    return out


def test_agrees_with_trying_every_pattern(spark):
    random.seed(11)
    word = lambda n: "".join(random.choice("abcé.") for _ in range(n))
    texts = [word(random.randrange(0, 40)) for _ in range(400)] + [None, "", "a", "é"] * 3
    patterns = [word(random.randrange(1, 9)) for _ in range(150)] + ["", None, "abc", "abc", "é", "aaaa.bbbb"]
    t, p = tables(spark, texts, patterns)
    assert found(mt.first_contained(t, p)) == brute(texts, patterns, lambda a, b: b in a)
    assert found(mt.first_prefix(t, p)) == brute(texts, patterns, lambda a, b: a.startswith(b))
    loose = lambda a, b: a.startswith(b) and not (a[len(b) : len(b) + 1].isascii() and a[len(b) : len(b) + 1].isalnum())
    assert found(mt.first_prefix(t, p, whole_words=True)) == brute(texts, patterns, loose)


def test_no_patterns_and_no_texts(spark):
    t, p = tables(spark, ["a"], ["", None])
    none = spark.createDataFrame([], "text string")
    for op in (mt.first_contained, mt.first_prefix):
        assert op(t, p).count() == 0 and op(none, tables(spark, [], ["a"])[1]).count() == 0


def test_a_hundred_thousand_patterns(spark):
    patterns = spark.range(100_000).select(F.concat(F.lit("shop"), F.conv("id", 10, 36), F.lit(".example")).alias("pattern"), F.col("id").alias("ord"))
    texts = spark.range(20_000).select(F.concat(F.lit("https://www.shop"), F.conv(F.col("id") * 7, 10, 36), F.lit(".example/p/"), "id").alias("text"))
    got = mt.first_contained(texts, patterns)
    assert got.where("ord <= 99999").count() == texts.where("true").join(got, "text").count()
    want = spark.range(20_000).where("id * 7 < 100000").count()
    assert got.count() == want
    plan = plan_of(mt.first_contained(texts, patterns))
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_routing_by_table_keeps_the_order_of_the_list(spark):
    links = spark.createDataFrame([("ao", "https://x"), ("B", "https://www.long.example/a"), (None, None), ("c", "https://long.example")], "name string, url string")
    rules = spark.createDataFrame(
        [(5, "Second", ["long.example"], 1, True), (3, "First", ["g.ex", "nothing"], 2, True), (1, "Off", ["/a"], 0, False), (9, "AO", ["q"], 0, True)],
        "ord long, name string, patterns array<string>, priority int, enabled boolean",
    )
    got = {(r.name, r.source, r.priority) for r in lk.route_links(links, rules).collect()}
    # The link with /a belongs to a source that is switched off.
    assert got == {("ao", "AO", 0), ("c", "First", 2)}
    everything = {(r.name, r.source) for r in lk.route_links(links, rules, enabled_only=False).collect()}
    assert everything == {("ao", "AO"), ("c", "First"), ("B", "Off")}


def test_brands_by_table(spark):
    products = spark.createDataFrame([("SHARP R2",), ("Sharpener x",), ("Deluxe",), (None,), ("De Dietrich  oven",)], "name string")
    brands = spark.createDataFrame([("Sharp", 0), ("sharp", 1), ("De Dietrich", 2), ("De", 3)], "brand string, ord int")
    got = {r.name: (r.brand, r.model) for r in ct.split_brand_model(products, brands, strict=True).collect()}
    assert got == {"SHARP R2": ("Sharp", "R2"), "Sharpener x": ("Sharpener", "x"), "Deluxe": ("Deluxe", "Deluxe"), None: (None, None), "De Dietrich  oven": ("De Dietrich", "oven")}


def test_pieces_of_a_text_come_from_one_walk_over_it(spark):
    texts = ["aaaaaa", "line\nbreak", "😀😀x😀y", "é", "", None, "x" * 5000 + "end."]
    patterns = ["aaaa", "e\nbr", "😀x😀", "é", "end.", "😀y"]
    frames = tables(spark, texts, patterns)
    assert found(mt.first_contained(*frames)) == brute(texts, patterns, lambda t, p: p in t)
    longer = tables(spark, texts, ["end."])
    assert "regexp_extract_all" in plan_of(mt.first_contained(*longer))
