import random

from pyspark.sql import functions as F

from shelfwise.operators import browsing as br
from shelfwise.streaming.jobs import SKETCH_RANK_ERROR, hourly_sketches, rollup_sketches
from tests.conftest import plan_of


def test_completion_reads_its_folder_only(spark, tmp_path):
    names = ["Bosch A", "bosch b", "BOSCH C", "Beko", "b", "Électro", "électro 2", "x/y=z", "", None] + ["Bosch A"] * 3 + [f"Smeg {i}" for i in range(500)]
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(3)
    br.write_names(df, str(tmp_path / "n"))
    stored = br.read_names(spark, str(tmp_path / "n"))
    for prefix in ("bo", "BOSCH", "b", "é", "x/", "", "smeg 4", "nothing"):
        want = sorted({n for n in names if n is not None and n.lower().startswith(prefix.lower())})[:10]
        assert [r.name for r in br.complete_stored(stored, prefix).collect()] == want, prefix
    plan = plan_of(br.complete_stored(stored, "smeg 4"))
    assert "PartitionFilters: [isnotnull(head" in plan and "GreaterThanOrEqual(low,smeg 4)" in plan


def test_pages_follow_each_other(spark):
    random.seed(2)
    rows = [(i, random.choice([None, 1.0, 2.0, 2.0, 3.5]), random.choice(["a", "b", None])) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, price double, kind string").repartition(3)
    for order in ([("price", True), ("id", False)], [("kind", False), ("price", True), ("id", True)]):
        columns = [c for c, _ in order]
        whole = [tuple(r) for r in df.orderBy(*[F.desc_nulls_last(c) if d else F.asc_nulls_last(c) for c, d in order]).select(columns).collect()]
        got, last = [], None
        while page := [tuple(r) for r in br.page_after(df, order, 30, last).select(columns).collect()]:
            got, last = got + page, page[-1]
        assert got == whole
    plan = plan_of(br.page_after(df, [("price", True), ("id", False)], 30, (2.0, 7)))
    assert "TakeOrderedAndProject" in plan


def test_merged_sketches_keep_their_error(spark):
    hours = spark.range(240_000).selectExpr(
        "timestamp_seconds(1700000000 - 1700000000 % 3600 + (id % 24) * 3600) as created_at", "id % 2 as category_id",
        "pow(hash(id) % 1000 / 100.0, 4) + (id % 24) * 10 as execution_time_ms", "id % 3 = 0 as cache_hit",
    ).unionByName(spark.sql("select timestamp'2030-01-01 00:10' as created_at, 9L as category_id, cast(null as double) as execution_time_ms, false as cache_hit"))
    merged = {r.category_id: r for r in rollup_sketches(hourly_sketches(hours), "category_id").collect()}
    assert merged[0].hours == 12 and merged[9].p50_latency is None and merged[9].search_count == 1
    for category in (0, 1):
        own = hours.where(F.col("category_id") == category)
        n = own.count()
        for column, share in (("p50_latency", 0.5), ("p95_latency", 0.95)):
            below = own.where(F.col("execution_time_ms") <= merged[category][column]).count()
            assert abs(below / n - share) <= SKETCH_RANK_ERROR + 1 / n
