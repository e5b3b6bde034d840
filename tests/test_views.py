from pyspark.sql import functions as F

from shelfwise.plans.views import ROWS_A_TASK, Views, spread


def part_of(spark, n):
    return spark.range(n).selectExpr(
        "id as p_partkey", "'nut' as p_name", "'Brand#1' as p_brand", "'T' as p_type", "cast(id % 50 as int) as p_size", "900.0 + id as p_retailprice"
    )


def test_rows_that_become_many_are_the_work_of_many_tasks(spark, tmp_path):
    n = 2 * ROWS_A_TASK + 1
    part_of(spark, n).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    views = Views(spark, str(tmp_path))
    assert views.fx_spec.rdd.getNumPartitions() == 3
    per_task = views.part.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per_task) == n and max(r["count"] for r in per_task) < 1.2 * ROWS_A_TASK


def test_spread_keeps_repeated_and_null_keys(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, "b"), (2, None)], "p_partkey long, p_name string")
    assert sorted(map(str, spread(rows, "p_partkey", 5, 2).collect())) == sorted(map(str, rows.collect()))
    assert spread(rows, "p_partkey", 5, 5) is rows and spread(rows.limit(0), "p_partkey", 0).count() == 0
