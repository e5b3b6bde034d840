import zlib

import pytest

from shelfwise.llm import sharding as op
from tests.conftest import plan_of


def test_every_row_a_gapless_slot_and_one_more_shard_takes_into_itself(spark, docs, monkeypatch):
    monkeypatch.setattr(op, "ROWS_A_RANGE", 7)
    monkeypatch.setattr(op, "SLOTS_A_BLOCK", 9)
    rows = [(i, f"text é {i}") for i in range(600)] + [(5, "again")] * 40 + [(None, None)] * 50 + [(700, ""), (701, "long " * 60_000)]
    df = docs(rows).selectExpr("doc_id", "text", "1 as shard", "2 as slot", "'x' as _n")
    got = op.shard_table(df, 5, founded=4).collect()
    assert sorted(map(str, ((r.doc_id, r.size, r.text_crc32) for r in got))) == sorted(
        str((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))) for i, t in rows
    )
    for shard in range(5):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots))) and slots
    moved = [r for r in got if r.shard != r.grown_shard]
    assert moved and all(r.grown_shard == 5 for r in moved)
    assert all(r.law == "key" for r in got)
    assert len({r.shard for r in got if r.doc_id is None}) == 1
    assert op.shard_table(df.filter("false")).count() == 0


@pytest.mark.parametrize("shards", [1, 2, 7, 16, 17, 23])
def test_shards_are_about_even_and_growth_is_confined(spark, shards):
    got = op.shard_table(spark.range(4000).selectExpr("id as doc_id", "'' as text"), shards).groupBy("shard", "grown_shard").count().collect()
    assert all(r.grown_shard in (r.shard, shards) for r in got)
    sizes = {s: sum(r["count"] for r in got if r.shard == s) for s in range(shards)}
    assert min(sizes.values()) > 0.6 * 4000 / shards and max(sizes.values()) < 1.5 * 4000 / shards


def test_a_changed_weight_moves_rows_along_its_path_only(spark):
    leaves = op.topology(16)
    heavier = [leaf._replace(weight=3.0) if leaf.shard == 5 else leaf for leaf in leaves]
    keys = spark.range(3000)
    got = keys.select("id", op.shard_of(keys["id"], leaves).alias("a"), op.shard_of(keys["id"], heavier).alias("b")).collect()
    at = {leaf.shard: leaf for leaf in leaves}
    moved = [(at[r.a], at[r.b]) for r in got if r.a != r.b]
    assert moved
    for old, new in moved:
        # Between regions only into the heavier one, between its racks only into the heavier one, inside that only to the shard.
        assert new.region == at[5].region
        if old.region == new.region:
            assert new.rack == at[5].rack
            assert old.rack != new.rack or new.shard == 5
    gone = [leaf._replace(weight=0.0) if leaf.shard == 5 else leaf for leaf in leaves]
    assert keys.select(op.shard_of(keys["id"], gone).alias("s")).filter("s = 5").count() == 0
    share = sum(r.b == 5 for r in got) / len(got)
    assert abs(share - 3 / 18) < 0.03


def test_a_topology_needs_shards():
    for leaves in ([], [op.Leaf("r", "k", 1, 0.0)], [op.Leaf("r", "k", 1), op.Leaf("r", "j", 1)]):
        with pytest.raises(ValueError):
            op.tree_levels(leaves)


def test_written_shards_hold_all_rows(spark, docs, tmp_path):
    df = docs([(i % 50, f"t{i}") for i in range(300)]).selectExpr("doc_id", "text", "7 as shard")
    op.write_shards(df, f"{tmp_path}/out", files=2)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == 300 and back.filter("_shard = 7").count() == 300
    assert back.select("shard").distinct().count() > 8 and back.groupBy("doc_id").agg({"shard": "max"}).count() == 50


def test_no_python_in_the_plan(spark, docs):
    plan = plan_of(op.shard_table(docs([(1, "a"), (2, "b")])))
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
