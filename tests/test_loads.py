import os

import pytest

from shelfwise.operators import metadata as md
from shelfwise.sources.loads import CommitConflict, LoadedTable

SCHEMA = "category_id long, field_values long, price double"


@pytest.fixture
def table(spark, tmp_path):
    return LoadedTable(spark, str(tmp_path / "t"), SCHEMA, ["category_id"], buckets=8)


def rows(spark, *tuples):
    return spark.createDataFrame(list(tuples), SCHEMA)


def content(table):
    return sorted(map(tuple, table.read().collect()), key=str)


def test_a_load_counts_once(spark, table):
    assert content(table) == [] and table.loads() == []
    first = rows(spark, (1, 1, 1.0), (2, 2, None), (None, 3, 3.0))
    assert table.append(first, "a") and not table.append(first, "a")
    assert table.append(rows(spark, (1, 9, 9.0)), "b") and table.loads() == ["a", "b"]
    assert content(table) == sorted([(1, 1, 1.0), (2, 2, None), (None, 3, 3.0), (1, 9, 9.0)], key=str)
    assert not table.append(rows(spark), "a") and table.append(rows(spark), "empty")
    assert len(content(table)) == 4


def test_a_load_that_was_cut_off_leaves_the_table_as_it_was(spark, table, monkeypatch):
    table.append(rows(spark, (1, 1, 1.0)), "a")
    with monkeypatch.context() as m:
        m.setattr(LoadedTable, "_commit", lambda *_: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            table.append(rows(spark, (2, 2, 2.0)), "b")
    assert content(table) == [(1, 1, 1.0)] and table.loads() == ["a"]
    assert table.append(rows(spark, (2, 2, 2.0)), "b")
    assert content(table) == [(1, 1, 1.0), (2, 2, 2.0)]


def test_of_two_loads_at_once_one_has_to_run_again(spark, table, monkeypatch):
    table.append(rows(spark, (1, 1, 1.0)), "a")
    number, before = table._latest()
    table.append(rows(spark, (2, 2, 2.0)), "faster")
    with monkeypatch.context() as m:
        m.setattr(LoadedTable, "_latest", lambda self: (number, before))
        with pytest.raises(CommitConflict):
            table.append(rows(spark, (3, 3, 3.0)), "slower")
    assert content(table) == [(1, 1, 1.0), (2, 2, 2.0)]
    assert table.append(rows(spark, (3, 3, 3.0)), "slower") and len(content(table)) == 3


def test_an_upsert_leaves_other_buckets_alone(spark, table):
    table.append(rows(spark, *[(i, i, float(i)) for i in range(100)]), "a")
    _, before = table._latest()
    merge = lambda old, new: md.upsert_metadata(old, new, ["price"]).drop("action")
    fresh = rows(spark, (5, 50, None), (1000, 7, 1.5))
    assert table.upsert(fresh, "u", merge) and not table.upsert(fresh, "u", merge)
    _, after = table._latest()
    changed = {b for b in after["buckets"] if after["buckets"][b] != before["buckets"].get(b)}
    assert 1 <= len(changed) <= 2
    want = [(i, 50 if i == 5 else i, float(i)) for i in range(100)] + [(1000, 7, 1.5)]
    assert content(table) == sorted(want, key=str)
    folder = after["buckets"][min(changed)][0]
    assert len([n for n in os.listdir(f"{table.path}/{folder}") if n.startswith("_bucket=")]) == len(changed)
