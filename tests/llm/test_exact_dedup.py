import hashlib
import random
import re

from shelfwise.llm import exact_dedup as op


def brute(rows):
    texts = [(i, re.sub(r"[\x20\x09-\x0d]+", " ", t or "")) for i, t in rows]
    out = []
    for i, t in texts:
        ids = [j for j, u in texts if u == t]
        out.append((i, min(ids), len(ids), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out)


ROWS = [
    (5, "one  two\n"), (3, "one two "), (9, "one two"), (1, None), (2, ""), (4, "  "), (6, "\t"), (7, "é" * 70_000), (8, "é" * 70_000),
    (10, "x" * 65_536), (11, "x" * 65_537), (12, "a b"), (13, "a b"),
]


def result(df):
    return sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect())


def test_groups_equal_texts(docs):
    assert result(op.exact_duplicates(docs(ROWS))) == brute(ROWS)


def test_colliding_fingerprints_are_told_apart_by_the_texts(docs):
    rows = ROWS + [(20 + i, f"text {i % 13}") for i in range(60)]
    # Hardly any two texts of one length have different fingerprints under such a small modulus.
    assert result(op.exact_duplicates(docs(rows), modulus=2)) == brute(rows)


def test_repeated_rows_and_null_ids(docs):
    got = op.exact_duplicates(docs([(1, "a"), (1, "a"), (None, "a"), (None, "b"), (None, "b")])).collect()
    assert sorted((r.doc_id or -1, r.keep_id or -1, r.group_size) for r in got) == [(-1, -1, 2), (-1, -1, 2), (-1, 1, 3), (1, 1, 3), (1, 1, 3)]
    assert sum(r.kept for r in got) == 2


def test_very_many_rows_of_one_id_meet_one_model_each(spark, docs, monkeypatch):
    monkeypatch.setattr(op, "COPIES_PER_SALT", 4)
    rows = [(None, "same text")] * 3000 + [(4, "same  text")] * 500 + [(9, "other")] * 500 + [(None, "other")] * 10
    made = []
    monkeypatch.setattr(op, "_chunk_rows", lambda df, f=op._chunk_rows: made.append(f(df)) or made[-1])
    got = op.exact_duplicates(docs(rows)).collect()
    assert len(got) == 4010 and sum(r.kept for r in got) == 2
    assert {(r.keep_id, r.group_size) for r in got} == {(4, 3500), (9, 510)}
    # A row each, and a model for each part of a group: no square of a group's size.
    assert made[0].count() == 4010
    assert made[0].selectExpr("sum(size(salts))").first()[0] <= 4008 + 4010 / 4 + 2


def test_a_task_that_compares_texts_needs_one_python_worker(spark, docs, monkeypatch):
    plans = []
    monkeypatch.setattr(op, "_false_members", lambda *a, f=op._false_members: plans.append(f(*a)) or plans[-1])
    assert result(op.exact_duplicates(docs(ROWS))) == brute(ROWS)
    plan = plans[0]._jdf.queryExecution().optimizedPlan().toString()
    # One pass over the texts in front of the shuffle and one behind it, whichever join stands between.
    assert plan.count("MapInArrow") == 2
    assert plan.index("MapInArrow") < plan.index("RepartitionByExpression") < plan.rindex("MapInArrow")


def test_empty_table(docs):
    assert op.exact_duplicates(docs([])).count() == 0 and op.drop_copies(docs([])).count() == 0


def test_dropping_keeps_columns_and_one_row_of_each_group(spark):
    rows = [(1, "a b", 7, "x"), (2, "a  b", 8, "y"), (3, "c", 9, "z"), (3, "c", 9, "z"), (4, None, 1, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int, _kept string")
    left = op.drop_copies(df)
    assert left.columns == df.columns
    assert sorted((r.doc_id, r.fp) for r in left.collect()) == [(1, 7), (3, 9), (4, 1)]


def test_hashes_of_pieces_combine():
    random.seed(1)
    text = random.randbytes(3 * op.CHUNK_BYTES + 17)
    for base in op.BASES:
        for at in (1, 1000, op.CHUNK_BYTES):
            left, right = text[:at], text[at : at + op.CHUNK_BYTES]
            whole = 0
            for b in left + right:
                whole = (whole * base + b + 1) % op.MODULUS
            assert op.combine(op.chunk_hash(left, base), op.chunk_hash(right, base), len(right), base) == whole
