import hashlib
import random
import re

from shelfwise.llm import decontaminate as op


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, window=10):
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for item, phrase in items:
            p = words(phrase)
            m = min(window, len(p))
            for s in range(len(p) - m + 1 if m else 0):
                for at in range(len(w) - m + 1):
                    if w[at : at + m] == p[s : s + m]:
                        hit |= set(range(at, at + m))
                        found.add(item)
        ids = ",".join(sorted(str(x) for x in found if x is not None))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out)


def case():
    rng = random.Random(2)
    vocabulary = ["a", "b", "c", "É", "x1", "der"]
    some = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, some(rng.choice([0, 1, 3, 9, 10, 11, 14, 30]))) for i in range(12)] + [(12, None), (13, "a"), (2, some(12))]
    docs = [(i, some(rng.choice([0, 1, 5, 40, 200])) + rng.choice(["", " ", ". "]) + (rng.choice(items)[1] or "").upper().replace(" ", ", ")) for i in range(40)]
    return docs + [(100, None), (101, "")], items


def test_agrees_with_comparing_every_place(spark, docs):
    rows, items = case()
    got = op.contamination(docs(rows), spark.createDataFrame(items, "item_id long, text string"))
    # "É" is no ASCII letter: upper-casing the items above does not change it.
    assert sorted(map(tuple, got.collect())) == brute(rows, items)


def test_blocks_of_items_give_the_same(spark, docs, monkeypatch):
    rows, items = case()
    monkeypatch.setattr(op, "BLOCK_ITEM_BYTES", 200)
    got = op.contamination(docs(rows), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect())) == brute(rows, items)


def test_items_without_an_id_and_ids_of_any_type(spark, docs):
    rows = [(1, "x y z q"), (2, "q r"), (3, "none")]
    got = op.contamination(docs(rows), spark.createDataFrame([(None, "y z"), (None, "q"), (7, "q r")], "item_id long, text string"))
    assert sorted(map(tuple, got.collect())) == brute(rows, [(None, "y z"), (None, "q"), (7, "q r")])
    assert {r.doc_id: (r.n_hit, r.n_items) for r in got.collect()} == {1: (3, 1), 2: (2, 2), 3: (0, 0)}
    named = [("b", "y z"), ("a", "y"), (None, "q")]
    got = op.contamination(docs(rows), spark.createDataFrame(named, "item_id string, text string"))
    assert sorted(map(tuple, got.collect())) == brute(rows, named)
    assert op.drop_contaminated(docs(rows), spark.createDataFrame([(None, "y z")], "item_id long, text string")).count() == 2


def test_no_items_and_no_documents(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.contaminated for r in op.contamination(docs([(1, "a b")]), none).collect()] == [False]
    assert op.contamination(docs([]), none).count() == 0


def test_dropping_keeps_columns(spark):
    df = spark.createDataFrame([(1, "a b c", 5), (2, "x", 6), (2, "x", 6)], "doc_id long, text string, hits int")
    left = op.drop_contaminated(df, spark.createDataFrame([(1, "b")], "item_id long, text string"))
    assert left.columns == df.columns and [tuple(r) for r in left.collect()] == [(2, "x", 6), (2, "x", 6)]


def test_search_moves_on_over_absent_blocks():
    (searcher,) = op.compile_items([(1, b"a b c d e f g h i j")])
    assert searcher.default == 9 and searcher.shift[(b"a", b"b")] == 8 and searcher.shift[(b"i", b"j")] == 0
    assert [at for at, _ in searcher.find([b"z"] * 30 + list(map(bytes, ([c] for c in b"abcdefghij"))))] == [30]
