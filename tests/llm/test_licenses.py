import re

from shelfwise.llm import licenses as op

TEXTS = [
    "Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3.", "ALL RIGHTS\nreserved. all rights reserved",
    "Released under the MIT License.", "cc", "by cc by cc", None, "", "all rights", "reserved all rights", "CC É by", "cc by",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of that software", "word " * 3000 + "general public license",
]


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(text):
    w = words(text)
    places = {t: [i for i in range(len(w)) if w[i : i + len(t.key_words)] == t.key_words] for t in op.BASE + op.MORE}
    base = [i for t in op.BASE for i in places[t]]
    shares = [
        sum(1 for j, x in enumerate(t.words) if 0 <= i + j - t.key_at < len(w) and w[i + j - t.key_at] == x) / len(t.words) for t, at in places.items() for i in at
    ]
    return (
        len(w), len(base), min(base, default=None), max(base, default=None), ",".join(sorted({t.label for t in op.BASE if places[t]})),
        ",".join(sorted({t.label for t, at in places.items() if at})), max(shares, default=0.0),
    )


def test_agrees_with_looking_at_every_place(docs):
    got = op.find_licenses(docs(enumerate(TEXTS))).select("doc_id", "licenses.*").drop("places").collect()
    assert {r[0]: tuple(r)[1:] for r in got} == {i: brute(t) for i, t in enumerate(TEXTS)}


def test_labels_and_columns(spark):
    df = spark.createDataFrame([(1, TEXTS[0], "a", 1), (1, TEXTS[0], "a", 1)], "doc_id long, text string, _words string, _rare_at int")
    got = op.find_licenses(df)
    assert got.columns == [*df.columns, "licenses"] and [r.licenses.labels for r in got.collect()] == ["cc-by,cc-by-nc"] * 2
    assert op.find_licenses(df.limit(0)).count() == 0


def test_plan_has_no_python_and_no_shuffle(docs):
    plan = op.find_licenses(docs(enumerate(TEXTS)).coalesce(1))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange hash" not in plan
