import random
import re
from html import unescape

import pytest
from pyspark.sql import functions as F

from shelfwise.functions.arrays import running_depth
from shelfwise.sources import harvest as hv
from shelfwise.sources import markup as mk


def column(spark, values, expression, schema="v string"):
    rows = [(i, v) for i, v in enumerate(values)]
    return [r.out for r in spark.createDataFrame(rows, f"i long, {schema}").orderBy("i").select(expression.alias("out")).collect()]


def test_depth_is_a_running_sum_that_never_falls_below(spark):
    random.seed(4)
    steps = [[random.choice([(1, 1), (-1, 0), (0, 1), (0, 0)]) for _ in range(n)] for n in (0, 1, 2, 3, 50, 1000, 20_000)]

    def brute(row):
        depth, out = 0, []
        for add, least in row:
            depth = max(depth + add, least)
            out.append(depth)
        return out

    assert column(spark, steps, running_depth(F.col("v")), "v array<struct<add:int,least:int>>") == [brute(s) for s in steps]


def tree(html):
    """(top, own pieces with ^ for inner tables) of each table, by a plain stack over the tags."""
    tables, stack, last = [], [], {}
    for token in re.findall(r"<[^>]*>|[^<]+", html):
        name = token.lower().strip("<>").split(" ")[0]
        if name == "table":
            if stack and last.get(stack[-1]) not in ("td", "th"):
                stack.pop()
            top = tables[stack[-1]][0] if stack else max([t[0] for t in tables], default=0) + 1
            tables.append([top, ""])
            stack.append(len(tables) - 1)
        elif name == "/table":
            if stack:
                stack.pop()
                if stack:
                    tables[stack[-1]][1] += "^"
        elif stack:
            if re.fullmatch("/?t[rdh]", name):
                last[stack[-1]] = name
                token = f"|{name.replace('t', '')}="
            elif token[0] == "<":
                token = ""
            tables[stack[-1]][1] += token
    return [(top, own.split("|")[1:]) for top, own in tables]


def test_tables_and_their_own_pieces(spark):
    random.seed(6)
    tokens = ["<table>", "<TABLE class=x>", "</table>", "<tr>", "</tr>", "<td>", "<th a=1>", "</td>", "text", "<b>", "1 < 2 "]
    pages = ["", "no table", "</table></table><table><tr><td>a", "<table><table>"] + [
        "".join(random.choice(tokens) for _ in range(n)) for n in [random.randrange(1, 40) for _ in range(150)] + [900]
    ]
    got = column(spark, pages, mk.tables_of(F.col("v")))
    for page, tables in zip(pages, got):
        want = tree(page.replace("< ", "&"))
        assert [t.top for t in tables] == [t for t, _ in want], page
        assert [[p.replace("\x03", "=").replace("\x01", "^").replace("< ", "&") for p in t.own.split("\x1d")[1:]] for t in tables] == [own for _, own in want], page


def test_references_are_read_once_as_browsers_do(spark):
    texts = ["a &lt; b", "&amp;lt;", "&#163;&#xa3;&#XA3;", "&#128;&#150;&#x99;", "&xyzzy; &", "&#0;&#55296;&#1114112;", "&#128512;", "&eacute;&Delta;&hearts;", "none", ""]
    want = [unescape(t) for t in texts]
    assert column(spark, texts, mk.with_characters(F.col("v"))) == want


def test_a_page_of_very_many_tables_and_rows(spark):
    inner = "<table><tr><td>k<td>v</table>"
    pages = {
        1: "<table>" + "".join(f"<tr><td>Key {i}</td><td>{i}</td></tr>" for i in range(20_000)) + "</table>",
        2: "".join(f"<table><tr><td>Key {i}</td><td>{i}</td></tr></table>" for i in range(5_000)),
        3: "<table><tr><td>" * 60 + inner + "</td></tr><tr><td>deep</td><td>x</td></tr></table>" * 60,
        4: None,
        5: "",
    }
    df = spark.createDataFrame(list(pages.items()), "product_id long, html string").selectExpr("*", "1 as kind", "2 as key")
    rows = hv.harvest_specs(df).collect()
    by = {p: [r for r in rows if r.product_id == p] for p in pages}
    assert len(by[1]) == 20_000 and all(r.kind == "specs" and r.key == f"key_{r.value}" for r in by[1])
    assert len(by[2]) == 5_000 and sum(r.kind == "specs" for r in by[2]) == 1
    assert sorted((r.key, r.value, r.kind) for r in by[3]) == [("deep", "x", "specs"), ("k", "v", "specs")]
    assert not by[4] and not by[5]


@pytest.mark.parametrize("html,want", [
    ("a<span>b</span>c</span>d", "abc"), ("never <span>closed", "never closed"), ("</span>x", ""), ("plain", "plain"),
])
def test_until_closed(spark, html, want):
    assert column(spark, [html], mk.until_closed(F.col("v"), "span")) == [want]


def test_pages_are_read_without_python_or_shuffle(spark):
    from tests.conftest import plan_of

    df = spark.createDataFrame([(1, "<table></table>")], "product_id long, html string")
    for plan in (plan_of(hv.harvest_specs(df)), plan_of(hv.harvest_bullets(df))):
        assert "Python" not in plan and "Exchange" not in plan
