"""Finding the passages of long texts that read like specifications.

A document is one row, and all work on its windows happens in array functions inside that row, so
nothing is shuffled and texts never travel.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.text import strip
from shelfwise.rules import CONTENTS_LINES, DENSITY_PATTERNS, MARKETING_WORDS, PASSAGE_SEPARATOR

_SMALLEST_WINDOW = 400
_SHORT_TEXT = 5000


def matches(text: Column, pattern: str) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit("(?i)" + pattern), F.lit(0)))


def windows_of(text: Column, size: int = 1000, overlap: int = 500) -> Column:
    """Array of (start, end): overlapping windows of at least 400 characters."""
    length = F.length(text)
    starts = F.sequence(F.lit(0), F.greatest(length - 1, F.lit(0)), F.lit(size - overlap))
    spans = F.transform(starts, lambda s: F.struct(s.alias("start"), F.least(s + size, length).alias("end")))
    return F.filter(spans, lambda w: w["end"] - w["start"] >= _SMALLEST_WINDOW)


def _pieces(text: Column, size: int, overlap: int) -> Column:
    """The text cut once into pieces that all windows are made of, so that no window is searched from the beginning."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{math.gcd(size, size - overlap)}}}"), F.lit(0))


def _cut(pieces: Column, start: Column, end: Column, size: int, overlap: int) -> Column:
    """Text from `start` to `end`: the start of a window, and the end of one or of the text."""
    step = math.gcd(size, size - overlap)
    return F.array_join(F.slice(pieces, (start / step).cast("int") + 1, F.ceil((end - start) / step).cast("int")), "")


def density(text: Column) -> Column:
    """Weighted pattern hits per 1,000 characters, with the bonus and penalty factors."""
    counts = F.array(*[matches(text, regex) for _, regex, _ in DENSITY_PATTERNS])
    weights = F.array(*[F.lit(weight) for _, _, weight in DENSITY_PATTERNS])

    def score(counted: Column) -> Column:
        total = F.aggregate(F.zip_with(counted, weights, lambda c, w: c * w), F.lit(0), lambda a, x: a + x).cast("double")
        kinds = F.size(F.filter(counted, lambda c: c > 0))
        total = total * F.when(kinds >= 3, 1.5).otherwise(1.0)
        return total * F.when(F.element_at(counted, -1) > 0, 2.0).otherwise(1.0)

    # The one-element array binds the counts, so the patterns run once per window.
    bound = F.transform(F.array(counts), score)[0]
    bound = bound * F.when(matches(text, MARKETING_WORDS) > 5, 0.5).otherwise(1.0)
    return F.when(F.length(text) > 0, bound / F.length(text) * 1000).otherwise(0.0)


def make_windows(docs: DataFrame, size: int = 1000, overlap: int = 500) -> DataFrame:
    """One row per window: doc_id, start, end, text."""
    text = F.col("text")

    def cut(pieces: Column) -> Column:
        return F.transform(
            windows_of(text, size, overlap),
            lambda w: F.struct(w["start"].alias("start"), w["end"].alias("end"), _cut(pieces, w["start"], w["end"], size, overlap).alias("text")),
        )

    # The one-element array binds the pieces, so the text is cut once.
    return docs.select("doc_id", F.inline(F.transform(F.array(_pieces(text, size, overlap)), cut)[0]))


def score_windows(windows: DataFrame) -> DataFrame:
    return windows.withColumn("score", density(F.col("text")))


def _scored(text: Column, size: int = 1000, overlap: int = 500) -> Column:
    """Windows with score, best first and earlier first among equals; only positive scores."""
    def scored(pieces: Column) -> Column:
        return F.transform(
            windows_of(text, size, overlap),
            lambda w: F.struct(
                (-density(_cut(pieces, w["start"], w["end"], size, overlap))).alias("order"), w["start"].alias("start"), w["end"].alias("end")
            ),
        )

    bound = F.transform(F.array(_pieces(text, size, overlap)), scored)[0]
    return F.array_sort(F.filter(bound, lambda w: w["order"] < 0))


_PICKS = "struct<total:int,picked:array<struct<start:int,end:int>>>"


def _selected(scored: Column, budget: int) -> Column:
    """Greedy choice: add while within 1.5 budgets, stop once 1.2 budgets are gathered; by start."""

    def add(state: Column, w: Column) -> Column:
        length = w["end"] - w["start"]
        take = (state["total"] < budget * 1.2) & (state["total"] + length <= budget * 1.5)
        return F.when(
            take,
            F.struct(
                (state["total"] + length).alias("total"),
                F.concat(state["picked"], F.array(F.struct(w["start"].alias("start"), w["end"].alias("end")))).alias("picked"),
            ).cast(_PICKS),
        ).otherwise(state)

    nothing = F.array().cast("array<struct<start:int,end:int>>")
    start = F.struct(F.lit(0).alias("total"), nothing.alias("picked")).cast(_PICKS)
    return F.array_sort(F.aggregate(scored, start, add)["picked"])


_RUNS = "struct<total:int,stopped:boolean,runs:array<struct<start:int,end:int>>>"


def _stitched(selected: Column, budget: int) -> Column:
    """Runs of merged windows; stops at the first window that would exceed the budget whole."""

    def add(state: Column, w: Column) -> Column:
        length, runs = w["end"] - w["start"], state["runs"]
        last = F.try_element_at(runs, F.lit(-1))
        stop = state["stopped"] | (state["total"] + length > budget)
        joins = F.coalesce(w["start"] < last["end"], F.lit(False))
        grown = F.greatest(last["end"], w["end"])
        merged = F.struct(
            (state["total"] + F.when(joins, grown - last["end"]).otherwise(length)).alias("total"),
            F.lit(False).alias("stopped"),
            F.when(
                joins, F.concat(F.slice(runs, F.lit(1), F.size(runs) - 1), F.array(F.struct(last["start"].alias("start"), grown.alias("end"))))
            ).otherwise(F.concat(runs, F.array(F.struct(w["start"].alias("start"), w["end"].alias("end"))))).alias("runs"),
        ).cast(_RUNS)
        halted = F.struct(state["total"].alias("total"), F.lit(True).alias("stopped"), runs.alias("runs")).cast(_RUNS)
        return F.when(stop, halted).otherwise(merged)

    nothing = F.array().cast("array<struct<start:int,end:int>>")
    start = F.struct(F.lit(0).alias("total"), F.lit(False).alias("stopped"), nothing.alias("runs")).cast(_RUNS)
    return F.aggregate(selected, start, add)["runs"]


def select_windows(docs: DataFrame, budget: int, size: int = 1000, overlap: int = 500) -> DataFrame:
    """Chosen windows per document, one row each."""
    chosen = _selected(_scored(F.col("text"), size, overlap), budget)
    return docs.select("doc_id", F.inline(chosen))


def stitch_windows(docs: DataFrame, budget: int, size: int = 1000, overlap: int = 500) -> DataFrame:
    """Merged runs per document, one row each."""
    runs = _stitched(_selected(_scored(F.col("text"), size, overlap), budget), budget)
    return docs.select("doc_id", F.inline(runs))


def without_contents_lines(text: Column) -> Column:
    """Drop lines that look like a table of contents."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda line: ~strip(line).rlike("|".join(CONTENTS_LINES))), "\n")


def drop_toc_lines(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text", without_contents_lines(F.col("text")))


def select_passages(docs: DataFrame, budget: int = 50000, size: int = 1000, overlap: int = 500) -> DataFrame:
    """Adds `passage`: the whole text when short, else its densest windows within the budget."""
    text = F.col("text")
    long = (F.length(text) > _SHORT_TEXT) & (F.length(text) > budget)

    def chosen(scored: Column) -> Column:
        return F.struct((F.size(scored) > 0).alias("dense"), _stitched(_selected(scored, budget), budget).alias("runs"))

    found = F.when(long, F.transform(F.array(_scored(text, size, overlap)), chosen)[0])

    def runs(pieces: Column) -> Column:
        return F.transform(F.col("_found.runs"), lambda r: _cut(pieces, r["start"], r["end"], size, overlap))

    joined = F.array_join(F.transform(F.array(_pieces(text, size, overlap)), runs)[0], PASSAGE_SEPARATOR)
    return docs.withColumn("_found", found).withColumn(
        "passage",
        F.when(F.col("_found").isNull(), text).when(F.col("_found.dense"), without_contents_lines(joined)).otherwise(F.substring(text, 1, budget)),
    ).drop("_found")


def density_report(pairs: DataFrame, before: str, after: str) -> DataFrame:
    """Pattern hits in two text columns over all rows, per pattern and in total, with the change in percent."""
    sums = [
        F.coalesce(F.sum(matches(F.col(c), regex)), F.lit(0)).alias(f"{side}_{name}")
        for side, c in (("b", before), ("a", after)) for name, regex, _ in DENSITY_PATTERNS
    ]
    names = [name for name, _, _ in DENSITY_PATTERNS]
    row = pairs.agg(*sums)

    def total(side: str) -> Column:
        result = F.col(f"{side}_{names[0]}")
        for name in names[1:]:
            result = result + F.col(f"{side}_{name}")
        return result

    entries = [F.struct(F.lit(n).alias("pattern"), F.col(f"b_{n}").alias("before"), F.col(f"a_{n}").alias("after")) for n in names]
    entries.append(F.struct(F.lit("total").alias("pattern"), total("b").alias("before"), total("a").alias("after")))
    change = F.when(F.col("before") > 0, F.round((F.col("after") - F.col("before")) / F.col("before") * 100, 1))
    return row.select(F.inline(F.array(*entries))).withColumn("change_percent", change)
