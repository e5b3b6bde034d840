"""Texts against lists of patterns of any size: the first listed pattern that a text contains, or that it begins with.

No text meets a pattern it has nothing in common with. A pattern is filed under its rarest piece of up to four letters,
or as a whole where texts must begin with it; texts are looked up by their pieces, and candidates are verified.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE = 4
# Bits of the map that tells which pieces are filed; its size does not depend on the list.
MAP_BITS = 1 << 22


def _pieces(text: Column, n: Column) -> Column:
    """Distinct pieces of `n` letters."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1)))
    return F.when(F.length(text) >= n, F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, n)))).otherwise(F.array().cast("array<string>"))


def _all_pieces(text: Column, n: int) -> Column:
    """Pieces of `n` letters at every place, repeated ones too, in one walk over the text."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))


def _filed(rows: DataFrame, column: str, files: DataFrame) -> DataFrame:
    """Rows whose value may be one of `files`: a map of fixed size over hashes, sent to every task, spares the rest the shuffle."""
    slot = F.pmod(F.xxhash64(column), F.lit(MAP_BITS))
    words = files.select(slot.alias("_slot")).groupBy(F.shiftright("_slot", 6).alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(_slot & 63 as int))")).alias("_mask")
    )
    probed = rows.withColumn("_slot", slot)
    hits = probed.join(F.broadcast(words), F.shiftright("_slot", 6) == F.col("_word"))
    return hits.where("(shiftright(_mask, cast(_slot & 63 as int)) & 1L) = 1L").select(rows.columns)


def _first(candidates: DataFrame) -> DataFrame:
    return candidates.groupBy("text").agg(F.min_by(F.struct("pattern", "ord"), F.struct("ord", "pattern")).alias("_first")).select("text", "_first.*")


def _listed(patterns: DataFrame) -> DataFrame:
    """Each pattern once, at its first place; an empty or null one is none."""
    return patterns.where(F.col("pattern") != "").groupBy("pattern").agg(F.min("ord").alias("ord"))


def first_contained(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """(text, pattern, ord) of each distinct text that contains a pattern: the one of the smallest `ord`, then text.

    `texts` has `text`, `patterns` has `pattern` and `ord`; letters are compared as they are. The rarest piece of a pattern
    is found by counting the patterns' pieces in all texts, so a piece that most texts share files a pattern only
    where it has no other.
    """
    listed, distinct = _listed(patterns), texts.select("text").where("text is not null").distinct()
    pieces = listed.select("pattern", "ord", F.explode(_pieces(F.col("pattern"), F.least(F.length("pattern"), F.lit(PIECE)))).alias("piece"))
    lengths = [r[0] for r in listed.select(F.least(F.length("pattern"), F.lit(PIECE))).distinct().collect()]
    if not lengths:
        return distinct.select("text", F.lit(None).cast("string").alias("pattern"), F.lit(None).cast(patterns.schema["ord"].dataType).alias("ord")).limit(0)
    own = F.flatten(F.array(*[_all_pieces(F.col("text"), n) for n in sorted(lengths)]))
    in_texts = distinct.select("text", F.explode(own).alias("piece"))
    counts = _filed(in_texts.select("piece"), "piece", pieces).groupBy("piece").agg(F.count("*").alias("_n"))
    rated = pieces.join(counts, "piece", "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    filed = rated.groupBy("pattern", "ord").agg(F.min_by("piece", F.struct("_n", "piece")).alias("piece"))
    candidates = _filed(in_texts, "piece", filed).join(filed, "piece").where(F.contains("text", "pattern"))
    return _first(candidates)


def first_prefix(texts: DataFrame, patterns: DataFrame, whole_words: bool = False) -> DataFrame:
    """(text, pattern, ord) of each distinct text that begins with a pattern: the one of the smallest `ord`, then text.

    Texts are looked up by their beginnings of the lengths that patterns have. With `whole_words` a letter or digit must
    not follow.
    """
    listed, distinct = _listed(patterns), texts.select("text").where("text is not null").distinct()
    lengths = F.array(*[F.lit(r[0]) for r in listed.select(F.length("pattern")).distinct().orderBy(F.length("pattern")).collect()]).cast("array<int>")
    short_enough = F.filter(lengths, lambda n: n <= F.length("text"))
    beginnings = distinct.select("text", F.explode(F.transform(short_enough, lambda n: F.substring(F.col("text"), F.lit(1), n))).alias("pattern"))
    candidates = _filed(beginnings, "pattern", listed).join(listed, "pattern")
    if whole_words:
        candidates = candidates.where(~F.substring(F.col("text"), F.length("pattern") + 1, F.lit(1)).rlike("[A-Za-z0-9]"))
    return _first(candidates)
