"""Licence notices by a positional index of rare words. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import fresh

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """A notice: its words, and where in them the phrase stands that must be there word for word."""

    label: str
    text: str
    key: str

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_words(self) -> list[str]:
        return self.key.split()

    @property
    def key_at(self) -> int:
        n = len(self.key_words)
        return next(i for i in range(len(self.words)) if self.words[i : i + n] == self.key_words)


BASE = (
    Template("cc-by", "cc by", "cc by"),
    Template("gpl", "general public license", "general public license"),
    Template("reserved", "all rights reserved", "all rights reserved"),
)
MORE = (
    Template("mit", "released under the mit license", "mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    Template("apache", "licensed under the apache license version 2 0", "apache license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("mpl", "subject to the terms of the mozilla public license", "mozilla public license"),
    Template("lgpl", "gnu lesser general public license", "lesser general public license"),
    Template("agpl", "gnu affero general public license", "affero general public license"),
)


def words_column(text: str) -> Column:
    """Words of the text with only A-Z lower-cased; none for null."""
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def word_frequencies(docs: DataFrame, text: str, vocabulary: list[str]) -> dict[str, int]:
    """In how many documents each word of the templates occurs. As many rows as the templates have words."""
    present = F.array_intersect(words_column(text), F.array(*map(F.lit, vocabulary)))
    counted = docs.select(F.explode(present).alias("word")).groupBy("word").count()
    return {row["word"]: row["count"] for row in counted.collect()}


def find_licenses(docs: DataFrame, text: str = "text", base: tuple[Template, ...] = BASE, more: tuple[Template, ...] = MORE) -> DataFrame:
    """`docs` with a struct `licenses` (n_words, n_base, first_word, last_word, base_labels, labels, score, places);
    a column of that name is replaced.

    In a file only the rarest word (highest IDF over all documents) of each template's key phrase is looked up. Every
    place where it stands gives the place where the template would begin; the key phrase must then stand there word
    for word. Since a phrase needs its rarest word, no place is missed. `score` is the largest share of a template's
    words that stand at their relative places, over the places found; 0 without any. Null and empty texts have no
    words, null first and last places and empty labels. Nothing is shuffled but one count per template word.
    """
    templates = base + more
    vocabulary = sorted({w for t in templates for w in t.key_words})
    frequency = word_frequencies(docs, text, vocabulary)
    anchors = [min(range(len(t.key_words)), key=lambda i, t=t: (frequency.get(t.key_words[i], 0), t.key_words[i])) for t in templates]
    rare = sorted({t.key_words[i] for t, i in zip(templates, anchors)})
    words, at = fresh(docs, "_words", "_rare_at")
    others = [c for c in docs.columns if c != "licenses"]
    size = F.size(words)
    places_of_rare = F.when(size > 0, F.filter(F.sequence(F.lit(0), size - 1), lambda i: F.get(F.col(words), i).isin(rare))).otherwise(F.array().cast("array<int>"))
    found = docs.select(*others, *([F.col(text)] if text not in others else []), words_column(text).alias(words))
    found = found.withColumn(at, places_of_rare)

    def places(template: Template, anchor: int) -> Column:
        word, key = template.key_words[anchor], F.array(*map(F.lit, template.key_words))
        held = F.filter(F.col(at), lambda i: (F.get(F.col(words), i) == word) & (i >= anchor) & (F.slice(F.col(words), F.greatest(i - anchor + 1, F.lit(1)), len(template.key_words)) == key))
        return F.transform(held, lambda i: i - anchor)

    def share(template: Template) -> Column:
        def aligned(start: Column) -> Column:
            same = [F.coalesce((F.get(F.col(words), start + (j - template.key_at)) == w).cast("int"), F.lit(0)) for j, w in enumerate(template.words)]
            return sum(same[1:], same[0]) / F.lit(float(len(template.words)))

        return aligned

    columns = fresh(docs, *[f"_places_{i}" for i in range(len(templates))])
    found = found.select("*", *[places(t, a).alias(c) for t, a, c in zip(templates, anchors, columns)])
    n = len(base)
    starts = F.concat(*map(F.col, columns[:n]))

    def label(template: Template, column: str) -> Column:
        return F.when(F.size(column) > 0, F.lit(template.label))

    def joined(pairs) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*[label(t, c) for t, c in pairs])))), ",")

    shares = F.concat(*[F.transform(F.col(c), share(t)) for t, c in zip(templates, columns)])
    every = F.filter(
        F.array(*[F.struct(F.lit(t.label).alias("label"), F.col(c).alias("starts")) for t, c in zip(templates, columns)]), lambda x: F.size(x["starts"]) > 0
    )
    result = F.struct(
        size.cast("long").alias("n_words"),
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        joined(list(zip(base, columns[:n]))).alias("base_labels"),
        joined(list(zip(templates, columns))).alias("labels"),
        F.coalesce(F.array_max(shares), F.lit(0.0)).alias("score"),
        every.alias("places"),
    )
    return found.select(*others, result.alias("licenses"))
