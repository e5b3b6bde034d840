"""English words as column expressions: stop words, and stems by the published suffix-stripping algorithm of 1980 (Porter)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.arrays import bind

# Words that carry no meaning of their own in English text search, as commonly published.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its itself they
them their theirs themselves what which who whom this that these those am is are was were be been being have has had having do does
did doing a an the and but if or because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where why how all any both each few
more most other some such no nor not only own same so than too very s t can will just don should now
""".split()

# Suffixes of steps 2, 3 and 4 and what takes their place.
_STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able", "alli": "al", "entli": "ent", "eli": "e",
    "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous",
    "aliti": "al", "iviti": "ive", "biliti": "ble",
}
_STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
_STEP_4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize"]

# A run of consonants and a run of vowels; y is a consonant at the start and behind a vowel. Runs never give a letter back.
_CONSONANTS, _VOWELS = "[^aeiou][^aeiouy]*+", "[aeiouy][aeiou]*+"
_START = f"^(?:{_CONSONANTS})?+"
_ONE_OR_MORE = f"{_START}{_VOWELS}{_CONSONANTS}"
_EXACTLY_ONE = f"{_START}{_VOWELS}{_CONSONANTS}(?:{_VOWELS})?+$"
_TWO_OR_MORE = f"{_START}{_VOWELS}{_CONSONANTS}{_VOWELS}{_CONSONANTS}"
_HAS_VOWEL = f"{_START}[aeiouy]"
# Ends consonant, vowel, consonant, the last not w, x or y.
_SHORT_END = "(?:^y|[aeiou]y|[^aeiouy])[aeiouy][^aeiouwxy]$"


def _without(word: Column, n: int) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - n)


def _plural(w: Column) -> Column:
    return (
        F.when(~F.endswith(w, F.lit("s")), w).when(F.endswith(w, F.lit("sses")) | F.endswith(w, F.lit("ies")), _without(w, 2))
        .when(F.endswith(w, F.lit("ss")), w).otherwise(_without(w, 1))
    )


def _past_and_progressive(w: Column) -> Column:
    def mended(stem: Column) -> Column:
        return (
            F.when(stem.rlike("(?:at|bl|iz)$"), F.concat(stem, F.lit("e")))
            .when(stem.rlike(r"([^aeiouylsz])\1$"), _without(stem, 1))
            .when(stem.rlike(_EXACTLY_ONE) & stem.rlike(_SHORT_END), F.concat(stem, F.lit("e"))).otherwise(stem)
        )

    def cut(n: int) -> Column:
        return bind(_without(w, n), lambda stem: F.when(stem.rlike(_HAS_VOWEL), mended(stem)).otherwise(w))

    eed = F.when(_without(w, 3).rlike(_ONE_OR_MORE), _without(w, 1)).otherwise(w)
    return F.when(F.endswith(w, F.lit("eed")), eed).when(F.endswith(w, F.lit("ed")), cut(2)).when(F.endswith(w, F.lit("ing")), cut(3)).otherwise(w)


def _final_y(w: Column) -> Column:
    stem = _without(w, 1)
    return F.when(F.endswith(w, F.lit("y")) & stem.rlike(_HAS_VOWEL), F.concat(stem, F.lit("i"))).otherwise(w)


def _replaced(w: Column, table: dict[str, str]) -> Column:
    """The longest suffix of the table replaced where at least one syllable stands before it."""
    values = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    suffix = F.regexp_extract(w, f"^.*?({'|'.join(table)})$", 1)

    def put(s: Column) -> Column:
        stem = F.substring(w, F.lit(1), F.length(w) - F.length(s))
        return F.when((s != "") & stem.rlike(_ONE_OR_MORE), F.concat(stem, F.element_at(values, s))).otherwise(w)

    return bind(suffix, put)


def _removed(w: Column) -> Column:
    suffix = F.regexp_extract(w, f"^.*?({'|'.join(_STEP_4)})$", 1)

    def put(s: Column) -> Column:
        stem = F.substring(w, F.lit(1), F.length(w) - F.length(s))
        return F.when((s != "") & stem.rlike(_TWO_OR_MORE) & ((s != "ion") | stem.rlike("[st]$")), stem).otherwise(w)

    return bind(suffix, put)


def _final_e(w: Column) -> Column:
    stem = _without(w, 1)
    goes = stem.rlike(_TWO_OR_MORE) | (stem.rlike(_EXACTLY_ONE) & ~stem.rlike(_SHORT_END))
    return F.when(F.endswith(w, F.lit("e")) & goes, stem).otherwise(w)


def _final_ll(w: Column) -> Column:
    return F.when(F.endswith(w, F.lit("ll")) & _without(w, 1).rlike(_TWO_OR_MORE), _without(w, 1)).otherwise(w)


def stem(word: Column) -> Column:
    """Stem of a lower-case word. Words of one or two letters, and words of other than the letters a to z, stay as they are. `yy` counts as
    consonant and vowel."""
    steps = [
        _plural, _past_and_progressive, _final_y, lambda w: _replaced(w, _STEP_2), lambda w: _replaced(w, _STEP_3), _removed, _final_e, _final_ll,
    ]

    def run(w: Column) -> Column:
        stemmed = w
        for step in steps:
            stemmed = bind(stemmed, step)
        # No step changes a word of another last letter.
        plain = ~w.rlike("^[a-z]{3,}$") | ~w.rlike("[cdegilmnrstuy]$")
        return F.when(plain, w).otherwise(stemmed)

    return bind(word, run)


def stop_word(word: Column) -> Column:
    return word.isin(STOP_WORDS)
