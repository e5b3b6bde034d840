"""Structure of HTML inside one row: what is no markup, tables and whose rows they hold, character references, text.

A page is cut at the tags that matter, once; nesting is a running sum over those tags. Everything is a column expression.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.arrays import bind, running_depth
from shelfwise.functions.text import OTHER_BLANKS, plain_blanks, strip

# Begins a table, or stands where an inner table was, in the text of one level of tables.
_TABLE, _INNER = "\x02", "\x01"
# Stand before and behind the name of a tag that matters.
_CUT, _NAMED = "\x1d", "\x03"
# What the references &#128; to &#159; stand for, as they are read as Windows-1252.
_WINDOWS_1252 = "€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f\x90‘’“”•–—˜™š›œ\x9džŸ"
_REFERENCE = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,7});"


def without_unseen(html: Column) -> Column:
    """Markup without comments, scripts, styles and templates; one that is not closed goes on to the end."""
    unseen = r"(?is)<!--.*?(?:-->|\z)|<(script|style|template)\b.*?(?:</\1\s*>|\z)"

    def seen(small: Column) -> Column:
        some = F.contains(small, F.lit("<!--"))
        for name in ("script", "style", "template"):
            some = some | F.contains(small, F.lit(f"<{name}"))
        return F.when(some, F.regexp_replace(html, unseen, "")).otherwise(html)

    return bind(F.lower(html), seen)


def _decoded(reference: Column) -> Column:
    """Character of a reference without its `&` and `;`, every kind of blank as a space.

    An unknown name stays as it was, a number beyond Unicode is U+FFFD.
    """
    spaces = str.maketrans(OTHER_BLANKS, " " * len(OTHER_BLANKS))
    names = F.create_map(*[F.lit(x) for name, code in sorted(name2codepoint.items()) for x in (name, chr(code).translate(spaces))])
    digits = F.when(reference.rlike("^#[xX]"), F.conv(F.substring(reference, 3, 8), 16, 10)).otherwise(F.substring(reference, 2, 8))

    def char(code: Column) -> Column:
        valid = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code <= 0x10FFFF))
        plain = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")
        windows = F.substring(F.lit(_WINDOWS_1252), code.cast("int") - 0x7F, F.lit(1))
        return F.when(code.between(0x80, 0x9F), windows).otherwise(F.translate(plain, OTHER_BLANKS, " " * len(OTHER_BLANKS)))

    named = F.coalesce(F.element_at(names, reference), F.concat(F.lit("&"), reference, F.lit(";")))
    return F.when(reference.startswith("#"), bind(digits.cast("long"), char)).otherwise(named)


def with_characters(text: Column) -> Column:
    """Text with its character references read, each once: `&amp;lt;` is `&lt;`."""
    def behind(piece: Column) -> Column:
        """Text behind an `&`, which a reference may begin."""
        return bind(F.regexp_extract(piece, _REFERENCE, 1), lambda r: F.when(r == "", F.concat(F.lit("&"), piece)).otherwise(
            F.concat(_decoded(r), F.substring(piece, F.length(r) + 2, F.length(piece)))
        ))

    def read(pieces: Column) -> Column:
        return F.array_join(F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(behind(p))), "")

    return bind(text, lambda t: F.when(F.contains(t, F.lit("&")), bind(F.split(t, "&"), read)).otherwise(t))


def tagless(html: Column) -> Column:
    return bind(html, lambda h: F.when(F.contains(h, F.lit("<")), F.regexp_replace(h, "<[^>]*>", "")).otherwise(h))


def plain_text(html: Column) -> Column:
    """Text of a fragment: tags removed, character references read, blanks of any kind as spaces, ends trimmed."""
    return strip(with_characters(plain_blanks(tagless(html))))


def structure(html: Column) -> Column:
    """The page's text with a mark, a name and another mark for each tag of a table, row or cell.

    A name is `able`, `r`, `d`, `h` or one of these behind a slash, in the page's own case. Other tags are gone and
    references read. One pass of a pattern over the page; the rest are searches for single characters. The page must
    have gone through `plain_blanks`, which leaves no mark in it.
    """
    tag = r"(?i)<(?:(/?)t(able|[rdh])\b|[/!?a-z])[^>]*+>"
    return with_characters(F.replace(F.regexp_replace(html, tag, f"{_CUT}$1$2{_NAMED}"), F.lit(_CUT + _NAMED), F.lit("")))


def tables_of(html: Column) -> Column:
    """Tables in the order of their opening tags: array of (at, top, own).

    `at` is the table's place among all tags of tables, `top` the number, from 1, of the outermost table it stands in,
    `own` the part of its `structure` without those of inner tables, which leave a mark in their cell. A table opened
    inside a cell is an inner one; one opened elsewhere in an open table closes that, as browsers do. A closing tag
    without a table counts for nothing.
    """
    none = F.array().cast("array<struct<at:int,top:int,own:string>>")

    def name(piece: Column) -> Column:
        return F.lower(F.substring_index(piece, _NAMED, 1))

    def between(pieces: Column, places: Column, k: Column) -> Column:
        place = F.get(places, k)
        return F.slice(pieces, place + 2, F.coalesce(F.get(places, k + 1), F.size(pieces)) - place - 1)

    def side_by_side(parts: Column) -> Column:
        tables = F.transform(F.slice(parts, F.lit(2), F.size(parts)), lambda x, n: F.struct((n * 2).alias("at"), (n + 1).alias("top"), x[0].alias("own")))
        return F.when(F.size(parts) < 2, none).otherwise(tables)

    def nested(pieces: Column, names: Column, places: Column) -> Column:
        def event(place: Column, k: Column) -> Column:
            """A tag of a table: whether it opens one, the pieces behind it as one string, and what it does to the depth."""
            opens = F.get(names, place) == "able"
            inside = F.coalesce(F.get(names, place - 1).isin("d", "h", "/able"), F.lit(False))
            text = F.substring(F.get(pieces, place), F.length(F.get(names, place)) + 2, 1 << 30)
            return F.struct(
                opens.alias("opens"), F.array_join(F.concat(F.array(text), between(pieces, places, k)), _CUT).alias("part"),
                F.when(~opens, -1).when(inside, 1).otherwise(0).alias("add"), F.when(opens, 1).otherwise(0).alias("least"),
            )

        events = F.transform(places, event)
        return bind(events, lambda found: bind(running_depth(found), lambda depths: placed(found, depths)))

    def placed(found: Column, depths: Column) -> Column:
        tops = F.transform(found, lambda e, i: F.struct(F.when(e["opens"] & (F.get(depths, i) == 1), 1).otherwise(0).alias("add"), F.lit(0).alias("least")))

        def of_level(level: Column, number: Column) -> Column:
            """Tables of one depth: the pieces at that depth in one string, cut where a table begins."""
            def piece(e: Column, i: Column) -> Column:
                mark = F.when(e["opens"], _TABLE).otherwise(_INNER)
                return F.when(F.get(depths, i) == level, F.concat(mark, F.translate(e["part"], _TABLE + _INNER, ""))).otherwise("")

            owns = F.split(F.array_join(F.transform(found, piece), ""), _TABLE)
            at = F.filter(F.transform(found, lambda e, i: F.when(e["opens"] & (F.get(depths, i) == level), i)), lambda i: i.isNotNull())
            return bind(owns, lambda o: F.transform(at, lambda i, k: F.struct(i.alias("at"), F.get(number, i).alias("top"), F.get(o, k + 1).alias("own"))))

        def every(number: Column) -> Column:
            levels = F.sequence(F.lit(1), F.greatest(F.array_max(depths), F.lit(1)))
            return F.array_sort(F.flatten(F.transform(levels, lambda level: of_level(level, number))))

        return bind(running_depth(tops), every)

    def by_depth(text: Column) -> Column:
        def places(names: Column) -> Column:
            return F.filter(F.transform(names, lambda n, i: F.when(n.isin("able", "/able"), i)), lambda i: i.isNotNull())

        pieces = bind(F.split(text, _CUT), lambda p: F.slice(p, F.lit(2), F.size(p)))
        return bind(pieces, lambda p: bind(F.transform(p, name), lambda n: bind(places(n), lambda at: F.when(F.size(at) == 0, none).otherwise(nested(p, n, at)))))

    def found(text: Column) -> Column:
        # Tables one behind the other need no depths: behind each opening tag there is one closing tag.
        name = f"able{_NAMED}"
        small = F.length(F.replace(F.lower(text), F.lit(name), F.lit(""))) == F.length(F.replace(text, F.lit(name), F.lit("")))
        cut = F.transform(F.split(text, f"{_CUT}{name}"), lambda x: F.split(x, f"{_CUT}/{name}"))

        def tables(parts: Column) -> Column:
            in_turn = F.forall(F.transform(parts, lambda x, i: F.size(x) == F.when(i == 0, 1).otherwise(2)), lambda x: x) & small
            return F.when(in_turn, side_by_side(parts)).otherwise(by_depth(text))

        return bind(cut, tables)

    return bind(structure(html), found)


def two_cell_rows(own: Column) -> Column:
    """Rows of exactly two cells in a table's own `structure`: array of (r, first, second), r being the row's place among all rows.

    Text behind a closing tag belongs to no cell; closing tags may be missing. A row that holds an inner table is left out.
    """
    small = F.replace(own, F.lit(f"{_CUT}R{_NAMED}"), F.lit(f"{_CUT}r{_NAMED}"))

    def row(text: Column, r: Column) -> Column:
        cells = F.filter(F.split(text, _CUT), lambda p, i: (i > 0) & ~F.startswith(p, F.lit("/")))
        return F.struct(r.alias("r"), cells.alias("c"), F.contains(text, F.lit(_INNER)).alias("inner"))

    def two(rows: Column) -> Column:
        found = F.filter(F.transform(F.slice(rows, F.lit(2), F.size(rows)), row), lambda x: (F.size(x["c"]) == 2) & ~x["inner"])
        return F.transform(found, lambda x: F.struct(
            x["r"].alias("r"), F.substring(F.get(x["c"], 0), 3, 1 << 30).alias("first"), F.substring(F.get(x["c"], 1), 3, 1 << 30).alias("second"),
        ))

    return bind(F.split(small, f"{_CUT}r{_NAMED}"), two)


def until_closed(html: Column, tag: str) -> Column:
    """Of markup right behind an opening tag: up to that element's closing tag, without the tags of that name inside."""
    pattern = rf"(?i)<(/?){tag}\b[^>]*+>"

    def inner(slashes: Column, parts: Column) -> Column:
        state = F.aggregate(
            slashes, F.struct(F.lit(1).alias("open"), F.lit(1).alias("n")),
            lambda s, slash: F.when(s["open"] == 0, s).otherwise(
                F.struct((s["open"] + F.when(slash == "/", -1).otherwise(1)).alias("open"), (s["n"] + 1).alias("n"))
            ),
        )
        # Parts up to the tag at which the element closes, all of them if it never does.
        return F.array_join(bind(state, lambda s: F.slice(parts, F.lit(1), F.when(s["open"] == 0, s["n"] - 1).otherwise(F.size(parts)))), "")

    return bind(html, lambda h: inner(F.regexp_extract_all(h, F.lit(pattern), F.lit(1)), F.split(h, pattern)))
