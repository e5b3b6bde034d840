"""Array expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(c: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once however often it is used."""
    return F.transform(F.array(c), use)[0]


def running_depth(steps: Column, kind: str = "int") -> Column:
    """Depths behind each step from 0, every step (add, least) taking depth d to max(d + add, least).

    Steps are put together in blocks of about the square root of their number, as max(d + a, b) of max(d + c, e) is one
    of the same form; then each block is walked from its own start. So the work grows as n to the power 1.5, not as the square.
    """
    def after(d: Column, s: Column) -> Column:
        return F.greatest(d + s["add"], s["least"])

    def walk(start: Column, part: Column) -> Column:
        first = F.array(start.cast(kind))
        return F.slice(F.aggregate(part, first, lambda done, s: F.concat(done, F.array(after(F.element_at(done, -1), s)))), F.lit(2), F.size(part))

    def blocks(s: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(s))).cast("int")
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(s) - 1) / width).cast("int")), lambda b: F.slice(s, b * width + 1, width))

    def joined(part: Column) -> Column:
        start = F.struct(F.lit(0).cast(kind).alias("add"), F.lit(0).cast(kind).alias("least"))
        return F.aggregate(
            part, start, lambda a, s: F.struct((a["add"] + s["add"]).alias("add"), F.greatest(a["least"] + s["add"], s["least"]).alias("least"))
        )

    def walked(parts: Column) -> Column:
        starts = walk(F.lit(0), F.transform(parts, joined))
        return F.flatten(F.transform(parts, lambda part, b: walk(F.when(b == 0, 0).otherwise(F.get(starts, b - 1)), part)))

    none = F.array().cast(f"array<{kind}>")
    return bind(steps, lambda s: F.when(F.size(s) == 0, none).otherwise(bind(blocks(s), walked)))


def running_sum(numbers: Column, kind: str = "int") -> Column:
    """Sums of non-negative numbers up to each place."""
    return running_depth(F.transform(numbers, lambda n: F.struct(n.cast(kind).alias("add"), F.lit(0).cast(kind).alias("least"))), kind)


def differences(numbers: Column) -> Column:
    """Each number less the one before it, the first as it is: small numbers, which store well; `running_sum` undoes it."""
    return F.transform(numbers, lambda n, i: n - F.coalesce(F.get(numbers, i - 1), F.lit(0)))
