"""Shards by a hierarchical weighted hash tree: region, rack and shard are drawn one after the other, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import fresh, stored

SHARDS = 16
RACKS_A_REGION, SHARDS_A_RACK = 2, 4
# Hexadecimal digits of a name's MD5 that make a draw: 52 bits, which a double holds.
DRAW_DIGITS, DRAW_BITS = 13, 52
# Rows numbered in one task, about; a shard has as many ranges as it needs.
ROWS_A_RANGE = 20_000
# Slots that one row of equal documents is given at once.
SLOTS_A_BLOCK = 4_096


class Leaf(NamedTuple):
    """A shard, the subtree it hangs in and its weight; a shard of weight 0 takes nothing."""

    region: str
    rack: str
    shard: int
    weight: float = 1.0


def topology(shards: int = SHARDS, founded: int = SHARDS) -> list[Leaf]:
    """Equal shards in racks of four and regions of two racks.

    Shards beyond the `founded` ones each hang below the root as a region of their own: no other subtree's weight changes
    when one is added, so rows move into it and nowhere else.
    """
    def place(i: int) -> Leaf:
        if i >= founded:
            return Leaf(f"added{i}", "rack0", i)
        rack = i // SHARDS_A_RACK
        return Leaf(f"region{rack // RACKS_A_REGION}", f"rack{rack % RACKS_A_REGION}", i)

    return [place(i) for i in range(shards)]


Node = tuple[str, int, float]


def tree_levels(leaves: Iterable[Leaf]) -> list[list[list[Node]]]:
    """For each level the children of every node of the level above, as (path, number, weight).

    An inner node weighs what its shards weigh; its number is its place in the next level. Order and numbers do not
    matter for the draws, paths and weights do.
    """
    weighed = [leaf for leaf in leaves if leaf.weight > 0]
    names = [leaf.shard for leaf in weighed]
    if not weighed or len(set(names)) < len(names):
        raise ValueError("a topology needs a shard of positive weight, and each shard once")
    paths = [(leaf.region, f"{leaf.region}/{leaf.rack}", f"{leaf.region}/{leaf.rack}/{leaf.shard}") for leaf in weighed]
    above, levels = {"": 0}, []
    for depth in range(3):
        parent_of = {p[depth]: p[depth - 1] if depth else "" for p in paths}
        weight = {name: sum(leaf.weight for leaf, p in zip(weighed, paths) if p[depth] == name) for name in parent_of}
        number = dict(zip(parent_of, names if depth == 2 else range(len(parent_of))))
        levels.append([[(n, number[n], weight[n]) for n, parent in parent_of.items() if parent == p] for p in above])
        above = number
    return levels


def _drawn(key: Column, children: Column) -> Column:
    """Number of the child with the smallest -ln(u) / weight, u being a hash of key and path between 0 and 1.

    A child's draw depends on nothing but the key, its path and its weight: where one weight grows, keys move into that
    child only, where it falls, out of it only.
    """
    def score(child: Column) -> Column:
        digits = F.substring(F.md5(F.concat(key, F.lit("|"), child["path"]).cast("binary")), 1, DRAW_DIGITS)
        u = (F.conv(digits, 16, 10).cast("long") + 0.5) / float(1 << DRAW_BITS)
        return F.struct((-F.log(u) / child["weight"]).alias("score"), child["number"].alias("number"))

    return F.array_min(F.transform(children, score))["number"]


def _children(groups: list[list[Node]]) -> Column:
    def node(path: str, number: int, weight: float) -> Column:
        return F.struct(F.lit(path).alias("path"), F.lit(number).alias("number"), F.lit(float(weight)).alias("weight"))

    return F.array(*[F.array(*[node(*child) for child in group]) for group in groups])


def shard_of(key: Column, leaves: Iterable[Leaf]) -> Column:
    """Shard of a key: one draw among the regions, one among the region's racks, one among the rack's shards.

    The key's decimal text decides; a null key counts as the empty text, so all rows without a key share a shard.
    """
    text = F.coalesce(key.cast("string"), F.lit(""))
    regions, racks, shards = tree_levels(leaves)
    # One-element arrays bind what a level drew, so that it is drawn once.
    bound = F.transform(
        F.array(text),
        lambda k: F.transform(
            F.transform(F.array(_drawn(k, _children(regions)[0])), lambda r: _drawn(k, F.get(_children(racks), r))),
            lambda r: _drawn(k, F.get(_children(shards), r)),
        )[0],
    )
    return bound[0].cast("int")


def number_slots(rows: DataFrame, shard: str, order: list[str]) -> DataFrame:
    """Rows with `slot`: their place in their shard, gapless from 0, in the order of a hash of `order` and then of `order`.

    Equal rows are counted before they are shuffled. A shard's hash range is cut into as many ranges as its rows need;
    ranges are numbered side by side, each from the number of rows in the ranges before it, so no task holds a shard.
    Equal rows get neighbouring slots, in blocks that many tasks write. The rows are written to the shared folder once, as they are read twice.
    """
    columns = rows.columns
    n, draw, part, start, slot = fresh(rows, "_n", "_draw", "_part", "_start", "slot")
    counted = stored(rows.groupBy(*columns).agg(F.count("*").alias(n)), "slots")
    total = counted.agg(F.sum(n)).first()[0] or 0
    shards = counted.select(shard).distinct().count() or 1
    parts = total // shards // ROWS_A_RANGE + 1
    name = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in order]).cast("binary")
    hashed = counted.withColumn(draw, F.conv(F.substring(F.md5(name), 1, DRAW_DIGITS), 16, 10).cast("long"))
    ranged = hashed.withColumn(part, F.floor(F.col(draw) * float(parts) / float(1 << DRAW_BITS)).cast("long"))
    before = Window.partitionBy(shard).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy(shard, part).agg(F.sum(n).alias(start)).withColumn(start, F.coalesce(F.sum(start).over(before), F.lit(0)))
    inside = Window.partitionBy(shard, part).orderBy(draw, *order).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.join(starts, [shard, part]).withColumn(start, F.col(start) + F.coalesce(F.sum(n).over(inside), F.lit(0)))
    # Very many equal rows become blocks, and blocks are dealt anew, before there is a row for each slot.
    last = F.col(start) + F.col(n) - 1
    blocks = placed.select(*columns, last.alias(n), F.explode(F.sequence(F.col(start), last, F.lit(SLOTS_A_BLOCK).cast("long"))).alias(start))
    dealt = blocks.repartition(shard, start)
    return dealt.select(*columns, F.explode(F.sequence(F.col(start), F.least(n, F.col(start) + SLOTS_A_BLOCK - 1))).alias(slot))


def assign_shards(docs: DataFrame, leaves: Iterable[Leaf] | None = None, doc_id: str = "doc_id", into: str = "shard") -> DataFrame:
    """The documents, all their columns kept, with the shard that the tree gives each; inside the row, without a shuffle."""
    return docs.withColumn(into, shard_of(F.col(doc_id), topology() if leaves is None else leaves))


def shard_table(docs: DataFrame, shards: int = SHARDS, founded: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is `key`: the document's id and the number of shards decide, and with one shard more (`grown_shard`) rows
    move into the new shard only. `founded` is the number of shards that the tree had at first (never more than `shards`):
    leave it as it is when shards are added. `size` is the text's UTF-8 bytes plus 1; a null text has no bytes, an empty one neither.
    Slots number a shard's rows from 0 without a gap. Repeated rows have a slot each; rows without an id are one key
    and share a shard; an empty table gives an empty result. Texts are not shuffled, however long; other columns of the input are
    not read.
    """
    key, body, founded = F.col(doc_id), F.coalesce(F.col(text), F.lit("")), min(founded, shards)
    rows = docs.select(
        key.alias("doc_id"), (F.octet_length(body).cast("long") + 1).alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"),
        shard_of(key, topology(shards, founded)).alias("shard"), shard_of(key, topology(shards + 1, founded)).alias("grown_shard"),
    )
    placed = number_slots(rows, "shard", ["doc_id", "size", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def write_shards(docs: DataFrame, path: str, leaves: Iterable[Leaf] | None = None, files: int = 8, doc_id: str = "doc_id") -> None:
    """The documents as Parquet, a folder `shard=N` for each shard with about `files` files; a shard is dealt over as many tasks.

    Rows are dealt by a hash of all their columns, so that a key with very many rows is not one task. A column named
    `shard` is kept as `_shard`.
    """
    own = next((c for c in docs.columns if c.lower() == "shard"), None)
    docs = docs.withColumnRenamed(own, fresh(docs, "_shard")[0]) if own else docs
    salt, = fresh(docs, "_salt")
    salted = assign_shards(docs, leaves, doc_id).withColumn(salt, F.pmod(F.xxhash64(*docs.columns), F.lit(files)))
    salted.repartition("shard", salt).drop(salt).write.partitionBy("shard").parquet(path)
