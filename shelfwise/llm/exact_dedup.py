"""Exact duplicates by composable polynomial fingerprints."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import MaybeIn, annotate, fresh, prepare_text, stored

MODULUS = (1 << 31) - 1
BASES = (1_318_699_861, 722_104_429)
CHUNK_BYTES = 1 << 16
COPIES_PER_SALT = 256


def normalize(text: bytes) -> bytes:
    """Each run of blanks, tabs and line ends as one space."""
    if not text:
        return b""
    middle = b" ".join(text.split())
    if not middle:
        return b" "
    return b" " * text[:1].isspace() + middle + b" " * text[-1:].isspace()


@lru_cache(maxsize=8)
def _powers(base: int, modulus: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    value = 1
    for i in range(n - 1, -1, -1):
        out[i] = value
        value = value * base % modulus
    return out


def chunk_hash(chunk: bytes, base: int, modulus: int = MODULUS) -> int:
    """Polynomial of one chunk of at most `CHUNK_BYTES` bytes; the sum of products stays below 2 ** 56."""
    values = np.frombuffer(chunk, np.uint8).astype(np.uint64) + np.uint64(1)
    return int(values @ _powers(base, modulus, CHUNK_BYTES)[CHUNK_BYTES - len(chunk) :]) % modulus


def combine(left: int, right: int, right_length: int, base: int, modulus: int = MODULUS) -> int:
    """Hash of two adjoining pieces from their hashes: the left one shifted by the right one's length."""
    return (left * pow(base, right_length, modulus) + right) % modulus


def fingerprint(text: bytes, modulus: int = MODULUS) -> int:
    """Two polynomials packed into one number, put together from the hashes of the chunks."""
    first = second = 0
    for start in range(0, len(text), CHUNK_BYTES):
        chunk = text[start : start + CHUNK_BYTES]
        first = combine(first, chunk_hash(chunk, BASES[0], modulus), len(chunk), BASES[0], modulus)
        second = combine(second, chunk_hash(chunk, BASES[1], modulus), len(chunk), BASES[1], modulus)
    return first << 31 | second


def _prints(df: DataFrame, text: str, names: list[str], modulus: int, keep: list[str] | None) -> DataFrame:
    def compute(texts: list[bytes]) -> list[pa.Array]:
        flat = [normalize(x) for x in texts]
        return [
            pa.array([fingerprint(x, modulus) for x in flat], pa.int64()),
            pa.array([len(x) for x in flat], pa.int64()),
            pa.array([hashlib.sha256(x).hexdigest() for x in flat], pa.string()),
        ]

    types = [T.LongType(), T.LongType(), T.StringType()]
    return annotate(df, text, compute, dict(zip(names, types)), keep)


def _chunks(df: DataFrame, modulus: int) -> DataFrame:
    """Normalized texts as rows of at most `CHUNK_BYTES` bytes, each with the fingerprint and length of its whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where, prints, lengths, numbers, chunks = [], [], [], [], []
            for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                flat = normalize(text or b"")
                fp = fingerprint(flat, modulus)
                for k in range(0, max(len(flat), 1), CHUNK_BYTES):
                    where.append(i)
                    prints.append(fp)
                    lengths.append(len(flat))
                    numbers.append(k // CHUNK_BYTES)
                    chunks.append(flat[k : k + CHUNK_BYTES])
            rest = batch.drop_columns(["text"]).take(pa.array(where, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(prints, pa.int64()), pa.array(lengths, pa.int64()), pa.array(numbers, pa.int32()), pa.array(chunks, pa.binary())],
                names=[*rest.schema.names, "fp", "n_bytes", "chunk_no", "chunk"],
            )

    fields = {"fp": T.LongType(), "n_bytes": T.LongType(), "chunk_no": T.IntegerType(), "chunk": T.BinaryType()}
    return df.mapInArrow(run, T.StructType([f for f in df.schema if f.name != "text"] + [T.StructField(n, t) for n, t in fields.items()]))


def _chunk_rows(chunks: DataFrame) -> DataFrame:
    """Chunks of groups with the `salts` of the parts they go to: a group's first text to all of them."""
    parts = F.ceil(F.col("group_size") / COPIES_PER_SALT).cast("int")
    # One model a group, however many rows have the id of the one that stays.
    is_first = F.col("key") == F.col("keep_key")
    salts = F.when(is_first, F.sequence(F.lit(0), parts - 1)).otherwise(F.array(F.pmod(F.xxhash64("key"), parts).cast("int")))
    return chunks.select("id", "fp", "n_bytes", "chunk_no", "chunk", is_first.alias("is_first"), salts.alias("salts"))


def _differing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted chunk rows, those that differ from the first row of their chunk group. Holds one chunk at a time."""
    group, model = None, b""
    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in ("fp", "n_bytes", "chunk_no", "salt")))
        found = []
        for i, (key, chunk) in enumerate(zip(keys, batch.column("chunk").to_pylist())):
            if key != group:
                group, model = key, chunk
            elif chunk != model:
                found.append(i)
        yield batch.select(["id", "fp", "n_bytes"]).take(pa.array(found, pa.int64()))


def _false_members(texts: DataFrame, members: DataFrame, groups: DataFrame, modulus: int) -> DataFrame:
    """(id, fp, n_bytes) of members whose text is not that of the row that would stay.

    Only rows of groups with several members are read in full. They meet the group's first text chunk by chunk,
    in as many parts as the group has `COPIES_PER_SALT` rows; that text is repeated for each part. Rows are dealt to the
    parts by their `key`, so rows of one id, or without one, are no hot part.
    """
    several = groups.filter("group_size > 1")
    wanted = members.join(several.select("fp", "n_bytes"), ["fp", "n_bytes"], "left_semi")
    # Prints and chunks come from one pass: a second one behind the join would keep a second Python worker for each task.
    seen = _chunks(MaybeIn(wanted.select("id"), "id").keep(texts), modulus)
    rows = _chunk_rows(seen.join(several, ["fp", "n_bytes"])).withColumn("salt", F.explode("salts")).drop("salts")
    placed = rows.repartition("fp", "n_bytes", "chunk_no", "salt").sortWithinPartitions("fp", "n_bytes", "chunk_no", "salt", F.desc("is_first"))
    return placed.mapInArrow(_differing, T.StructType([placed.schema[c] for c in ("id", "fp", "n_bytes")])).distinct()


def group_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", modulus: int = MODULUS) -> tuple[DataFrame, DataFrame]:
    """Members (id, row, fp, n_bytes, sha, class_no) and groups (fp, n_bytes, class_no, keep_id, keep_row, group_size).

    Rows of equal fingerprint and length form a group; a comparison of the texts themselves splits those that only
    collide, `class_no` counting the splits. Null counts as the empty text. A null id sorts after all others. Of
    repeated rows with one id the first read stays.
    """
    prepare_text(docs.sparkSession)
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("key"))
    printed = _prints(texts, "text", ["fp", "n_bytes", "sha"], modulus, ["id", "key"])
    left = stored(printed.withColumn("row", F.monotonically_increasing_id()), "copies-prints")
    done_members, done_groups, class_no = [], [], 0
    while True:
        first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "row", "key")).alias("first")
        groups = stored(left.groupBy("fp", "n_bytes").agg(first, F.count("*").alias("group_size")), f"copies-groups-{class_no}")
        keep = [F.col(f"first.{c}").alias(f"keep_{c}") for c in ("id", "row", "key")]
        groups = groups.select("fp", "n_bytes", *keep, "group_size")
        false = stored(_false_members(texts, left, groups, modulus), f"copies-false-{class_no}")
        if false.isEmpty():
            done_members.append(left.withColumn("class_no", F.lit(class_no)))
            done_groups.append(groups.withColumn("class_no", F.lit(class_no)))
            break
        same = [F.col("a.id").eqNullSafe(F.col("b.id")), F.col("a.fp") == F.col("b.fp"), F.col("a.n_bytes") == F.col("b.n_bytes")]
        true = stored(left.alias("a").join(false.alias("b"), same, "left_anti"), f"copies-true-{class_no}")
        sizes = true.groupBy("fp", "n_bytes").agg(F.count("*").alias("group_size"))
        done_members.append(true.withColumn("class_no", F.lit(class_no)))
        done_groups.append(groups.drop("group_size").join(sizes, ["fp", "n_bytes"]).withColumn("class_no", F.lit(class_no)))
        left = stored(left.alias("a").join(false.alias("b"), same, "left_semi"), f"copies-left-{class_no}")
        again = false.select(F.col("id").alias("_again")).distinct()
        texts = MaybeIn(false.select("id"), "id").keep(texts).join(again, F.col("id").eqNullSafe(F.col("_again")), "left_semi")
        class_no += 1
    members, groups = done_members[0], done_groups[0]
    for more_members, more_groups in zip(done_members[1:], done_groups[1:]):
        members, groups = members.unionByName(more_members), groups.unionByName(more_groups)
    return members, groups


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", modulus: int = MODULUS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 (of the normalized text).

    An empty table gives no rows; empty and null texts are one group, and so are texts of blanks only.
    """
    members, groups = group_copies(docs, doc_id, text, modulus)
    joined = members.join(groups, ["fp", "n_bytes", "class_no"])
    return joined.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with one row of each group of equal texts, all its columns kept.

    Rows of single documents never move: a bitmap of bounded size tells them from rows of groups.
    """
    members, groups = group_copies(docs, doc_id, text)
    several = groups.filter("group_size > 1").select("fp", "n_bytes", "class_no", "keep_id", "keep_row")
    grouped = stored(members.join(several, ["fp", "n_bytes", "class_no"]), "copies-grouped")
    maybe, single = MaybeIn(grouped.select(F.col("id").alias(doc_id)), doc_id).split(docs)
    fp, n_bytes, sha, its_id, its_text, kept = fresh(docs, "_fp", "_n_bytes", "_sha", "_id", "_text", "_kept")
    maybe = _prints(maybe, text, [fp, n_bytes, sha], MODULUS, None)
    stays = F.max(F.col("row") == F.col("keep_row")).alias(kept)
    verdict = grouped.groupBy(F.col("id").alias(its_id), F.col("sha").alias(its_text)).agg(stays)
    judged = maybe.join(verdict, F.col(doc_id).eqNullSafe(F.col(its_id)) & (F.col(sha) == F.col(its_text)), "left")
    # A row that is in a group and stays may itself be repeated.
    alone = judged.filter(F.col(kept).isNull()).select(*docs.columns)
    once = judged.filter(F.col(kept)).dropDuplicates([doc_id, sha]).select(*docs.columns)
    return single.unionByName(alone).unionByName(once)
