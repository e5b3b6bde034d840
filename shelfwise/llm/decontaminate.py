"""Benchmark passages in documents, by Wu-Manber search over words."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from shelfwise.llm.common import fresh, prepare_text, words_of

WINDOW = 10
BLOCK_ITEM_BYTES = 4 << 20
FIELDS = {"n_words": T.LongType(), "n_hit": T.LongType(), "n_items": T.LongType(), "items_sha256": T.StringType(), "contaminated": T.BooleanType()}

Pattern = tuple[bytes, ...]


class WuManber:
    """Search for patterns of one length `m` over words.

    Blocks are pairs of words (single words where m is 1). `shift` says how far the search may move on from a
    block without missing a pattern; a block that is in no pattern moves it m - 1 words. Blocks that end a
    pattern lead to a bucket; in it, the pattern's first block selects the patterns that are compared in full.
    """

    def __init__(self, patterns: dict[Pattern, list[int]], m: int):
        self.m, self.width = m, min(m, 2)
        self.default = m - self.width + 1
        self.shift: dict[Pattern, int] = {}
        self.buckets: dict[Pattern, dict[Pattern, list[tuple[Pattern, list[int]]]]] = {}
        for words, items in patterns.items():
            for end in range(self.width, m + 1):
                block = words[end - self.width : end]
                self.shift[block] = min(self.shift.get(block, self.default), m - end)
            bucket = self.buckets.setdefault(words[m - self.width :], {})
            bucket.setdefault(words[: self.width], []).append((words, items))

    def find(self, words: list[bytes]) -> Iterator[tuple[int, list[int]]]:
        """(start, items) of every occurrence, by ascending start."""
        m, width, default, shift, buckets = self.m, self.width, self.default, self.shift, self.buckets
        end, n = m, len(words)
        while end <= n:
            block = tuple(words[end - width : end])
            step = shift.get(block, default)
            if step:
                end += step
                continue
            start = end - m
            for pattern, items in buckets[block].get(tuple(words[start : start + width]), ()):
                if tuple(words[start:end]) == pattern:
                    yield start, items
            end += 1


def compile_items(items: list[tuple[object, bytes]], window: int = WINDOW) -> list[WuManber]:
    """One searcher for windows of `window` words, and one for each shorter length that an item has."""
    by_length: dict[int, dict[Pattern, list]] = {}
    for item, text in items:
        words = words_of(text)
        m = min(window, len(words))
        for start in range(len(words) - m + 1 if m else 0):
            owners = by_length.setdefault(m, {}).setdefault(tuple(words[start : start + m]), [])
            if item not in owners:
                owners.append(item)
    return [WuManber(patterns, m) for m, patterns in sorted(by_length.items())]


def covered(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint spans in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


_compiled: dict[str, list[WuManber]] = {}


def _item_blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[object, bytes]]]:
    """The benchmark in blocks of bounded size, one at a time. Items without a text are left out."""
    block, size = [], 0
    rows = benchmark.select(F.col(item_id).alias("id"), F.col(text).cast("binary").alias("text")).filter("text is not null")
    for row in rows.orderBy("id", "text").toLocalIterator():
        block.append((row.id, bytes(row.text)))
        size += len(row.text) + 64
        if size >= BLOCK_ITEM_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def _search(df: DataFrame, text: str, hits: str, first: bool, items: list[tuple[object, bytes]], id_type: T.DataType, window: int) -> DataFrame:
    """`df` with the column `hits`: spans of words and the items found, added to what earlier blocks found."""
    shared, key = df.sparkSession.sparkContext.broadcast(items), uuid.uuid4().hex
    kind = T.StructType([
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))), T.StructField("items", T.ArrayType(id_type)),
    ])
    names = [c for c in df.columns if c != hits]
    arrow = pa.struct([("spans", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(to_arrow_type(id_type)))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _compiled:
            _compiled.clear()
            _compiled[key] = compile_items(shared.value, window)
        searchers = _compiled[key]
        for batch in batches:
            before = [None] * batch.num_rows if first else batch.column(hits).to_pylist()
            out = []
            for data, old in zip(batch.column(text).cast(pa.binary()).to_pylist(), before):
                words = words_of(data or b"")
                spans = [tuple(s) for s in old["spans"]] if old else []
                found = set(old["items"]) if old else set()
                for searcher in searchers:
                    for start, owners in searcher.find(words):
                        end = start + searcher.m
                        if spans and start <= spans[-1][1] and start >= spans[-1][0]:
                            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
                        else:
                            spans.append((start, end))
                        found.update(owners)
                out.append({"spans": covered(spans), "items": sorted(found, key=lambda item: (item is None, item))})
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(out, arrow)], names=[*names, hits])

    return df.select(*names, *([] if first else [hits])).mapInArrow(run, T.StructType([df.schema[c] for c in names] + [T.StructField(hits, kind)]))


def find_passages(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, hits: str = "hits",
) -> DataFrame:
    """`docs` with a column `hits`: disjoint spans of words (start, end) inside occurrences of benchmark windows, and
    the ids of the items they belong to.

    A window is `window` consecutive words of an item; an item of fewer words, but not none, is one window. The
    benchmark is the query set: it passes in blocks of bounded size, each searched in every document, so neither
    side is shuffled and no block grows with the input; the driver holds one block at a time. Ids may be of any type. Null
    and empty texts have no words and no hits; repeated items count once under their id. Items without an id are found like
    any other and are together one item of the id null.
    """
    prepare_text(docs.sparkSession)
    out, id_type = docs, benchmark.schema[item_id].dataType
    for number, block in enumerate(_item_blocks(benchmark, item_id, item_text)):
        out = _search(out, text, hits, number == 0, block, id_type, window)
    return _search(docs, text, hits, True, [], id_type, window) if out is docs else out


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One row per document: doc_id and the columns of `FIELDS`.

    An item of the id null counts in n_hit, n_items and contaminated; only items_sha256 cannot name it.
    """
    found = find_passages(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), benchmark, **how)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = batch.column("hits").to_pylist()
            n_hit = [sum(end - start for start, end in h["spans"]) for h in hits]
            digests = [hashlib.sha256(",".join(sorted(str(i) for i in h["items"] if i is not None)).encode()).hexdigest() for h in hits]
            columns = [
                batch.column("doc_id"),
                pa.array([len(words_of(x or b"")) for x in batch.column("text").cast(pa.binary()).to_pylist()], pa.int64()),
                pa.array(n_hit, pa.int64()),
                pa.array([len(h["items"]) for h in hits], pa.int64()),
                pa.array(digests, pa.string()),
                pa.array([n > 0 for n in n_hit], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *FIELDS])

    schema = T.StructType([found.schema["doc_id"]] + [T.StructField(n, t) for n, t in FIELDS.items()])
    return found.mapInArrow(run, schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **how) -> DataFrame:
    """`docs` without the documents that contain a benchmark window; all columns kept, nothing shuffled."""
    (hits,) = fresh(docs, "hits")
    found = find_passages(docs, benchmark, text, hits=hits, **how)
    return found.filter(F.size(F.col(f"{hits}.items")) == 0).select(*docs.columns)
