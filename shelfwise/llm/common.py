"""Helpers the corpus operators share: batches of texts, stored tables, bounded filters."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.session import new_shared_path, prepare

FILTER_BITS = 1 << 22
# Bytes that are no part of a word become blanks, A-Z become a-z; all bytes of non-ASCII characters stay.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the directory, with the session set up for texts of very different lengths."""
    prepare_text(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare_text(spark: SparkSession, batch_bytes: int = 4 << 20) -> None:
    """Batches to Python workers are bounded by bytes, so that long texts do not fill a worker; those that a reader
    decodes at once are of few rows, so that texts do not fill an executor's heap."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch_bytes))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", "512")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read back: lineage ends there and lost executors lose nothing."""
    path = new_shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of `df` has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def annotate(
    df: DataFrame,
    text: str,
    compute: Callable[[list[bytes]], list[pa.Array]],
    fields: dict[str, T.DataType],
    keep: Iterable[str] | None = None,
) -> DataFrame:
    """`df` with columns computed from whole texts (UTF-8 bytes; null counts as empty), batch by batch.

    `keep` names the columns that come back besides the new ones; all by default.
    """
    kept = [c for c in df.columns if keep is None or c in set(keep)]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(n, t) for n, t in fields.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or b"" for x in batch.column(text).cast(pa.binary()).to_pylist()]
            columns = [batch.column(c) for c in kept] + list(compute(texts))
            yield pa.RecordBatch.from_arrays(columns, names=kept + list(fields))

    wanted = [*dict.fromkeys([*kept, text])]
    return df.select(*wanted).mapInArrow(run, schema)


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words: runs of ASCII letters, digits and non-ASCII characters."""
    return text.translate(WORD_BYTES).split()


class MaybeIn:
    """Which rows may have a key of a set: a bitmap of fixed size over key hashes.

    Its size does not depend on the set, so it may be broadcast whatever the input. It only saves shuffling
    rows whose key is surely not in the set; a full bitmap costs time, never a row.
    """

    def __init__(self, keys: DataFrame, *columns: str, bits: int = FILTER_BITS):
        self.bits, self.columns = bits, columns
        slot = F.pmod(F.xxhash64(*columns), F.lit(bits))
        self.words = (
            keys.select(slot.alias("_slot"))
            .groupBy(F.shiftright("_slot", 6).alias("_word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(_slot & 63 as int))")).alias("_mask"))
        )

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows that may be in the set, and rows that surely are not."""
        marked, flag = self._marked(df)
        return marked.filter(F.col(flag)).drop(flag), marked.filter(~F.col(flag)).drop(flag)

    def keep(self, df: DataFrame) -> DataFrame:
        return self.split(df)[0]

    def _marked(self, df: DataFrame) -> tuple[DataFrame, str]:
        word, mask, slot, flag = fresh(df, "_bit_word", "_bit_mask", "_bit_slot", "_bit_flag")
        side = F.broadcast(self.words.select(F.col("_word").alias(word), F.col("_mask").alias(mask)))
        probed = df.withColumn(slot, F.pmod(F.xxhash64(*self.columns), F.lit(self.bits)))
        joined = probed.join(side, F.shiftright(slot, 6) == F.col(word), "left")
        hit = F.expr(f"coalesce(shiftright(`{mask}`, cast(`{slot}` & 63 as int)) & 1L, 0L) = 1L")
        return joined.withColumn(flag, hit).drop(word, mask, slot), flag


def crc_mod(column: str, n: int) -> Column:
    """Remainder of the CRC-32 of the value's decimal text; null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n
