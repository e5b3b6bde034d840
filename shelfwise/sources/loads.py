"""Loads that take effect once: Parquet folders by key bucket, and one small file a commit that says which folders count.

A load writes its folders first and is committed by one rename that fails if another commit was faster. What a load that
was cut off has written is in no commit and never read; a load that is already committed is not written again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 64
_COMMIT_DIGITS = 12


class CommitConflict(RuntimeError):
    """Another load was committed in between; run the load again."""


class LoadedTable:
    """A table of rows bucketed by a hash of `key`, at `path` in any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, key: list[str], buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self.schema = schema if isinstance(schema, T.StructType) else spark.createDataFrame([], schema).schema

    def _hadoop(self, path: str):
        jvm, context = self.spark._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        place = jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(context)

    def _latest(self) -> tuple[int, dict]:
        """Number and content of the last commit; 0 and an empty table before the first."""
        place, fs = self._hadoop(f"{self.path}/_commits")
        names = [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []
        numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:_COMMIT_DIGITS].isdigit()]
        if not numbers:
            return 0, {"loads": [], "buckets": {}}
        last = max(numbers)
        text = self.spark.read.text(f"{self.path}/_commits/{last:0{_COMMIT_DIGITS}}.json", wholetext=True).first()[0]
        return last, json.loads(text)

    def _commit(self, number: int, content: dict) -> None:
        jvm = self.spark._jvm
        draft, fs = self._hadoop(f"{self.path}/_commits/_draft-{uuid.uuid4().hex}")
        stream = fs.create(draft)
        stream.write(bytearray(json.dumps(content).encode()))
        stream.close()
        target, _ = self._hadoop(f"{self.path}/_commits/{number:0{_COMMIT_DIGITS}}.json")
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            files.rename(fs.makeQualified(draft), fs.makeQualified(target), options)
        except Exception as error:
            if fs.exists(target):
                raise CommitConflict(f"commit {number} of {self.path} is taken") from error
            raise

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame) -> tuple[str, list[int]]:
        """A new folder with the rows by bucket, and which buckets it holds."""
        folder = f"data/{uuid.uuid4().hex}"
        fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]
        rows.select(*fields, self._bucket().alias("_bucket")).write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
        place, fs = self._hadoop(f"{self.path}/{folder}")
        names = [s.getPath().getName() for s in fs.listStatus(place)]
        return folder, sorted(int(n.partition("=")[2]) for n in names if n.startswith("_bucket="))

    def _read(self, content: dict, only: list[int] | None = None) -> DataFrame:
        paths = [
            f"{self.path}/{folder}/_bucket={bucket}" for bucket, folders in content["buckets"].items() if only is None or int(bucket) in only for folder in folders
        ]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self) -> DataFrame:
        """The rows of all committed loads."""
        return self._read(self._latest()[1])

    def near(self, rows: DataFrame) -> DataFrame:
        """Stored rows of the buckets that the rows' keys fall into, all rows of these keys among them."""
        return self._read(self._latest()[1], self._touched(rows))

    def _touched(self, rows: DataFrame) -> list[int]:
        return sorted(r[0] for r in rows.select(self._bucket()).distinct().collect())

    def loads(self) -> list[str]:
        return self._latest()[1]["loads"]

    def append(self, rows: DataFrame, load_id: str) -> bool:
        """Add the rows, once for each load id; False if that load was committed before."""
        number, content = self._latest()
        if load_id in content["loads"]:
            return False
        folder, held = self._write(rows)
        buckets = {**content["buckets"], **{str(b): [*content["buckets"].get(str(b), []), folder] for b in held}}
        self._commit(number + 1, {"loads": [*content["loads"], load_id], "buckets": buckets})
        return True

    def upsert(self, rows: DataFrame, load_id: str, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> bool:
        """Replace the buckets that the rows' keys fall into by `merge(old rows of those buckets, rows)`; all other buckets
        are neither read nor written. False if that load was committed before."""
        number, content = self._latest()
        if load_id in content["loads"]:
            return False
        touched = self._touched(rows)
        folder, held = self._write(merge(self._read(content, touched), rows))
        if not set(held) <= set(touched):
            raise ValueError("a merge must keep its rows' keys")
        kept = {b: folders for b, folders in content["buckets"].items() if int(b) not in touched}
        self._commit(number + 1, {"loads": [*content["loads"], load_id], "buckets": {**kept, **{str(b): [folder] for b in held}}})
        return True
