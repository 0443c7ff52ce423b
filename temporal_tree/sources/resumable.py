"""Scratch tables that a later run can take over: each is entered in a manifest once it is written.

An entry is a small file with the table's path, schema and measures. It gets its name by a rename, after the
table's own commit, so that a table which was being written when the driver was lost is not seen; the next
run writes it anew under another path.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from temporal_tree.sources.scratch import Scratch


def fingerprint(tables: Iterable[DataFrame], options: object) -> str:
    """A digest of options and of the tables' columns and rows, in whatever order and files those come: counts
    and sums of two hashes of every row, one pass per table that shuffles one row per task."""
    seen: list[Any] = [repr(options)]
    for df in tables:
        # a hash leaves nulls out, so that they are told by their places
        cells = [c for name in df.columns for c in (F.col(name), F.col(name).isNull())]
        sums = [
            F.sum(F.xxhash64(F.lit(seed), *cells).cast("decimal(38,0)")).cast("string")
            for seed in (1, 2)
        ]
        seen += [df.schema.json(), *df.agg(F.count(F.lit(1)), *sums).first()]
    return hashlib.sha256(json.dumps(seen).encode()).hexdigest()[:32]


class ResumableScratch(Scratch):
    """Scratch tables below `root`, in a folder named by `digest`. Tables of stages are taken over from
    there if they are finished; all others belong to this attempt. One driver at a time may use the folder.
    `drop` deletes all of it."""

    def __init__(
        self, spark: SparkSession, root: str, digest: str, *, broadcast_bytes: int | None = None
    ):
        super().__init__(spark, f"{root.rstrip('/')}/{digest}", broadcast_bytes=broadcast_bytes)
        self.folder = f"{root.rstrip('/')}/{digest}"

    def _file_system(self, path: str):
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), target

    def _entry(self, name: str) -> Any | None:
        files, path = self._file_system(f"{self.folder}/{name}.json")
        if not files.exists(path):
            return None
        stream = files.open(path)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def _enter(self, name: str, value: Any) -> None:
        files, target = self._file_system(f"{self.folder}/{name}.json")
        _, part = self._file_system(f"{self.folder}/.{name}-{uuid.uuid4().hex}")
        stream = files.create(part)
        try:
            stream.write(bytearray(json.dumps(value).encode()))
        finally:
            stream.close()
        if not files.rename(part, target):
            raise RuntimeError(f"{target.toString()} could not be written")

    def remember(self, name: str, value: Any) -> Any:
        """The value that the first of all attempts gave."""
        known = self._entry(name)
        if known is None:
            self._enter(name, value)
            return value
        return known

    def stage(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        return self.stage_measured(name, build)[0]

    def stage_measured(
        self, name: str, build: Callable[[], DataFrame], **measures: Column
    ) -> tuple[DataFrame, dict[str, int]]:
        entry = self._entry(name)
        if entry is None:
            df, seen, path = build(), Observation(name), self.new_path(name)
            if measures:
                df = df.observe(seen, *[column.alias(key) for key, column in measures.items()])
            self._save_to(path, df)
            entry = {"path": path, "schema": df.schema.json(), "measures": seen.get if measures else {}}
            self._enter(name, entry)
        schema = StructType.fromJson(json.loads(entry["schema"]))
        return self.spark.read.schema(schema).parquet(entry["path"]), entry["measures"]

    def drop(self) -> None:
        files, folder = self._file_system(self.folder)
        files.delete(folder, True)
