"""Intermediate tables in the shared folder the cluster names in `spark.checkpoint.dir`.

A written table cuts lineage for good: losing executors, or all of them, costs no recomputation
beyond the job that is running. Unlike an RDD checkpoint it is computed once, is columnar, and
keeps pushdown and column pruning for whoever reads it.
"""

from __future__ import annotations

import atexit
import itertools
import shutil
import tempfile
import threading
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_local_root: str | None = None
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BROADCAST = "spark.sql.autoBroadcastJoinThreshold"


def scratch_root(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, or the one set on the context; for a local master without
    either a temporary one, which goes with the driver."""
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    master = spark.conf.get("spark.master", "")
    if hasattr(spark, "sparkContext"):
        on_context = spark.sparkContext.getCheckpointDir()
        if on_context:
            return on_context
    # local-cluster has executors of its own
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder that the driver and all executors share"
        )
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="temporal-tree-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


_settings_lock = threading.Lock()
_settings_held: dict[tuple[int, str], list] = {}


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """Sets a session setting for what runs inside. Threads may hold the same one at once: the last to leave
    puts back what was there before the first."""
    key = (id(spark), name)
    with _settings_lock:
        held = _settings_held.setdefault(key, [0, spark.conf.get(name, None)])
        held[0] += 1
        spark.conf.set(name, value)
    try:
        yield
    finally:
        with _settings_lock:
            held[0] -= 1
            if not held[0]:
                del _settings_held[key]
                if held[1] is None:
                    spark.conf.unset(name)
                else:
                    spark.conf.set(name, held[1])


class Scratch:
    """A folder of tables that belong to one run.

    With `broadcast_bytes`, tables are made without broadcasts of more bytes than that, unless by hint. Spark goes by the
    size of files, in which these tables take a tenth of what they take in the driver, and a loop that
    reads a table in every round sends it there in every round.
    """

    def __init__(
        self, spark: SparkSession, root: str | None = None, *, broadcast_bytes: int | None = None
    ):
        self.spark = spark
        self._broadcast_bytes = broadcast_bytes
        self.path = f"{(root or scratch_root(spark)).rstrip('/')}/run-{uuid.uuid4().hex}"
        self._serial = itertools.count(1)

    def new_path(self, name: str) -> str:
        return f"{self.path}/{next(self._serial):03d}-{name}"

    @contextmanager
    def broadcasts_bounded(self):
        """For jobs inside that write no table here."""
        if self._broadcast_bytes is None or not self._lowers():
            yield
        else:
            with setting(self.spark, _BROADCAST, str(self._broadcast_bytes)):
                yield

    def _lowers(self) -> bool:
        # the session may allow less itself; its value is text, with or without a unit, and negative for none
        allowed = self.spark.conf.get(_BROADCAST)
        if allowed.startswith("-"):
            return False
        as_bytes = self.spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
        return as_bytes(allowed) > self._broadcast_bytes

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write `df` once and return a scan of what was written."""
        return self._save_to(self.new_path(name), df)

    def _save_to(self, path: str, df: DataFrame) -> DataFrame:
        # Spark deletes the shuffle files of the query when it has ended: what it wrote is read from then on
        with setting(self.spark, _CLEANUP, "true"), self.broadcasts_bounded():
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def save_measured(
        self, df: DataFrame, name: str, **measures: Column
    ) -> tuple[DataFrame, dict[str, int]]:
        """`save`, with aggregates taken during the write instead of by a further job."""
        seen = Observation(name)
        columns = [column.alias(key) for key, column in measures.items()]
        table = self.save(df.observe(seen, *columns), name)
        return table, seen.get

    def stage(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """`save` for a table that a run has once, under its own name, so that a later run may take it over."""
        return self.save(build(), name)

    def stage_measured(
        self, name: str, build: Callable[[], DataFrame], **measures: Column
    ) -> tuple[DataFrame, dict[str, int]]:
        return self.save_measured(build(), name, **measures)

    def drop(self) -> None:
        """Delete this run's tables; DataFrames that read them stop working."""
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(self.path)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        target.getFileSystem(conf).delete(target, True)
