"""Shards of nearly equal bytes by histogram sort, with DataFrame operations only."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from temporal_tree.llm.documents import tables, texts_of
from temporal_tree.operators.numbering import number_in_place

_KEY_BITS = 60
# key boundaries that are probed in one round, over all open splitters
_PROBES = 16_384


@dataclass(frozen=True)
class _Range:
    """Rows with lo <= column < hi; if `group` is set, of that key only."""

    lo: int
    hi: int
    group: int | None = None

    @property
    def column(self) -> str:
        return "key" if self.group is None else "doc_id"

    def holds(self) -> Column:
        inside = (F.col(self.column) >= self.lo) & (F.col(self.column) <= self.hi - 1)
        return inside if self.group is None else inside & (F.col("key") == self.group)


def _histogram(rows: DataFrame, ranges: list[_Range], width: dict[_Range, int]) -> dict[_Range, list[tuple[int, int]]]:
    """Per range the exact bytes between neighbouring probes: (first value, bytes), ascending. The
    driver gets at most `_PROBES` sums."""
    probe = F.lit(None).cast("struct<range:int,step:long>")
    for i, r in enumerate(ranges):
        # ids of both signs can be further apart than a long reaches
        step = F.expr(f"cast((cast({r.column} as decimal(20)) - {r.lo}) div {width[r]} as bigint)")
        probe = F.when(r.holds(), F.struct(F.lit(i).alias("range"), step.alias("step"))).otherwise(probe)
    counted = (
        rows.withColumn("probe", probe)
        .where("probe is not null")
        .groupBy("probe")
        .agg(F.sum("size").alias("bytes"))
        .select("probe.range", "probe.step", "bytes")
    )
    out: dict[_Range, list[tuple[int, int]]] = {r: [] for r in ranges}
    for row in counted.collect():
        r = ranges[row["range"]]
        out[r].append((r.lo + row["step"] * width[r], row["bytes"]))
    return {r: sorted(v) for r, v in out.items()}


def splitters(rows: DataFrame, shards: int, tolerance: float) -> list[tuple[int, int | None]]:
    """Boundaries between `shards` shards of `rows` (`key`, `doc_id`, `size`) in order of key and id: rows
    below (key, doc_id) lie before it, where no doc_id means all rows of the key lie after it.

    Each open splitter has a range of keys that holds its target, the byte count that should lie
    below it. A round counts the exact bytes between probes that divide all these ranges evenly, and
    keeps for each splitter the part that holds its target. It is settled when an edge of a part is
    within the tolerance. A key that alone reaches further on both sides, like that of a text with
    very many copies, is divided by doc_id in the same way.
    """
    seen = rows.agg(F.sum("size").alias("bytes"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).first()
    total = seen["bytes"] or 0
    slack = tolerance * total / shards
    open_ = {j: (_Range(0, 1 << _KEY_BITS), 0) for j in range(1, shards)} if total else {}
    settled: dict[int, tuple[int, int | None]] = {}
    while open_:
        ranges = sorted({r for r, _ in open_.values()}, key=lambda r: (r.group or -1, r.lo, r.hi))
        width = {r: max(1, -(-(r.hi - r.lo) * len(ranges) // _PROBES)) for r in ranges}
        found = _histogram(rows, ranges, width)
        for j, (r, below) in list(open_.items()):
            target = total * j / shards
            for first, size in found[r]:
                if below + size >= target:
                    break
                below += size
            last = min(first + width[r], r.hi)
            before, after = target - below, below + size - target
            edge = first if before <= after else last
            done = (edge, None) if r.group is None else (r.group, edge)
            if min(before, after) <= slack or (r.group is not None and last - first == 1):
                settled[j] = done
                del open_[j]
            elif last - first == 1:
                open_[j] = (_Range(seen["lo"], seen["hi"] + 1, group=first), below)
            else:
                open_[j] = (_Range(first, last, r.group), below)
    return sorted((settled[j] for j in settled), key=lambda s: (s[0], s[1] is not None, s[1] or 0))


def shard_by_bytes(rows: DataFrame, shards: int = 24, tolerance: float = 0.01) -> DataFrame:
    """Puts rows into `shards` shards of nearly equal bytes, in order of (`key`, `doc_id`).

    `rows` has `doc_id` (long, unique), `key` (long of 60 bits; rows with equal keys stay together
    where that keeps the balance), `size` (long) and any other columns that are to move along. Adds
    `shard` (int) and `slot` (long, gapless from 0 in each shard, in order of key and id). No shard
    boundary is further than `tolerance` of a shard from its place, or than one row. Rows move once.
    An empty table gives an empty result.
    """
    scratch = tables(rows.sparkSession)
    rows = scratch.save(rows, "rows")
    cuts = splitters(rows.select("key", "doc_id", "size"), shards, tolerance)
    beyond = [
        (F.col("key") >= key) if doc is None else (F.col("key") > key) | ((F.col("key") == key) & (F.col("doc_id") >= doc))
        for key, doc in cuts
    ]
    shard = reduce(lambda a, b: a + b, [b.cast("int") for b in beyond], F.lit(0))
    placed = rows.withColumn("shard", shard)
    order = ["shard", "key", "doc_id"]
    numbered = number_in_place(placed.repartitionByRange(*order).sortWithinPartitions(*order), "place", scratch)
    # one row per shard
    starts = scratch.save(numbered.groupBy("shard").agg(F.min("place").alias("first")), "starts")
    return (
        numbered.join(F.broadcast(starts), "shard")
        .withColumn("slot", F.col("place") - F.col("first"))
        .drop("place", "first")
    )


def document_rows(docs: DataFrame) -> DataFrame:
    """`doc_id`, `text`, `size` (UTF-8 bytes plus 8) and `key` (60 bits of the text's MD5).

    A null text counts as an empty one. Rows that repeat an id are one document and rows without an
    id are left out (see `texts_of`); other columns are ignored.
    """
    return texts_of(docs).select(
        "doc_id",
        "text",
        (F.octet_length("text") + 8).cast("long").alias("size"),
        F.conv(F.substring(F.md5(F.col("text").cast("binary")), 1, 15), 16, 10).cast("long").alias("key"),
    )
