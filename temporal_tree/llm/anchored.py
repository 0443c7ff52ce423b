"""Repeated windows of a corpus, found with one narrow shuffle and one of the repeated text only.

A window is `size` consecutive units (bytes or words) of one document. Its anchor is the least hash
of the `k`-unit strings inside it, a function of the window's content alone: equal windows have equal
anchors. So a window can be repeated only if its anchor occurs elsewhere, and grouping text by anchor
brings all equal windows together.

1. Each document emits its distinct anchors, about two per `size - k` units, as numbers.
2. Anchors that occur twice are live; they are counted with map-side combining.
3. Documents are read again with the list of their live anchors. Neighbouring windows with the same
   anchor form a segment, which is sent to the shard of its anchor. Equal segments are sent
   once by a task, as far as its memory allows: a passage in a third of all documents costs a row per
   some megabytes of text, not per document.
4. A shard takes its anchors in order, in groups of some megabytes, and decides which windows are
   repeated; the method is the caller's.

An anchor with over `hot` documents would still bring all its different surroundings to one shard. Its
windows go another way, one by one: 128-bit hashes, each sent once by a task as segments are, are
grouped by one exchange for their earliest place, so that no task ever gets what such an anchor has gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from temporal_tree.llm.batches import Words, anchors, byte_hashes, grams, mix, text_bytes
from temporal_tree.llm.documents import partitions, tables
from temporal_tree.sources.scratch import Scratch

_SEGMENTS = "key long, doc_id long, starts array<int>, ends array<int>, content binary"
_SEGMENT_ROWS = pa.schema(
    [
        ("key", pa.int64()),
        ("doc_id", pa.int64()),
        ("starts", pa.list_(pa.int32())),
        ("ends", pa.list_(pa.int32())),
        ("content", pa.binary()),
    ]
)
_SPANS = "doc_id long, starts array<int>, ends array<int>"
_SPAN_ROWS = pa.schema(_SEGMENT_ROWS.field(n) for n in ("doc_id", "starts", "ends"))
# live anchors per shard, which is sorted on disk if need be
_ANCHORS_PER_SHARD = 40_000
# segments that are compared with each other at once
_GROUP_BYTES = 1 << 20
# most bytes of text that are handled at once; where equal segments are sent once, some more
_SLICE_BYTES = 1 << 20
# most bytes of different segments that wait for equal ones
_SEGMENT_BYTES = 8 << 20

# documents, starts of segments and their contents in order -> (row, start, end) of repeated text,
# counted in units from the segment's start
Decide = Callable[[np.ndarray, list, list[bytes]], Iterator[tuple[int, int, int]]]


@dataclass(frozen=True)
class Windows:
    """What a window is. `same_document`: whether an earlier place in the same document counts."""

    unit: str  # "byte" or "word"
    size: int
    k: int
    same_document: bool
    hot: int = 10_000

    def flat(self, raw: np.ndarray, bounds: np.ndarray) -> Flat:
        return (_Bytes if self.unit == "byte" else _WordList)(raw, bounds, self)


class Flat:
    """A batch of documents as one sequence of units."""

    first: np.ndarray  # per row the index of its first unit; the total at the end
    values: np.ndarray  # hashes of k units from each unit on

    def __init__(self, windows: Windows):
        w, first = windows, self.first
        chosen = anchors(self.values, w.size - w.k + 1)
        row = np.repeat(np.arange(len(first) - 1, dtype=np.int32), np.diff(first))
        inside = row[: len(chosen)] == row[w.size - 1 :][: len(chosen)] if len(chosen) else np.zeros(0, bool)
        at = np.flatnonzero(inside).astype(np.int32)
        chosen, row = chosen[at], row[at]
        # a run: neighbouring windows of one document with one anchor
        head = np.ones(len(at), bool)
        if len(at):
            head[1:] = (chosen[1:] != chosen[:-1]) | (row[1:] != row[:-1])
        heads = np.flatnonzero(head)
        self.run_start = at[heads]
        self.run_windows = np.diff(np.append(heads, len(at)))
        self.run_row = row[heads]
        self.run_place = chosen[heads]
        self.run_anchor = (self.values[self.run_place] >> np.uint64(16)).astype(np.int64)

    def content(self, start: int, end: int) -> bytes:
        raise NotImplementedError


class _Bytes(Flat):
    def __init__(self, raw: np.ndarray, bounds: np.ndarray, windows: Windows):
        self.first, self.values, self._data = bounds, byte_hashes(raw, windows.k), raw.tobytes()
        super().__init__(windows)

    def content(self, start: int, end: int) -> bytes:
        return self._data[start:end]


class _WordList(Flat):
    def __init__(self, raw: np.ndarray, bounds: np.ndarray, windows: Windows):
        words = Words(raw, bounds)
        self.first, self.values = words.first, grams(words.hashes(), windows.k)
        self._start, self._end, self._data = words.start, words.end, raw.tobytes()
        super().__init__(windows)

    def content(self, start: int, end: int) -> bytes:
        """The words joined by one space, so that other white space does not matter."""
        return b" ".join(self._data[self._start[start] : self._end[end - 1]].split())


def slices(batch: pa.RecordBatch, most: int = _SLICE_BYTES, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch in parts of a bounded number of text bytes, or of one document."""
    sizes = pc.binary_length(batch.column(column).cast(pa.large_string())).fill_null(0)
    total = np.cumsum(sizes.to_numpy(zero_copy_only=False))
    at = 0
    while at < len(batch):
        base = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, base + most, side="right")))
        yield batch.slice(at, end - at)
        at = end


def _anchor_rows(windows: Windows):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                flat = windows.flat(*text_bytes(batch.column("text")))
                order = np.lexsort((flat.run_anchor, flat.run_row))
                row, anchor = flat.run_row[order], flat.run_anchor[order]
                head = np.ones(len(row), bool)
                head[1:] = (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1])
                heads = np.flatnonzero(head)
                many = np.diff(np.append(heads, len(row))) > 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor[heads]),
                        pa.array(batch.column("doc_id").to_numpy(zero_copy_only=False)[row[heads]]),
                        pa.array(many & windows.same_document),
                    ],
                    ["anchor", "doc_id", "twice"],
                )

    return emit


def live_anchors(texts: DataFrame, windows: Windows, scratch: Scratch) -> tuple[DataFrame, int, int]:
    """Per document with any the anchors that occur elsewhere (times two, plus one if hot), and how
    many there are, and how many of them are hot."""
    own = tables(texts.sparkSession)
    found = own.save(
        texts.mapInArrow(_anchor_rows(windows), "anchor long, doc_id long, twice boolean"), "anchors"
    )
    live = (
        found.groupBy("anchor")
        .agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("doc_id").alias("n"), F.max("twice").alias("twice"))
        .where("lo < hi or twice")
        .select("anchor", (F.col("anchor") * 2 + (F.col("n") > windows.hot).cast("long")).alias("mark"))
    )
    marks, measured = scratch.save_measured(
        found.join(live, "anchor").groupBy("doc_id").agg(F.collect_list("mark").alias("marks")),
        "live",
        total=F.sum(F.size("marks")),
        hot=F.sum(F.size(F.filter("marks", lambda mark: mark % 2 != 0))),
    )
    own.drop()
    return marks, measured["total"] or 0, measured["hot"] or 0


class _Sent:
    """Pieces of text to send, equal ones once, from their earliest place; all others are repeated."""

    def __init__(self, windows: Windows):
        self._windows = windows
        self._first: dict[bytes, list] = {}  # content -> key, document, starts, length
        self._again: dict[int, tuple[list, list]] = {}  # document -> starts, ends
        self._bytes = 0

    def put(self, key: int, doc: int, content: bytes, start: int, length: int) -> None:
        seen = self._first.get(content)
        if seen is None:
            self._first[content] = [key, doc, [start], length]
            self._bytes += len(content) + 200
        elif seen[1] == doc and not self._windows.same_document:
            seen[2].append(start)
        elif (doc, start) < (seen[1], seen[2][0]):
            self._repeated(seen[1], seen[2], length)
            seen[1], seen[2] = doc, [start]
        else:
            self._repeated(doc, [start], length)

    def _repeated(self, doc: int, starts: list[int], length: int) -> None:
        spans = self._again.setdefault(doc, ([], []))
        spans[0].extend(starts)
        spans[1].extend(start + length for start in starts)
        self._bytes += 20 * len(starts)

    @property
    def full(self) -> bool:
        return self._bytes > _SEGMENT_BYTES

    def rows(self) -> Iterator[pa.RecordBatch]:
        first, again = self._first, self._again
        ids = np.array(list(again), np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([x[0] for x in first.values()], pa.int64()),
                pa.array([x[1] for x in first.values()], pa.int64()),
                pa.array([x[2] for x in first.values()], pa.list_(pa.int32())),
                pa.nulls(len(first), pa.list_(pa.int32())),
                pa.array(first.keys(), pa.binary()),
            ],
            schema=_SEGMENT_ROWS,
        )
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(mix(ids.astype(np.uint64)).astype(np.int64), pa.int64()),
                pa.array(ids, pa.int64()),
                pa.array([x[0] for x in again.values()], pa.list_(pa.int32())),
                pa.array([x[1] for x in again.values()], pa.list_(pa.int32())),
                pa.nulls(len(again), pa.binary()),
            ],
            schema=_SEGMENT_ROWS,
        )
        self.__init__(self._windows)


def _live_rows(windows: Windows, hot: bool):
    """Segments of live anchors that are not hot, or the single windows of those that are."""
    size = windows.size

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = _Sent(windows)
        for whole in batches:
            for batch in slices(whole):
                collect(batch, sent)
                if sent.full:
                    yield from sent.rows()
        yield from sent.rows()

    def collect(batch: pa.RecordBatch, sent: _Sent) -> None:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        marks = np.unique(batch.column("marks").flatten().to_numpy(zero_copy_only=False))
        live = marks[(marks & 1) == hot] >> 1
        if not len(live):
            return
        flat = windows.flat(*text_bytes(batch.column("text")))
        spot = np.searchsorted(live, flat.run_anchor)
        spot[spot == len(live)] = 0
        chosen = np.flatnonzero(live[spot] == flat.run_anchor)
        runs = zip(
            flat.run_row[chosen].tolist(), flat.run_start[chosen].tolist(), flat.run_windows[chosen].tolist(),
            flat.run_anchor[chosen].tolist(), strict=True,
        )
        for row, start, n, anchor in runs:
            doc, at = int(ids[row]), start - int(flat.first[row])
            if not hot:
                sent.put(anchor, doc, flat.content(start, start + n - 1 + size), at, n - 1 + size)
                continue
            for i in range(n):
                digest = hashlib.blake2b(flat.content(start + i, start + i + size), digest_size=16).digest()
                sent.put(0, doc, digest, at + i, size)

    return emit


def _hot_spans(texts: DataFrame, marks: DataFrame, windows: Windows) -> DataFrame:
    """Repeated windows of hot anchors: all but the earliest place of each."""
    hot = marks.where(F.exists("marks", lambda mark: mark % 2 != 0))
    found = texts.join(hot, "doc_id").select("doc_id", "text", "marks").mapInArrow(_live_rows(windows, hot=True), _SEGMENTS)
    # what a task has found to be repeated itself has ends and no content; it is spread by its document
    group = F.coalesce("content", F.col("doc_id").cast("string").cast("binary"))
    place = F.when(F.col("ends").isNull(), F.struct("doc_id", F.col("starts")[0].alias("start")))
    first = F.min(place).over(Window.partitionBy("group"))
    later = place > F.col("first") if windows.same_document else F.col("doc_id") > F.col("first.doc_id")
    ends = F.transform("starts", lambda start: start + windows.size)
    return (
        found.select("doc_id", "starts", "ends", group.alias("group"))
        .withColumn("first", first)
        .where(F.col("ends").isNotNull() | later)
        .select("doc_id", "starts", F.coalesce("ends", ends).alias("ends"))
    )


def _shard_rows(decide: Decide):
    """Rows of a shard come by key. Keys are settled in groups of `_GROUP_BYTES`, or one by one if they are larger."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            known = pc.is_null(batch.column("content"))
            yield batch.filter(known).select(["doc_id", "starts", "ends"])
            batch = batch.filter(pc.invert(known))
            if not len(batch):
                continue
            waiting.append(batch)
            size += batch.nbytes
            if size > _GROUP_BYTES and waiting[0]["key"][0] != batch["key"][-1]:
                table = pa.Table.from_batches(waiting)
                edge = int(np.searchsorted(table["key"].to_numpy(), batch["key"][-1].as_py()))
                yield from settled(table.slice(0, edge))
                waiting = table.slice(edge).to_batches()
                size = sum(b.nbytes for b in waiting)
        if waiting:
            yield from settled(pa.Table.from_batches(waiting))

    def settled(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.sort_by("doc_id")
        docs = table["doc_id"].to_numpy()
        starts = table["starts"].to_pylist()
        found: dict[int, tuple[list, list]] = {}
        for row, start, end in decide(docs, starts, table["content"].to_pylist()):
            spans = found.setdefault(int(docs[row]), ([], []))
            for at in starts[row]:
                spans[0].append(at + start)
                spans[1].append(at + end)
        out = pa.table(
            {"doc_id": list(found), "starts": [s for s, _ in found.values()], "ends": [e for _, e in found.values()]},
            schema=_SPAN_ROWS,
        )
        yield from out.to_batches(max_chunksize=10_000)

    return run


def live_segments(texts: DataFrame, marks: DataFrame, windows: Windows) -> DataFrame:
    """Segments of the live anchors that are not hot, by `key`, their anchor; and what a batch repeats itself."""
    return texts.join(marks, "doc_id").select("doc_id", "text", "marks").mapInArrow(_live_rows(windows, hot=False), _SEGMENTS)


def repeated_spans(texts: DataFrame, windows: Windows, decide: Decide, scratch: Scratch) -> DataFrame:
    """`doc_id`, `spans` (array of start, end in units; they may overlap) of the repeated text, for
    documents that have any. `texts` is exchanged by `doc_id`; joins that follow can use that."""
    marks, total, hot = live_anchors(texts, windows, scratch)
    shards = max(partitions(texts.sparkSession), -(-total // _ANCHORS_PER_SHARD))
    segments = live_segments(texts, marks, windows).repartition(shards, "key").sortWithinPartitions("key")
    spans = segments.mapInArrow(_shard_rows(decide), _SPANS)
    if hot:
        spans = spans.unionByName(_hot_spans(texts, marks, windows))
    return (
        spans.select("doc_id", F.arrays_zip("starts", "ends").alias("spans"))
        .groupBy("doc_id")
        .agg(F.flatten(F.collect_list("spans")).alias("spans"))
    )


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of the spans, in order; touching ones are one."""
    out: list[list[int]] = []
    for start, end in sorted((s["starts"], s["ends"]) for s in spans or ()):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(s, e) for s, e in out]
