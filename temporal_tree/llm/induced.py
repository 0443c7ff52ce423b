"""Suffix-array deduplication of bytes by external induced sorting."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from temporal_tree.llm.anchored import Windows, merged, repeated_spans
from temporal_tree.llm.documents import tables, texts_of

_OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<start:int,end:int>>, "


class BucketQueue:
    """A monotone priority queue of (suffix, common prefix) tuples, in the order of a first byte and
    then of arrival. Beyond `memory` bytes its tuples wait on disk, in a file without a name that
    ends with the task."""

    def __init__(self, memory: int):
        self._memory, self._held = memory, 0
        self._parts: list[list] = [[] for _ in range(257)]
        self._file = None

    def push(self, byte: int, suffixes: np.ndarray, common: np.ndarray) -> None:
        self._parts[byte].append((suffixes, common))
        self._held += suffixes.nbytes + common.nbytes
        if self._held > self._memory:
            self._spill()

    def _spill(self) -> None:
        if self._file is None:
            self._file = tempfile.TemporaryFile()
        self._file.seek(0, 2)
        for parts in self._parts:
            for i, part in enumerate(parts):
                if not isinstance(part[0], int):
                    place = self._file.tell()
                    self._file.write(part[0].tobytes())
                    self._file.write(part[1].tobytes())
                    parts[i] = (place, len(part[0]), part[0].dtype, part[1].dtype)
        self._held = 0

    def pop(self, byte: int) -> tuple[np.ndarray, np.ndarray] | None:
        """All tuples of a byte that have arrived since the last call, oldest first."""
        parts, self._parts[byte] = self._parts[byte], []
        if not parts:
            return None
        read = [self._read(p) for p in parts]
        return np.concatenate([a for a, _ in read]), np.concatenate([b for _, b in read])

    def _read(self, part: tuple) -> tuple[np.ndarray, np.ndarray]:
        if not isinstance(part[0], int):
            self._held -= part[0].nbytes + part[1].nbytes
            return part
        place, n, first, second = part
        self._file.seek(place)
        return (
            np.frombuffer(self._file.read(n * first.itemsize), first),
            np.frombuffer(self._file.read(n * second.itemsize), second),
        )

    def close(self) -> None:
        if self._file is not None:
            self._file.close()


def _least_between(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The minima of values[lo:hi] for many non-empty ranges, from minima over powers of two."""
    out = np.empty(len(lo), values.dtype)
    level = np.frexp((hi - lo).astype(np.float64))[1] - 1
    table = values
    for j in range(int(level.max(initial=0)) + 1):
        chosen = np.flatnonzero(level == j)
        out[chosen] = np.minimum(table[lo[chosen]], table[hi[chosen] - (1 << j)])
        if len(table) > 1 << j:
            table = np.minimum(table[: len(table) - (1 << j)], table[1 << j :])
    return out


class Induction:
    """Sorts the suffixes of `text`, with the lengths of the prefixes that neighbours share, by
    inducing all of them from those that begin with a leftmost falling byte (LMS)."""

    def __init__(self, text: np.ndarray, limit: int, memory: int):
        self.text, self.limit, self.memory = text, limit, memory
        n = len(text)
        # a suffix is of type S if it is less than the next one; the end is less than anything
        rises = np.zeros(n, bool)
        differs = np.flatnonzero(text[:-1] != text[1:])
        if n > 1 and len(differs):
            rise_at = text[differs] < text[differs + 1]
            nxt = np.searchsorted(differs, np.arange(n))
            rises[: differs[-1] + 1] = rise_at[nxt[: differs[-1] + 1]]
        self.rises = rises
        self.lms = np.flatnonzero(rises[1:] & ~rises[:-1]) + 1

    def common(self, a: int, b: int) -> int:
        """The shared prefix of two suffixes, up to the limit."""
        x, y = self.text[a : a + self.limit], self.text[b : b + self.limit]
        m = min(len(x), len(y))
        differing = np.flatnonzero(x[:m] != y[:m])
        return int(differing[0]) if len(differing) else m

    def sorted_lms(self) -> tuple[np.ndarray, np.ndarray]:
        """The LMS suffixes in order of their first `limit` bytes, and what neighbours share.

        The recursion works on names of eight bytes: suffixes with equal names are sorted by the
        names that follow, until all differ or the limit is reached.
        """
        text = np.append(self.text, np.zeros(8, np.uint8))
        # shorter suffixes come first: every byte counts one more, the end counts zero
        n = len(self.text)
        order = self.lms.copy()
        shared = np.zeros(len(order), np.int64)
        lo = np.zeros(1, np.int64)
        hi = np.array([len(order)])
        depth = 0
        while len(lo) and depth < self.limit:
            inside = np.repeat(np.arange(len(lo)), hi - lo)
            place = np.arange(len(inside)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + lo[inside]
            suffix = order[place]
            name = np.zeros(len(suffix), np.uint64)
            for k in range(8):
                at = np.minimum(suffix + depth + k, n)
                name = (name << np.uint64(8)) | text[at].astype(np.uint64)
            left = np.minimum(n - suffix - depth, 8)  # tells a zero byte from the end
            sort = np.lexsort((left, name, inside))
            suffix, name, inside, left = suffix[sort], name[sort], inside[sort], left[sort]
            order[place] = suffix
            same_group = np.zeros(len(suffix), bool)
            same_group[1:] = inside[1:] == inside[:-1]
            equal = np.zeros(len(suffix), bool)
            equal[1:] = same_group[1:] & (name[1:] == name[:-1]) & (left[1:] == left[:-1])
            parted = np.flatnonzero(same_group & ~equal)
            xor = name[parted] ^ name[parted - 1]
            bits = np.frexp(np.maximum((xor >> np.uint64(11)).astype(np.float64), 0))[1] + 11
            high = np.where(xor >> np.uint64(11) > 0, bits, np.frexp(xor.astype(np.float64))[1])
            same_bytes = np.where(xor == 0, 8, (64 - high) // 8)
            reach = np.minimum(left[parted], left[parted - 1])
            shared[place[parted]] = np.minimum(depth + np.minimum(same_bytes, reach), self.limit)
            head = np.flatnonzero(~equal)
            size = np.diff(np.append(head, len(suffix)))
            # groups whose suffixes have ended or that are single are sorted
            open_ = (size > 1) & (left[head] == 8)
            tied = place[equal & (left < 8)]
            shared[tied] = np.minimum(depth, self.limit)
            depth += 8
            lo = place[head[open_]]
            hi = lo + size[open_]
        for a, b in zip(lo.tolist(), hi.tolist(), strict=True):
            shared[a + 1 : b] = self.limit
        return order, shared

    def run(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pieces of the suffix array from its end to its start, each in descending order, with what
        each suffix shares with the greater one before it."""
        rising = BucketQueue(self.memory)
        falling = BucketQueue(self.memory)
        seeds, shared = self.sorted_lms()
        first = self.text[seeds]
        bounds = np.searchsorted(first, np.arange(257))
        # ascending: falling suffixes from the rising ones at the start of each rise
        done: list[list] = [[] for _ in range(256)]
        scan = _Scan(self, falling, falls=True)
        if len(self.text):
            scan.seed(len(self.text) - 1)
        for byte in range(256):
            while (got := falling.pop(byte)) is not None:
                done[byte].append(got)
                scan.feed(*got)
            lo, hi = bounds[byte], bounds[byte + 1]
            if lo < hi:
                part = shared[lo:hi].copy()
                part[0] = self.common(scan.last, seeds[lo]) if scan.last is not None else 0
                scan.feed(seeds[lo:hi], part)
        falling.close()
        # descending: all rising suffixes; the falling ones of a byte come after its rising ones
        scan = _Scan(self, rising, falls=False)
        for byte in range(255, -1, -1):
            while (got := rising.pop(byte)) is not None:
                scan.feed(*got)
                yield got
            if done[byte]:
                suffixes = np.concatenate([a for a, _ in done[byte]])[::-1]
                ascending = np.concatenate([b for _, b in done[byte]])
                common = np.empty_like(ascending)
                common[1:] = ascending[:0:-1]
                common[0] = self.common(scan.last, suffixes[0]) if scan.last is not None else 0
                scan.feed(suffixes, common)
                yield suffixes, common
        rising.close()


class _Scan:
    """A scan over sorted suffixes that sends each one's predecessor of the sought type to a queue."""

    def __init__(self, owner: Induction, queue: BucketQueue, falls: bool):
        self.owner, self.queue, self.falls = owner, queue, falls
        self.last: int | None = None
        # least common prefix since a byte's last arrival; a first arrival will share nothing
        self.since = np.full(256, -1, np.int64)

    def seed(self, suffix: int) -> None:
        """The last suffix follows the end, which is less than anything."""
        byte = int(self.owner.text[suffix])
        self.queue.push(byte, np.array([suffix]), np.zeros(1, np.int64))
        self.since[byte] = 0

    def feed(self, suffixes: np.ndarray, common: np.ndarray) -> None:
        """`common` is what each suffix shares with the one before it in the scan."""
        text, rises = self.owner.text, self.owner.rises
        self.last = int(suffixes[-1])
        before = suffixes - 1
        fit = before >= 0
        fit[fit] = rises[before[fit]] != self.falls
        at = np.flatnonzero(fit)
        seen = np.minimum(self.since, common.min())
        if len(at):
            found = before[at]
            byte = text[found]
            sort = np.argsort(byte, kind="stable")
            at, found, byte = at[sort], found[sort], byte[sort]
            head = np.ones(len(at), bool)
            head[1:] = byte[1:] != byte[:-1]
            heads = np.flatnonzero(head)
            lo = np.zeros(len(at), np.int64)
            lo[1:] = at[:-1] + 1
            lo[heads] = 0
            least = _least_between(common, lo, at + 1)
            least[heads] = np.minimum(least[heads], self.since[byte[heads]])
            shared = np.minimum(least + 1, self.owner.limit)
            tails = np.append(heads[1:], len(at)) - 1
            rest = at[tails] + 1
            after = np.full(len(tails), self.owner.limit, np.int64)
            some = rest < len(common)
            after[some] = _least_between(common, rest[some], np.full(some.sum(), len(common)))
            seen[byte[tails]] = after
            for a, b in zip(heads.tolist(), (tails + 1).tolist(), strict=True):
                self.queue.push(int(byte[a]), found[a:b], shared[a:b])
        self.since = seen


def suffix_spans(size: int, memory: int = 64 << 20):
    """Decides which bytes of a shard's segments are covered by a string of `size` bytes that also
    begins earlier: in a document with a smaller id, or at an earlier place of the same one."""

    def decide(docs: np.ndarray, starts: list, contents: list[bytes]) -> Iterator[tuple[int, int, int]]:
        order, met = [], set()
        for row in sorted(range(len(contents)), key=lambda r: (docs[r], starts[r][0])):
            # of equal segments all but the earliest are repeated as a whole
            if contents[row] in met:
                yield row, 0, len(contents[row])
            else:
                met.add(contents[row])
                order.append(row)
        ends = np.cumsum([len(contents[r]) for r in order])
        if not len(ends):
            return
        text = np.frombuffer(b"".join(contents[r] for r in order), np.uint8)
        # strings of `size` bytes of one segment; earlier segments may still begin later in a document
        whole = np.zeros(len(text) + 1, bool)
        heads = np.append(0, ends[:-1])
        long_enough = ends - heads >= size
        steps = np.zeros(len(text) + 1, np.int64)
        np.add.at(steps, heads[long_enough], 1)
        np.add.at(steps, ends[long_enough] - size + 1, -1)
        whole[:] = np.cumsum(steps) > 0
        number = np.repeat(np.arange(len(order)), ends - heads)
        doc = docs[order]
        start = np.array([starts[r][0] for r in order], np.int64)

        def place(suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            n = number[suffixes]
            return doc[n], start[n] + suffixes - heads[n]

        covered = np.zeros(len(text), bool)  # by place of the first byte
        held: list = []

        def close(group_suffixes: np.ndarray, group: np.ndarray) -> None:
            """Marks all but the earliest place of each group of equal strings."""
            ids, places = place(group_suffixes)
            sort = np.lexsort((places, ids, group))
            g = group[sort]
            later = np.zeros(len(g), bool)
            later[1:] = g[1:] == g[:-1]
            # overlapping segments may hold one place twice: it is not earlier than itself
            i, p = ids[sort], places[sort]
            earliest = np.maximum.accumulate(np.where(later, 0, np.arange(len(g))))
            itself = (i == i[earliest]) & (p == p[earliest])
            covered[group_suffixes[sort][later & ~itself]] = True

        for suffixes, common in Induction(text, size, memory).run():
            # a group goes on while neighbours share `size` bytes, also from piece to piece
            cut = np.flatnonzero(common < size)
            if not len(cut):
                held.append(suffixes)
                continue
            parts = [*held, suffixes[: cut[0]]]
            held = [suffixes[cut[-1] :]]
            for piece, group in (
                (np.concatenate(parts), None),
                (suffixes[cut[0] : cut[-1]], np.cumsum(common[cut[0] : cut[-1]] < size)),
            ):
                group = np.zeros(len(piece), np.int64) if group is None else group
                fits = whole[piece]
                if fits.sum() > 1:
                    close(piece[fits], group[fits])
        last = np.concatenate(held) if held else np.zeros(0, np.int64)
        last = last[whole[last]]
        if len(last) > 1:
            close(last, np.zeros(len(last), np.int64))
        hits = np.flatnonzero(covered)
        if len(hits):
            n = number[hits]
            head = np.ones(len(hits), bool)
            head[1:] = (hits[1:] != hits[:-1] + 1) | (n[1:] != n[:-1])
            at = np.flatnonzero(head)
            tail = np.append(at[1:], len(hits)) - 1
            for a, b, k in zip(hits[at].tolist(), hits[tail].tolist(), n[at].tolist(), strict=True):
                yield order[k], a - int(heads[k]), b - int(heads[k]) + size

    return decide


def _remove(as_text: bool):
    return lambda batches: (_kept(batch, as_text) for batch in batches)


def _kept(batch: pa.RecordBatch, as_text: bool) -> pa.RecordBatch:
    texts = batch.column("text").cast(pa.large_string()).cast(pa.large_binary()).to_pylist()
    sizes, removed, counts, runs, kept = [], [], [], [], []
    for text, found in zip(texts, batch.column("spans").to_pylist(), strict=True):
        cut = merged(found)
        sizes.append(len(text))
        removed.append(sum(e - s for s, e in cut))
        counts.append(len(cut))
        runs.append([{"start": s, "end": e} for s, e in cut])
        edges = [0, *(x for span in cut for x in span), len(text)]
        kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
    rest = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()) if as_text else pa.array(kept, pa.binary())
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(counts, pa.int64()),
            pa.array(runs, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), rest,
        ],
        ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept_text" if as_text else "kept"],
    )


def suffix_dedup(docs: DataFrame, *, size: int = 100, as_text: bool = False) -> DataFrame:
    """Removes every byte that a string of `size` bytes covers which also begins earlier: in a document
    with a smaller `doc_id`, or at an earlier place of the same document. Returns `doc_id`, `n_bytes`,
    `n_removed`, `n_spans`, `spans` (maximal removed runs) and `kept` (the other bytes, as binary, since
    a run may begin or end inside a character; with `as_text` `kept_text`, without such characters).

    Segments of text whose anchor occurs elsewhere come together in shards (see `anchored`). A shard
    sorts its suffixes by induction (see `Induction`) with queues that spill to the task's disk, and
    strings of `size` bytes are equal where all neighbours between them share that much.

    Texts are UTF-8 bytes; null and empty texts have none, and documents of fewer than `size` bytes
    keep all. Rows that repeat an id are one document and rows without an id are left out (see
    `texts_of`); other columns are ignored. An empty table gives an empty result.
    """
    texts = texts_of(docs)
    scratch = tables(docs.sparkSession)
    windows = Windows("byte", size, k=max(1, size // 4), same_document=True)
    spans = repeated_spans(texts, windows, suffix_spans(size), scratch)
    return texts.join(spans, "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(
        _remove(as_text), _OUT + ("kept_text string" if as_text else "kept binary")
    )


def without_repeats(docs: DataFrame, key: str, *, size: int = 100) -> DataFrame:
    """`docs` with all columns and every string of `size` bytes only where it begins first, in order of the column
    `key` (long, unique). `text` loses the bytes and what is left of a cut character, `n_chars` is counted
    again; a null text stays null. Text is exchanged once, the other columns join it by their key."""
    texts = docs.select(F.col(key).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    windows = Windows("byte", size, k=max(1, size // 4), same_document=True)
    spans = repeated_spans(texts, windows, suffix_spans(size), tables(docs.sparkSession))
    others = docs.select(
        F.col(key).alias("doc_id"),
        F.struct(*[c for c in docs.columns if c not in (key, "text")]).alias("others"),
        F.col("text").isNull().alias("unknown"),
    )
    schema = StructType([StructField("text", StringType()), others.schema["others"], others.schema["unknown"]])
    cut = texts.join(spans, "doc_id", "left").join(others, "doc_id").mapInArrow(_cut_rows, schema)
    own = {c: F.col("others")[c] for c in docs.columns if c not in (key, "text")}
    own["text"] = F.when(~F.col("unknown"), F.col("text"))
    if "n_chars" in own:
        own["n_chars"] = F.when(F.col("unknown"), own["n_chars"]).otherwise(F.length("text").cast("long"))
    return cut.select(*[own[c].alias(c) for c in docs.columns if c != key])


def _cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = _kept(batch, as_text=True).column("kept_text")
        columns = [kept, batch.column("others"), batch.column("unknown")]
        yield pa.RecordBatch.from_arrays(columns, ["text", "others", "unknown"])
