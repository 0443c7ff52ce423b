"""Stupid-backoff scores of documents, from counts of words and bigrams that are grouped by hash."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from temporal_tree.llm.anchored import slices
from temporal_tree.llm.batches import LOWER, Words, mix, text_bytes
from temporal_tree.llm.documents import tables, texts_of

START = 0  # stands before the first word

# keys that a task counts at once
_PART_KEYS = 2_000_000
# bytes of text that send a key once
_SLICE_BYTES = 2 << 20
_SLICES = "slice long, n_words long, docs binary, counts binary, vocabulary binary, places binary"
_REQUESTS = "part int, slice long, keys binary, n binary"
_ANSWERS = "part int, slice long, n binary"
_SCORES = "doc_id long, n_words long, log_score double"


def _slice_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per slice of texts: its documents with words, how many words each has, the distinct words' hashes, the start
    first, and the words as places among them."""
    for whole in batches:
        for batch in slices(whole, _SLICE_BYTES):
            raw, bounds = text_bytes(batch.column("text"))
            words = Words(LOWER[raw], bounds)
            if not len(words):
                continue
            hashes = words.hashes()
            hashes[hashes == START] = 1
            vocabulary, places = np.unique(np.append(np.uint64(START), hashes), return_inverse=True)
            some = words.counts > 0
            docs = batch.column("doc_id").to_numpy(zero_copy_only=False)[some]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(docs[0])], pa.int64()),  # ids are unique, so one of its own names the slice
                    pa.array([len(words)], pa.int64()),
                    *(pa.array([x.tobytes()], pa.binary()) for x in (docs, words.counts[some], vocabulary, places[1:].astype(_narrow(len(vocabulary))))),
                ],
                ["slice", "n_words", "docs", "counts", "vocabulary", "places"],
            )


def _narrow(size: int) -> type:
    return np.uint16 if size <= 1 << 16 else np.uint32


class _Slice:
    """A slice's words, and its keys: the hashes of its distinct words, then of its distinct pairs of neighbours."""

    def __init__(self, row: dict, parts: int):
        self.docs, self.counts = np.frombuffer(row["docs"], np.int64), np.frombuffer(row["counts"], np.int64)
        vocabulary = np.frombuffer(row["vocabulary"], np.uint64)
        self.size = len(vocabulary)
        self.word = np.frombuffer(row["places"], _narrow(self.size)).astype(np.int64)
        self.row = np.repeat(np.arange(len(self.docs)), self.counts)
        self.before = np.empty_like(self.word)
        self.before[1:] = self.word[:-1]
        self.first = np.cumsum(self.counts) - self.counts
        self.before[self.first] = START
        pairs, times = np.unique(self.before * self.size + self.word, return_counts=True)
        a, b = np.divmod(pairs, self.size)
        self.keys = np.append(vocabulary, mix(vocabulary[a] ^ mix(vocabulary[b]), salt=1))
        self.n = np.append(np.bincount(self.word, minlength=self.size), times)
        self.n[START] = len(self.docs)
        self.part = ((self.keys >> np.uint64(32)) % np.uint64(parts)).astype(np.int32)

    def dealt(self, turn: int = 0, rounds: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The places of the turn's keys by part, the parts that have some, and where each begins, with the end."""
        order = np.flatnonzero(self.part % rounds == turn)
        order = order[np.argsort(self.part[order], kind="stable")]
        part, heads = np.unique(self.part[order], return_index=True)
        return order, part, np.append(heads, len(order))

    def scores(self, found: np.ndarray, floor: float) -> np.ndarray:
        """Per document the sum of its words' scores. `found` has what each key counts in the corpus."""
        _, pair = np.unique(self.before * self.size + self.word, return_inverse=True)
        # how often a word and a pair occur in their own document
        _, spot, times = np.unique(self.row * self.size + self.word, return_inverse=True, return_counts=True)
        own = times[spot]
        own_before = np.empty_like(own)
        own_before[1:] = own[:-1]
        own_before[self.first] = 1
        _, at, m = np.unique(self.row * (len(self.keys) - self.size) + pair, return_index=True, return_counts=True)
        rest = found[self.size :][pair[at]] - m
        known = rest > 0
        word = np.where(known, self.before[at], self.word[at])
        others = np.maximum(found[word] - np.where(known, own_before[at], own[at]), 0.5)
        score = np.where(known, np.log(np.maximum(rest, 1)) - np.log(others), np.log(floor) + np.log(others))
        return np.bincount(self.row[at], weights=m * score, minlength=len(self.docs))


def _requests(parts: int, turn: int, rounds: int):
    """A slice's keys and how often each occurs in it, a row for every part of this turn that has some."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                own = _Slice(row, parts)
                order, some, bounds = own.dealt(turn, rounds)
                spans = list(zip(bounds[:-1], bounds[1:], strict=True))
                keys, n = own.keys[order], own.n[order].astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(some, pa.int32()), pa.array([row["slice"]] * len(some), pa.int64()),
                        pa.array([keys[a:b].tobytes() for a, b in spans], pa.binary()),
                        pa.array([n[a:b].tobytes() for a, b in spans], pa.binary()),
                    ],
                    ["part", "slice", "keys", "n"],
                )

    return emit


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by part. Of each the numbers of its keys, in their order, summed over all rows of the part."""

    def settled(table: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = [np.frombuffer(x, np.uint64) for x in table["keys"].to_pylist()]
        n = np.concatenate([np.frombuffer(x, np.uint32) for x in table["n"].to_pylist()])
        _, spot = np.unique(np.concatenate(keys), return_inverse=True)
        found = np.bincount(spot, weights=n).astype(np.uint64)[spot]
        ends = np.cumsum([len(k) for k in keys])
        blocks = (found[end - len(k) : end] for k, end in zip(keys, ends, strict=True))
        answers = pa.array([x.astype(np.min_scalar_type(x.max())).tobytes() for x in blocks], pa.binary())
        out = pa.table({"part": table["part"], "slice": table["slice"], "n": answers})
        yield from out.to_batches(max_chunksize=1_000)

    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        part = batch["part"].to_numpy()
        heads = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else ()
        for a, b in zip(heads, [*heads[1:], len(part)], strict=True):
            if waiting and waiting[0]["part"][0].as_py() != part[a]:
                yield from settled(pa.Table.from_batches(waiting))
                waiting = []
            waiting.append(batch.slice(a, b - a))
    if waiting:
        yield from settled(pa.Table.from_batches(waiting))


def _scored(parts: int, floor: float):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                own = _Slice(row, parts)
                order, some, bounds = own.dealt()
                place = {int(k): order[a:b] for k, a, b in zip(some, bounds[:-1], bounds[1:], strict=True)}
                found = np.empty(len(own.keys), np.int64)
                for answer in row["answers"]:
                    at = place[answer["part"]]
                    found[at] = np.frombuffer(answer["n"], f"u{len(answer['n']) // len(at)}")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own.docs), pa.array(own.counts), pa.array(own.scores(found, floor))], ["doc_id", "n_words", "log_score"]
                )

    return emit


def stupid_backoff(docs: DataFrame, *, discount: float = 0.4, rounds: int = 8) -> DataFrame:
    """Per document `n_words`, `log_score` (sum over its words) and `mean_log_score`, by a bigram model of
    all other documents (Brants et al., "Large Language Models in Machine Translation", 2007).

    A word's score is c(before, word) / c(before) if other documents have that pair, else
    `discount` * c(word) / N; a word that no other document has counts as half an occurrence. Counts
    leave out the document itself, since every n-gram of a corpus occurs in it. Words are runs of
    anything but space, tab and line ends, with A-Z in lower case; the first word follows a start
    symbol.

    Words and pairs are 64-bit hashes. A slice (about two megabytes of texts) sends each distinct one once, with its
    number, to the part of its hash, and gets the number in the corpus back by a join, in the same order. So a
    frequent pair costs a number per slice, not per document, and texts are read once.

    Parts are dealt into `rounds`. A round sends its keys and writes their numbers; then its shuffle files go. So
    disk holds a part of all keys at a time, at the price of reading the slices once a round.

    Null, empty and blank texts have 0 words, a score of 0 and a null mean. Rows that repeat an id are
    one document and rows without an id are left out (see `texts_of`); other columns are ignored. An
    empty table gives an empty result.
    """
    scratch = tables(docs.sparkSession)
    texts = texts_of(docs)
    sliced, seen = scratch.save_measured(texts.mapInArrow(_slice_rows, _SLICES), "slices", total=F.sum("n_words"))
    total = seen["total"] or 1
    parts = max(8 * rounds, -(-total // _PART_KEYS))
    answers = []
    for turn in range(rounds):
        requests = sliced.mapInArrow(_requests(parts, turn, rounds), _REQUESTS)
        dealt = requests.repartition(-(-parts // rounds), "part").sortWithinPartitions("part")
        answers.append(scratch.save(dealt.mapInArrow(_counted, _ANSWERS), "answers"))
    of_slice = (
        reduce(DataFrame.unionByName, answers)
        .groupBy("slice")
        .agg(F.collect_list(F.struct("part", "n")).alias("answers"))
    )
    scores = sliced.join(of_slice, "slice").mapInArrow(_scored(parts, discount / total), _SCORES)
    return texts.select("doc_id").join(scores, "doc_id", "left").select(
        "doc_id",
        F.coalesce("n_words", F.lit(0)).alias("n_words"),
        F.coalesce("log_score", F.lit(0.0)).alias("log_score"),
        (F.col("log_score") / F.col("n_words")).alias("mean_log_score"),
    )
