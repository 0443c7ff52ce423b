"""Substring deduplication by relative Lempel-Ziv parsing."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from temporal_tree.llm.anchored import Windows, merged, repeated_spans
from temporal_tree.llm.documents import tables, texts_of

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_OUT = "doc_id long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept_text string"


class ReferenceBlock:
    """Some segments of earlier documents, indexed by every string of `size` words."""

    def __init__(self, size: int, capacity: int):
        self.size, self.capacity = size, capacity
        self.places: dict[bytes, tuple[list[bytes], int]] = {}

    @property
    def full(self) -> bool:
        return len(self.places) >= self.capacity

    def add(self, words: list[bytes], seeds: list[bytes]) -> None:
        for at, seed in enumerate(seeds):
            self.places.setdefault(seed, (words, at))

    def longest(self, words: list[bytes], at: int, seed: bytes) -> int:
        """Words of the factor that begins at `at`, or 0 if it has fewer than `size`."""
        place = self.places.get(seed)
        if place is None:
            return 0
        other, there = place
        length, most = self.size, min(len(words) - at, len(other) - there)
        while length < most and words[at + length] == other[there + length]:
            length += 1
        return length


def factor_spans(size: int, block_seeds: int = 1_000_000):
    """Decides which words of a shard's segments are repeated from documents with smaller ids."""

    def decide(docs: np.ndarray, _starts: list, contents: list[bytes]) -> Iterator[tuple[int, int, int]]:
        blocks = [ReferenceBlock(size, block_seeds)]
        waiting: list[tuple[list[bytes], list[bytes]]] = []
        last = None
        for row, doc in enumerate(docs.tolist()):
            if doc != last:  # a document is no reference for itself
                for words, seeds in waiting:
                    if blocks[-1].full:
                        blocks.append(ReferenceBlock(size, block_seeds))
                    blocks[-1].add(words, seeds)
                waiting, last = [], doc
            words = contents[row].split(b" ")
            seeds = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]
            at = 0
            while at < len(seeds):
                length = max(block.longest(words, at, seeds[at]) for block in blocks)
                if length:
                    yield row, at, at + length
                    # strings of `size` words inside the factor are done; those across its end are
                    # looked up one by one, since greedy factors do not show them
                    at += length - size + 1
                else:
                    at += 1
            waiting.append((words, seeds))

    return decide


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts, spans = (batch.column(n).to_pylist() for n in ("doc_id", "text", "spans"))
        n_words, n_removed, runs, kept = [], [], [], []
        for text, found in zip(texts, spans, strict=True):
            words = _WORD.findall(text)
            cut = merged(found)
            n_words.append(len(words))
            n_removed.append(sum(e - s for s, e in cut))
            runs.append([{"start": s, "end": e} for s, e in cut])
            for s, e in reversed(cut):
                del words[s:e]
            kept.append(" ".join(words))
        yield pa.RecordBatch.from_pydict(
            {"doc_id": ids, "n_words": n_words, "n_removed": n_removed, "spans": runs, "kept_text": kept},
            schema=pa.schema(
                [
                    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept_text", pa.string()),
                ]
            ),
        )


def substring_dedup(docs: DataFrame, *, words: int = 13) -> DataFrame:
    """Removes every word that a string of `words` words covers which also begins in a document with
    a smaller `doc_id`. Returns `doc_id`, `n_words`, `n_removed`, `spans` (removed runs, in words) and
    `kept_text` (the other words, joined by one space).

    Segments of text whose anchor occurs elsewhere come together in shards (see `anchored`). There,
    documents in order of their ids are factored greedily against indexed blocks of all earlier ones.

    Words are runs of anything but space, tab and line ends, unchanged. Null and empty texts have no
    words; documents of fewer than `words` words keep all. Rows that repeat an id are one document
    and rows without an id are left out (see `texts_of`); other columns are ignored. An empty table
    gives an empty result.
    """
    texts = texts_of(docs)
    scratch = tables(docs.sparkSession)
    windows = Windows("word", words, k=max(1, words // 2), same_document=False)
    spans = repeated_spans(texts, windows, factor_spans(words), scratch)
    return texts.join(spans, "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(_remove, _OUT)
