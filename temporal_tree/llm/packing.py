"""Best-fit packing of tokenized documents into sequences of bounded length."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from temporal_tree.llm.documents import tables, texts_of

END = 2
# fixed values: the byte-level pattern, as published with the vocabulary
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
_PACKED = _PIECES + ", sequence long, offset long"
_CACHED_WORDS = 300_000


class _Encoder:
    """Token ids as little-endian 32-bit numbers, equal to those of `tokenizers` for the same file.

    A space after a character that is no white space always begins a new unit of the byte-level
    pattern, so text is cut there and the ids of frequent pieces are kept. Pieces are encoded with
    the same merges as ranks; texts with special tokens or runs of mixed white space go to
    `tokenizers` as they are.
    """

    _mixed = re.compile(r"\s ")

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        special = [re.escape(t["content"]) for t in model.get("added_tokens", [])]
        self.special = re.compile("|".join(special)) if special else None
        self.ranks = self._ranks(model)
        self.known: dict[str, bytes] = {}

    @staticmethod
    def _ranks(model: dict) -> tiktoken.Encoding | None:
        """The merges as ranks, if ids follow the order of the merges."""
        # printable bytes stand for themselves, the others for code points from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        spare = count(256)
        byte_of = {chr(b if b in plain else next(spare)): b for b in range(256)}
        added = {t["content"] for t in model.get("added_tokens", [])}
        vocabulary = {t: i for t, i in model["model"]["vocab"].items() if t not in added}
        merges = model["model"]["merges"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        if model.get("normalizer") or any(vocabulary.get("".join(p)) != 256 + i for i, p in enumerate(pairs)):
            return None
        tokens = {bytes(byte_of[c] for c in t): i for t, i in vocabulary.items()}
        return tiktoken.Encoding("ranks", pat_str=_PATTERN, mergeable_ranks=tokens, special_tokens={})

    def encode(self, text: str) -> bytes:
        if self.ranks is None or self._mixed.search(text) or self.special and self.special.search(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        head, *rest = text.split(" ")
        known = self.known
        out = [self._ids(head)]
        for part in rest:
            ids = known.get(part)
            if ids is None:
                ids = self._ids(" " + part)
                if len(part) < 24:
                    if len(known) >= _CACHED_WORDS:
                        known.clear()
                    known[part] = ids
            out.append(ids)
        return b"".join(out)

    def _ids(self, text: str) -> bytes:
        return np.array(self.ranks.encode_ordinary(text), "<u4").tobytes()


@lru_cache(maxsize=2)
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


def _pieces(path: str, size: int, with_ids: bool):
    end = np.array([END], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            rows: dict[str, list] = {f: [] for f in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = encoder.encode(text.as_py()) + end
                n = len(ids) // 4
                cuts = [0, *range(n % size or size, n, size), n] if n > size else [0, n]
                for piece, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    part = ids[4 * a : 4 * b]
                    for name, value in (
                        ("doc_id", doc), ("piece", piece), ("start", a), ("length", b - a),
                        ("ids_crc32", zlib.crc32(part)), ("ids", part if with_ids else None),
                    ):
                        rows[name].append(value)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), types, strict=True)], list(rows))

    return run


class OpenBins:
    """Bounded-space best fit: at most `limit` open bins of `size`, in a bitset keyed by free space."""

    def __init__(self, size: int, limit: int):
        self.size, self.limit = size, limit
        self.bits = 0  # bit f is set if an open bin has f free
        self.by_free: list[list[int]] = [[] for _ in range(size + 1)]
        self.open, self.opened = 0, 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.open -= 1
        return number

    def _put(self, number: int, free: int) -> None:
        if free:
            self.by_free[free].append(number)
            self.bits |= 1 << free
            self.open += 1

    def place(self, length: int) -> tuple[int, int]:
        """The bin and the offset in it. The open bin with the least space that is enough takes the
        piece; else a new one does, for which the fullest closes if all are in use."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if self.open >= self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)
            free, number = self.size, self.opened
            self.opened += 1
        self._put(number, free - length)
        return number, self.size - free

    def rest(self) -> list[tuple[int, int]]:
        """The open bins as (content, bin), fullest first."""
        return [(self.size - free, number) for free, bins in enumerate(self.by_free) for number in bins]


def _pack(size: int, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if not parts:
            return
        # a shard's pieces are a few numbers each; ids, if asked for, come along as they are
        table = pa.Table.from_batches(parts).sort_by([("shard", "ascending"), ("doc_id", "ascending"), ("piece", "ascending")])
        shard, length = table["shard"].to_numpy(), table["length"].to_numpy()
        sequence, offset = np.zeros(len(shard), np.int64), np.zeros(len(shard), np.int64)
        for one in np.unique(shard):
            at = np.flatnonzero(shard == one)
            # as many pieces as there are open bins come in together, the longest first
            blocks = [at[k : k + limit] for k in range(0, len(at), limit)]
            at = np.concatenate([b[np.argsort(-length[b], kind="stable")] for b in blocks])
            bins = OpenBins(size, limit)
            placed = np.array([bins.place(n) for n in length[at].tolist()], np.int64).reshape(-1, 2)
            # what is still open in the end goes together where it fits, as a whole
            joined, where = OpenBins(size, size), np.arange(bins.opened)
            shift = np.zeros(bins.opened, np.int64)
            roots: dict[int, int] = {}
            for content, number in bins.rest():
                new, start = joined.place(content)
                where[number] = roots.setdefault(new, number)
                shift[number] = start
            sequence[at] = (int(one) << 32) + where[placed[:, 0]]
            offset[at] = placed[:, 1] + shift[placed[:, 0]]
        table = table.drop_columns("shard").append_column("sequence", pa.array(sequence)).append_column("offset", pa.array(offset))
        yield from table.to_batches(max_chunksize=10_000)

    return run


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pack(
    docs: DataFrame,
    *,
    tokenizer: str | None = None,
    size: int = 1024,
    open_bins: int = 1024,
    shard_tokens: int = 1 << 22,
    with_ids: bool = True,
) -> DataFrame:
    """Packs documents into sequences of at most `size` tokens.

    A document is its token ids by the byte-level `tokenizer` file (which executors must have at that
    path) and id 2. Documents of more than `size` tokens are cut into pieces of `size`, the first of
    which may be shorter; others are whole. Returns per piece `doc_id`, `piece`, `start` (the document's
    ids before it), `length`, `ids_crc32`, `ids` (little-endian 32-bit numbers, null without `with_ids`),
    `sequence_id` and `offset` (place in the sequence; sequences have no gaps).

    Pieces are dealt by a hash of their document to shards of about `shard_tokens` tokens, which are
    packed on their own, so that the number of tasks grows with the corpus. In a shard pieces come
    in order of document, in blocks of `open_bins` with the longest first, and are placed at once;
    `open_bins` bounds the bins that can still be filled.

    A null or empty text is a document of id 2 alone. Rows that repeat an id are one document and
    rows without an id are left out (see `texts_of`); other columns are ignored. An empty table gives
    an empty result.
    """
    scratch = tables(docs.sparkSession)
    path = tokenizer or default_tokenizer()
    pieces, seen = scratch.save_measured(
        texts_of(docs).mapInArrow(_pieces(path, size, with_ids), _PIECES), "pieces", tokens=F.sum("length")
    )
    shards = max(1, round((seen["tokens"] or 0) / shard_tokens))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)))
    packed = dealt.repartition(shards, "shard").mapInArrow(_pack(size, open_bins), _PACKED)
    return packed.withColumnRenamed("sequence", "sequence_id")
