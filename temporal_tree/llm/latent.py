"""Benchmark decontamination by latent semantic retrieval."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from temporal_tree.llm.anchored import slices
from temporal_tree.llm.batches import LOWER, Words, text_bytes
from temporal_tree.llm.documents import tables, texts_of

_SEPARATOR = np.ones(256, bool)
_SEPARATOR[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_BLOCK = 8  # words; passages are some blocks and begin at any block
_SHORT, _LONG = 2, 4  # blocks of a passage, for items of fewer than 24 words and for others
_WHOLE = 48  # words; longer items are searched by parts of a long passage's length that overlap by half
_BUCKETS = 1 << 16  # hashed words, for document frequencies
_PART = 1 << 10  # rows of a matrix that are summed in one group
_ITEMS = 20_000  # benchmark items that are searched at once
_FLOOR = 1 / 3  # least weight of a word, as a part of the greatest
_ANSWER = 5  # words at the end of an item that count as its answer
_OUT = "doc_id long, n_words long, contaminated boolean, item_id long, similarity double, start int, end int, n_items int"


def words_in(column: pa.Array) -> tuple[Words, np.ndarray]:
    raw, bounds = text_bytes(column)
    raw = LOWER[raw]
    # the second bytes of the Latin capitals with accents, of which U+00D7 is none
    accented = np.flatnonzero(raw[:-1] == 0xC3) + 1
    accented = accented[(raw[accented] >= 0x80) & (raw[accented] <= 0x9E) & (raw[accented] != 0x97)]
    raw[accented] += 0x20
    words = Words(raw, bounds, _SEPARATOR)
    return words, words.hashes()


class _Blocks:
    """The words of a batch in blocks that do not cross documents."""

    def __init__(self, words: Words):
        n = -(-words.counts // _BLOCK)
        self.first = np.append(0, np.cumsum(n))  # of each document
        self.doc = np.repeat(np.arange(len(n)), n)
        self.of_word = self.first[words.doc] + (np.arange(len(words)) - words.first[words.doc]) // _BLOCK

    def __len__(self) -> int:
        return int(self.first[-1])


def _summed(parts: DataFrame, shape: tuple[int, int], dtype) -> np.ndarray:
    """The sum of matrices that tasks emit in groups of rows (`part`, `data`). A group is summed while
    it streams through a task; the driver gets one matrix, whose size is a parameter's."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(batch.column("part").to_pylist(), batch.column("data"), strict=True):
                values = np.frombuffer(data.as_py(), dtype)
                total[part] = total[part] + values if part in total else values
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], ["part", "data"]
        )

    out = np.zeros(shape, dtype)
    for row in parts.repartition("part").mapInArrow(add, "part int, data binary").collect():
        rows = out[row["part"] * _PART : (row["part"] + 1) * _PART]
        rows += np.frombuffer(row["data"], dtype).reshape(rows.shape)
    return out


def _emit(matrix: np.ndarray) -> pa.RecordBatch:
    starts = range(0, len(matrix), _PART)
    return pa.RecordBatch.from_arrays(
        [pa.array(range(len(starts)), pa.int32()), pa.array([matrix[s : s + _PART].tobytes() for s in starts], pa.binary())], ["part", "data"]
    )


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each bucket occurs; the row after the last has the number of words."""
    total = np.zeros((_BUCKETS + _PART, 1), np.int64)
    for whole in batches:
        for batch in slices(whole):
            _, hashes = words_in(batch.column("text"))
            total[:_BUCKETS, 0] += np.bincount((hashes >> np.uint64(48)).astype(np.int32), minlength=_BUCKETS)
            total[_BUCKETS, 0] += len(hashes)
    yield _emit(total)


class Vocabulary:
    """Weights of all words, and the numbers of those that benchmark items have."""

    def __init__(self, weight: np.ndarray, items: np.ndarray):
        self.weight = weight
        self.items = items  # ascending hashes
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(items >> np.uint64(44)).astype(np.int64)] = True

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words that are benchmark words: their places, and their numbers."""
        at = np.flatnonzero(self.maybe[(hashes >> np.uint64(44)).astype(np.int64)])
        number = np.minimum(np.searchsorted(self.items, hashes[at]), max(0, len(self.items) - 1))
        right = self.items[number] == hashes[at] if len(self.items) else np.zeros(0, bool)
        return at[right], number[right]

    def weights(self, hashes: np.ndarray) -> np.ndarray:
        return self.weight[(hashes >> np.uint64(48)).astype(np.int64)]


def word_weights(frequency: np.ndarray, total: int) -> np.ndarray:
    """Inverse frequencies of the buckets, of which none is less than a third of the greatest: so three
    quarters of a passage are enough of its weights for a cosine of 0.5, whatever words they are."""
    weight = np.log((total + 1) / (frequency + 1))
    return np.maximum(weight, _FLOOR * np.log(total + 1))


def _block_sums(block: np.ndarray, number: np.ndarray, rows: np.ndarray, out: np.ndarray) -> None:
    """Adds the rows of each number to its block; blocks ascend and have a few numbers each."""
    heads = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(block) else np.zeros(0, int)
    sizes = np.diff(np.append(heads, len(block)))
    for k in range(0, len(heads), 4096):  # what is added to stays in a cache
        head, size = heads[k : k + 4096], sizes[k : k + 4096]
        sums = rows[number[head]]
        for step in range(1, int(size.max())):
            more = np.flatnonzero(size > step)
            sums[more] += rows[number[head[more] + step]]
        out[block[head]] = sums


def _add_image(total: np.ndarray, column: pa.Array, vocabulary: Vocabulary, probe: np.ndarray) -> None:
    """Adds A'(A probe), where the rows of A are the weights of benchmark words in the texts' passages."""
    words, hashes = words_in(column)
    blocks = _Blocks(words)
    at, number = vocabulary.look_up(hashes)
    weight = vocabulary.weights(hashes[at]).astype(np.float32)
    # passages of `_LONG` blocks that do not overlap
    block = blocks.of_word[at]
    doc_first = blocks.first[blocks.doc[block]] if len(block) else block
    passage = doc_first + (block - doc_first) // _LONG
    # some passages at once, as a dense matrix of the words they have
    heads = np.flatnonzero(np.append(True, passage[1:] != passage[:-1])) if len(passage) else np.zeros(0, int)
    bounds = np.append(heads, len(at))
    row = np.repeat(np.arange(len(heads)), np.diff(bounds))
    for k in range(0, len(heads), 32):
        part = slice(bounds[k], bounds[min(k + 32, len(heads))])
        found, column_of = np.unique(number[part], return_inverse=True)
        n = min(32, len(heads) - k)
        matrix = np.bincount((row[part] - k) * len(found) + column_of, weight[part], n * len(found))
        matrix = matrix.astype(np.float32).reshape(n, len(found))
        total[found] += matrix.T @ (matrix @ probe[found])


def _range_rows(vocabulary: Vocabulary, probe: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros_like(probe)
        for whole in batches:
            for batch in slices(whole):
                _add_image(total, batch.column("text"), vocabulary, probe)
        yield _emit(total)

    return run


def _common(item: list[int], region: list[int]) -> int:
    """The length of the longest common subsequence, with a bit per word of the item."""
    places: dict[int, int] = {}
    for i, w in enumerate(item):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for w in region:
        hit = row & places.get(w, 0)
        row = (row + hit | row - hit) & full
    return len(item) - row.bit_count()


def _basis(image: np.ndarray, own: np.ndarray, dimensions: int) -> np.ndarray:
    """The first left singular vectors, of documents' and items' passages to equal parts: else words of
    items that documents rarely have would be missing from the space."""
    if not len(image):
        return image
    sizes = [max(float(np.linalg.norm(m)), 1e-9) for m in (image, own)]
    both = image.astype(np.float64) / sizes[0] + own / sizes[1]
    left, _, _ = np.linalg.svd(both, full_matrices=False)
    return np.ascontiguousarray(left[:, :dimensions], np.float32)


def _parts(n: int) -> list[tuple[int, int]]:
    """The parts by which an item of `n` words is searched: a cosine with more words than a passage has
    would fall with the item's length. The last part ends with the item."""
    size = _LONG * _BLOCK
    if n <= _WHOLE:
        return [(0, n)]
    return [(a, a + size) for a in [*range(0, n - size, size // 2), n - size]]


class Search:
    """A block of benchmark items in the latent space, and the check of what is near them."""

    def __init__(self, ids: list[int], texts: list[str], vocabulary: Vocabulary, basis: np.ndarray, least_cosine: float, copied: float, paraphrased: float):
        self.vocabulary, self.basis = vocabulary, basis
        self.least_cosine, self.copied, self.paraphrased = least_cosine, copied, paraphrased
        words, hashes = words_in(pa.array(texts, pa.string()))
        self.ids = ids
        self.items = [hashes[a:b].tolist() for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
        self.counts = [Counter(item) for item in self.items]
        least = min(copied, paraphrased)
        self.needed = [next(c for c in range(n + 2) if c > n or c / max(n, 1) >= least) for n in map(len, self.items)]
        self.numbers = [np.searchsorted(vocabulary.items, np.array(list(c), np.uint64)).tolist() for c in self.counts]
        parts = [(k, a, b) for k, item in enumerate(self.items) for a, b in _parts(len(item))]
        self.item_of = np.array([k for k, _, _ in parts], np.int64)
        vectors = np.zeros((len(parts), basis.shape[1]), np.float32)
        for row, (k, a, b) in enumerate(parts):
            own = hashes[int(words.first[k]) + a : int(words.first[k]) + b]
            at, number = vocabulary.look_up(own)
            vectors[row] = vocabulary.weights(own[at]).astype(np.float32) @ basis[number]
        # a word's weight is that of its hash
        self.weighted = basis * vocabulary.weights(vocabulary.items).astype(np.float32)[:, None]
        self.vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
        short = np.array([len(self.items[k]) < 24 for k, _, _ in parts], bool)
        self.scales = [(_SHORT, np.flatnonzero(short)), (_LONG, np.flatnonzero(~short))]

    def candidates(self, words: Words, hashes: np.ndarray) -> set[tuple[int, int, int]]:
        """(document row, item, first word of the passage) wherever the cosine is high enough."""
        blocks = _Blocks(words)
        n = len(blocks)
        if not n:
            return set()
        weight = self.vocabulary.weights(hashes).astype(np.float32)
        at, number = self.vocabulary.look_up(hashes)
        energy = np.bincount(blocks.of_word, weight**2, n)
        own = np.bincount(blocks.of_word[at], weight[at] ** 2, n)
        # a document's blocks are followed by empty ones, so that no passage reaches the next document's
        place = np.arange(n) + blocks.doc * (_LONG - 1)
        latent = np.zeros((n + (len(blocks.first) - 1) * (_LONG - 1) + _LONG, self.basis.shape[1]), np.float32)
        _block_sums(place[blocks.of_word[at]], number, self.weighted, latent)
        held = self._held(blocks.of_word[at], number)
        last = blocks.first[1:][blocks.doc]
        all_energy, own_energy = np.append(0, np.cumsum(energy)), np.append(0, np.cumsum(own))
        found = set()
        for size, parts in self.scales:
            if not len(parts):
                continue
            end = np.minimum(np.arange(n) + size, last)
            # a cosine is at most the root of the part that is in benchmark words
            part, whole = own_energy[end] - own_energy[:n], all_energy[end] - all_energy[:n]
            start = np.flatnonzero((part >= self.least_cosine**2 * whole - 1e-6) & (part > 0))
            sums, width = latent, 1
            while width < size:
                sums = sums[:-width] + sums[width:]
                width *= 2
            passage = sums[place[start]]
            passage /= np.maximum(np.sqrt(np.einsum("ij,ij->i", passage, passage)), 1e-9)[:, None]
            for g in range(0, len(parts), 256):
                some, near, column = parts[g : g + 256], [start[:0]], [np.zeros(0, np.uint8)]
                for k in range(0, len(start), 8192):
                    close = passage[k : k + 8192] @ self.vectors[some].T >= self.least_cosine
                    row, part = np.divmod(np.flatnonzero(close).astype(np.int32), np.int32(len(some)))
                    near.append(start[k + row])
                    column.append(part.astype(np.uint8))
                # parts ascend by item
                by_part = np.concatenate(column)
                order = np.argsort(by_part, kind="stable")
                item, at_block = self.item_of[some[by_part[order]]], np.concatenate(near)[order]
                heads = np.flatnonzero(np.append(True, item[1:] != item[:-1])) if len(item) else order
                for i, of_item in zip(item[heads].tolist(), np.split(at_block, heads[1:]), strict=False):
                    for b in of_item[self._enough(i, of_item, n, *held)].tolist():
                        doc = int(blocks.doc[b])
                        found.add((doc, i, int(words.first[doc]) + (b - int(blocks.first[doc])) * _BLOCK))
        return found

    def _held(self, block: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """The blocks of all benchmark words in order of their numbers, and where each number begins."""
        n = len(self.vocabulary.items)
        order = np.argsort(number.astype(np.uint16) if n <= 1 << 16 else number, kind="stable")
        return block[order], np.append(0, np.cumsum(np.bincount(number, minlength=n))).tolist()

    def _enough(self, item: int, at: np.ndarray, n: int, block: np.ndarray, bounds: list[int]) -> np.ndarray:
        """Whether the surroundings of the passages that begin at the blocks `at` have a stretch with as many
        words of the item as a match needs. `block` has the places of the benchmark words by number."""
        size = len(self.items[item])
        if not size:
            return np.zeros(len(at), bool)
        places = np.concatenate([block[bounds[w] : bounds[w + 1]] for w in self.numbers[item]])
        wide = (size + 2 * max(1, size // 8) + _BLOCK - 2) // _BLOCK + 1
        count = np.empty(n + wide + 1, np.int32)
        count[0] = 0
        np.cumsum(np.bincount(places, minlength=n), out=count[1 : n + 1])
        count[n + 1 :] = count[n]
        total = np.zeros(n + 1, np.int32)
        np.cumsum(count[wide : n + wide] - count[:n] >= self.needed[item], out=total[1:])
        beside = -(-size // _BLOCK)
        return total[np.minimum(at + beside + _LONG + 1, n)] > total[np.maximum(at - beside, 0)]

    def matches(self, words: Words, hashes: np.ndarray) -> dict[int, list[tuple[float, int, int, int]]]:
        """Per document row (similarity, item id, start, end) of the verified passages."""
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        least = min(self.copied, self.paraphrased)
        for doc, number, at in sorted(self.candidates(words, hashes)):
            item = self.items[number]
            if not item or best.get((doc, number), (0.0,))[0] == 1.0:
                continue
            low, high = int(words.first[doc]), int(words.first[doc + 1])
            # the passage lies somewhere in the item, or the other way round
            start, end = max(low, at - len(item)), min(high, at + _LONG * _BLOCK + len(item))
            region = hashes[start:end].tolist()
            # a common subsequence has no more words than the item has of the region's
            counts = self.counts[number]
            if sum(map(counts.__getitem__, counts.keys() & set(region))) / len(item) < least:
                continue
            similarity, where = self._best_part(item, region)
            if similarity < self.copied:
                answer = item[-_ANSWER:]
                if similarity < self.paraphrased or _common(answer, region[where : where + len(item) * 3 // 2 + _ANSWER]) < len(answer):
                    continue
            if similarity > best.get((doc, number), (0.0,))[0]:
                best[doc, number] = (similarity, start + where - low, min(start + where + len(item), high) - low)
        out: dict[int, list] = {}
        for (doc, number), (similarity, start, end) in best.items():
            out.setdefault(doc, []).append((similarity, self.ids[number], start, end))
        return out

    @staticmethod
    def _best_part(item: list[int], region: list[int]) -> tuple[float, int]:
        """The greatest part of the item that a stretch of a quarter more words has in order."""
        n, best, where = len(item), 0, 0
        step = max(1, n // 8)
        for start in range(0, max(1, len(region) - n + 1 + step), step):
            length = _common(item, region[start : start + n + 2 * step])
            if length > best:
                best, where = length, start
        return best / n, where

    def without(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows that hold no item, with all their columns."""
        for whole in batches:
            for batch in slices(whole):
                found = self.matches(*words_in(batch.column("text")))
                yield batch.filter(pa.array([row not in found for row in range(len(batch))], pa.bool_()))

    def rows(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                words, hashes = words_in(batch.column("text"))
                found = self.matches(words, hashes)
                columns: list[list] = [[] for _ in range(6)]
                for row in range(len(batch)):
                    hits = sorted(found.get(row, ()), key=lambda h: (-h[0], h[1]))
                    top = hits[0] if hits else (None, None, None, None)
                    for column, value in zip(columns, (bool(hits), top[1], top[0], top[2], top[3], len(hits)), strict=True):
                        column.append(value)
                types = [pa.bool_(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(words.counts, pa.int64()), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                    ["doc_id", "n_words", "contaminated", "item_id", "similarity", "start", "end", "n_items"],
                )


def _searches(
    texts: DataFrame, benchmark: DataFrame, dimensions: int, least_cosine: float, copied: float, paraphrased: float
) -> list[Search]:
    """A search for each block of benchmark items, by words and passages of `texts`."""
    scratch = tables(texts.sparkSession)
    items = scratch.save(
        benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), F.coalesce(benchmark["text"], F.lit("")).alias("text"))
        .where("item_id is not null").dropDuplicates(),
        "items",
    )
    blocks = max(1, -(-items.count() // _ITEMS))
    counts = _summed(texts.mapInArrow(_frequencies, "part int, data binary"), (_BUCKETS + _PART, 1), np.int64)
    total = max(1, int(counts[_BUCKETS, 0]))
    frequency = counts[:_BUCKETS, 0]
    weight = word_weights(frequency, total)
    out: list[Search] = []
    for k in range(blocks):
        some = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").toPandas()
        _, hashes = words_in(pa.array(some["text"].tolist(), pa.string()))
        vocabulary = Vocabulary(weight, np.unique(hashes))
        size = (len(vocabulary.items), dimensions + 8)
        probe = np.random.default_rng(k).standard_normal(size, dtype=np.float32)
        image = _summed(texts.mapInArrow(_range_rows(vocabulary, probe), "part int, data binary"), size, np.float32) if size[0] else probe
        own = np.zeros_like(probe)
        _add_image(own, pa.array(some["text"].tolist(), pa.string()), vocabulary, probe)
        basis = _basis(image, own, dimensions)
        out.append(Search(some["item_id"].tolist(), some["text"].tolist(), vocabulary, np.ascontiguousarray(basis), least_cosine, copied, paraphrased))
    return out


def without_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    dimensions: int = 128,
    least_cosine: float = 0.5,
    copied: float = 0.75,
    paraphrased: float = 0.6,
) -> DataFrame:
    """The rows of `docs` that `decontaminate` would not call contaminated, with all their columns: rows are judged
    one by one, whatever their ids, and pass through the search instead of being joined with its result."""
    texts = docs.select(F.lit(0).cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    for search in _searches(texts, benchmark, dimensions, least_cosine, copied, paraphrased):
        docs = docs.mapInArrow(search.without, docs.schema)
    return docs


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    dimensions: int = 128,
    least_cosine: float = 0.5,
    copied: float = 0.75,
    paraphrased: float = 0.6,
) -> DataFrame:
    """Per document `n_words`, `contaminated`, the most similar benchmark item (`item_id`, `similarity`,
    `start` and `end` of its place in words) and `n_items`, how many items it holds.

    1. Words are weighted by their inverse frequency in all documents; very frequent ones keep a third of
       the greatest weight.
    2. The passages' matrix of the weights of benchmark words is multiplied with a random one and back
       in each task (a randomised SVD with one power step); the left singular vectors of the sum
       are the basis of the latent space.
    3. Passages of 16 or 32 words that begin at any block are candidates for an item if their cosine in
       the latent space is at least `least_cosine`, with the item or, if it is longer than 48 words, with
       any of its parts of 32 words. Passages with less than the square of
       `least_cosine` of their squared weights in benchmark words are left out before, since no cosine of
       all their words can be high enough.
    4. Candidates whose surroundings have too few of the item's words for `copied` or `paraphrased` are left
       out. A candidate holds an item if a stretch not much longer than the item has at least `copied` of
       its words in order, or `paraphrased` of them and all of its last words, which stand for the answer.

    The benchmark is searched in blocks of items; what a task keeps of a block does not depend on the
    documents. Words are runs of digits, letters and characters beyond ASCII, with A-Z and Latin letters
    with accents in lower case. Null and empty texts hold nothing, items without words are held by nothing, and items without an id
    are left out. Rows that repeat an id are one document and rows without an id are left out (see
    `texts_of`); other columns are ignored. An empty table gives an empty result, an empty benchmark
    one without contaminated documents.
    """
    texts = texts_of(docs)
    searches = _searches(texts, benchmark, dimensions, least_cosine, copied, paraphrased)
    out = reduce(DataFrame.unionByName, [texts.mapInArrow(search.rows, _OUT) for search in searches])
    if len(searches) == 1:
        return out
    best = F.max_by(F.struct("item_id", "similarity", "start", "end"), F.struct("similarity", -F.col("item_id")))
    return (
        out.groupBy("doc_id")
        .agg(F.max("n_words").alias("n_words"), F.max("contaminated").alias("contaminated"), best.alias("best"), F.sum("n_items").cast("int").alias("n_items"))
        .select("doc_id", "n_words", "contaminated", "best.*", "n_items")
    )
