"""MinHash-style near-duplicate detection with SetSketch registers.

Register i of a set is the largest of floor(1 - log_b h_i(x)) over its elements, h_i exponential: a
truncated minimum on an exponentially spaced scale. Registers of a union are the maxima of the parts'
registers, equal registers are as likely as the sets are similar, and the counts of greater, equal and
lesser registers have a known likelihood (Ertl, "SetSketch: Filling the Gap between MinHash and
HyperLogLog", 2021).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from temporal_tree.llm.anchored import slices
from temporal_tree.llm.batches import LOWER, Words, grams, mix, text_bytes
from temporal_tree.llm.documents import tables, texts_of
from temporal_tree.operators.graph import components
from temporal_tree.sources.scratch import Scratch

BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 1
BANDS, BAND_REGISTERS = 40, 4
REGISTERS = BANDS * BAND_REGISTERS
# a pair goes on to the exact check unless its registers are e^LOG_ODDS times likelier under a lower
# similarity than under the threshold
LOG_ODDS = 14.0
# documents of a side that one task compares with those of another side
CELL = 512

_SKETCH = "doc_id long, n_shingles long, digest long, digest_2 long, registers binary"


def shingle_sets(batch: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct `n`-word shingles of each text, ascending, and the first of each row.
    A text with fewer words is one shingle, one without words has none."""
    raw, bounds = text_bytes(batch.column("text"))
    words = Words(LOWER[raw], bounds)
    hashes = words.hashes()
    counts = words.counts
    value, row = grams(hashes, n), words.doc[: max(0, len(hashes) - n + 1)]
    inside = row == words.doc[n - 1 :] if len(row) else np.zeros(0, bool)
    value, row = value[inside], row[inside]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        whole = np.array([grams(hashes[words.first[r] : words.first[r] + counts[r]], int(counts[r]))[0] for r in short])
        value = np.concatenate([value, mix(whole, 1)])
        row = np.concatenate([row, short])
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    value, row = value[new], row[new]
    return value, np.searchsorted(row, np.arange(len(batch) + 1))


_RANDOM = np.random.default_rng(20210813)
_FACTORS = _RANDOM.integers(0, 2**63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIPS = _RANDOM.integers(0, 2**63, REGISTERS, dtype=np.uint64)


def registers_of(value: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """The registers of consecutive non-empty sets that begin at `heads`."""
    out = np.empty((len(heads), REGISTERS), np.uint16)
    if not len(heads):
        return out
    with np.errstate(over="ignore"):
        for i in range(REGISTERS):
            least = np.minimum.reduceat((value ^ _FLIPS[i]) * _FACTORS[i], heads)
            exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
            out[:, i] = np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)) + TOP // 2, 0, TOP)
    return out


def _sketches(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                value, first = shingle_sets(batch, n)
                size = np.diff(first)
                full = np.flatnonzero(size)
                registers = registers_of(value, first[full])
                with np.errstate(over="ignore"):
                    sums = [np.zeros(len(batch), np.uint64) for _ in range(2)]
                    for k, total in enumerate(sums):
                        if len(full):
                            total[full] = np.add.reduceat(mix(value, k + 2), first[full])
                rows: list[bytes | None] = [None] * len(batch)
                for at, row in enumerate(full.tolist()):
                    rows[row] = registers[at].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"), pa.array(size, pa.int64()),
                        pa.array(sums[0].astype(np.int64)), pa.array(sums[1].astype(np.int64)), pa.array(rows, pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "digest", "digest_2", "registers"],
                )

    return run


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                value, first = shingle_sets(batch, n)
                rows = [value[a:b].tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.binary())], ["doc_id", "shingles"])

    return run


def _order_probability(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)


def log_likelihood(more: np.ndarray, less: np.ndarray, u: np.ndarray, similarity: np.ndarray) -> np.ndarray:
    """Of a similarity, given in how many registers the first set's is greater and less; `u` is the
    first set's part of the sum of both sizes."""
    v = 1 - u
    p = np.maximum(_order_probability(u - v * similarity), 1e-12)
    q = np.maximum(_order_probability(v - u * similarity), 1e-12)
    same = np.maximum(1 - p - q, 1e-12)
    return more * np.log(p) + less * np.log(q) + (REGISTERS - more - less) * np.log(same)


def _plausible(threshold: float):
    grid = np.linspace(0, threshold, 76)[None, :]

    @F.pandas_udf("boolean")
    def plausible(a: pd.Series, b: pd.Series, n_a: pd.Series, n_b: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype=bool)
        x = np.frombuffer(b"".join(a), np.uint16).reshape(-1, REGISTERS)
        y = np.frombuffer(b"".join(b), np.uint16).reshape(-1, REGISTERS)
        sizes = n_a.to_numpy(float), n_b.to_numpy(float)
        u = (sizes[0] / (sizes[0] + sizes[1]))[:, None]
        more, less = ((x > y).sum(1))[:, None], ((x < y).sum(1))[:, None]
        # sets whose sizes are further apart cannot be that similar
        fits = np.minimum(*sizes) >= threshold * np.maximum(*sizes)
        chances = log_likelihood(more, less, u, grid)
        return pd.Series(fits & (chances.max(1) - chances[:, -1] <= LOG_ODDS))

    return plausible


def _overlap():
    @F.pandas_udf("struct<both:long,either:long>")
    def overlap(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        """Sizes of the intersection and the union of two full sets."""
        both, either = [], []
        for x, y in zip(a, b, strict=True):
            p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            n = len(np.intersect1d(p, q, assume_unique=True))
            both.append(n)
            either.append(len(p) + len(q) - n)
        return pd.DataFrame({"both": both, "either": either}, dtype="int64")

    return overlap


class _Comparison:
    """Exact comparison of documents that share a bucket with another one."""

    def __init__(self, sketches: DataFrame, sets: DataFrame, percent: int, scratch: Scratch):
        self.sketches, self.sets, self.percent, self.scratch = sketches, sets, percent, scratch

    def overlaps(self, pairs: DataFrame) -> DataFrame:
        """Pairs (`a`, `b`) with `both` and `either`, from their full sets."""
        side = {n: self.sets.select(F.col("doc_id").alias(n), F.col("shingles").alias(f"s_{n}")) for n in "ab"}
        return (
            pairs.join(side["b"], "b").join(side["a"], "a").select("a", "b", _overlap()("s_a", "s_b").alias("o")).select("a", "b", "o.*")
        )

    def links(self, pairs: DataFrame) -> DataFrame:
        """Of distinct pairs those whose sets are similar enough: registers rule out most others."""

        def side(name: str) -> DataFrame:
            return self.sketches.select(
                F.col("doc_id").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("registers").alias(f"r_{name}")
            )

        likely = self.scratch.save(
            pairs.join(side("a"), "a")
            .join(side("b"), "b")
            .where(_plausible(self.percent / 100)("r_a", "r_b", "n_a", "n_b"))
            .select("a", "b"),
            "likely",
        )
        enough = 100 * F.col("both") >= self.percent * F.col("either")
        return self.scratch.save(self.overlaps(likely).where(enough).select("a", "b"), "links")

    def components(self, links: DataFrame) -> DataFrame:
        edges = links.select(F.col("a").alias("parent_account_id"), F.col("b").alias("child_account_id"))
        joined = components(edges, scratch=self.scratch)
        return self.scratch.save(joined.select(F.col("account_id").alias("doc_id"), F.col("component_id").alias("component")), "components")


def _pair(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _links_in_cells(found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All links between documents that are outside and documents of other components in their cluster.

    A cluster of over `CELL` documents is cut into a grid: outside documents in rows, all in columns.
    Smaller clusters share cells. A cell counts the intersections of its sets by an index of their
    shingles and gives only links, so that pairs which are none, of which a cluster may have many,
    are never rows.
    """
    sizes = found.groupBy("cluster").agg(F.count("doc_id").alias("n"), F.sum("outside").alias("m"))
    small = F.ceil(sizes.agg(F.sum("n")).first()[0] / F.lit(CELL))
    sizes = sizes.select(
        "cluster",
        F.when(F.col("n") > CELL, F.col("cluster")).otherwise(-1 - F.pmod(F.xxhash64("cluster"), small)).alias("cell"),
        F.when(F.col("n") > CELL, F.ceil(F.col("m") / CELL)).otherwise(1).alias("rows"),
        F.when(F.col("n") > CELL, F.ceil(F.col("n") / CELL)).otherwise(1).alias("columns"),
    )
    placed = found.join(sizes, "cluster").join(sets, "doc_id")
    key = ["cell", "row", "column"]

    def side(df: DataFrame, own: str, other: str) -> DataFrame:
        bands = {"row": "rows", "column": "columns"}
        return df.select(
            *[F.col(c).alias(c) for c in ("cell", "doc_id", "component", "shingles")],
            F.pmod(F.xxhash64("doc_id"), F.col(bands[own])).alias(own),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col(bands[other]) - 1)).alias(other),
        ).groupBy(*key)

    def meet(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        pairs: list[np.ndarray] = []
        if len(x) and len(y):
            others = [np.frombuffer(v, np.uint64) for v in y["shingles"]]
            sizes_ = np.array([len(v) for v in others])
            flat, owner = np.concatenate(others), np.repeat(np.arange(len(others)), sizes_)
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], owner[order]
            component, ids = y["component"].to_numpy(), y["doc_id"].to_numpy()
            for doc, own, raw in zip(x["doc_id"], x["component"], x["shingles"], strict=True):
                values = np.frombuffer(raw, np.uint64)
                lo, n = np.searchsorted(flat, values), np.searchsorted(flat, values, side="right")
                n -= lo
                at = np.arange(n.sum()) + np.repeat(lo - (np.cumsum(n) - n), n)
                both = np.bincount(owner[at], minlength=len(others))
                near = np.flatnonzero((100 * both >= percent * (len(values) + sizes_ - both)) & (component != own))
                pairs += [np.array([min(doc, ids[k]), max(doc, ids[k])]) for k in near]
        return pd.DataFrame(np.array(pairs, np.int64).reshape(-1, 2), columns=["a", "b"])

    outside = side(placed.where("outside = 1"), "row", "column")
    return outside.cogroup(side(placed, "column", "row")).applyInPandas(meet, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, *, shingle_words: int = 5, percent: int = 75) -> DataFrame:
    """`doc_id`, `n_shingles`, `component_id`, `kept` for every document.

    Documents are linked if the distinct shingles of `shingle_words` words that both have are at least
    `percent` of those that either has. `component_id` is the least id that links lead to, and the
    document with that id is kept.

    1. Equal sets are one class, found by grouping 128-bit digests; only the least document of each
       goes on, so copies never become pairs.
    2. Bands of four registers are bucket keys. A pair at 75 % misses all 40 bands with probability
       2.5e-7.
    3. In each bucket every document is paired with the least one. Pairs that are plausible by their
       registers' likelihood are confirmed on full sets.
    4. Links give components. Documents that share buckets across components, as heavily edited copies
       or those around a common passage do, are compared in cells of bounded size, which give links only. So no link is
       lost, and members of one component, as in a bucket full of near copies, are never paired.

    Words are runs of anything but space, tab and line ends, with A-Z in lower case. A document with
    fewer words is one shingle; null, empty and blank texts have none and are linked with nothing.
    Rows that repeat an id are one document and rows without an id are left out (see `texts_of`);
    other columns are ignored. An empty table gives an empty result.
    """
    scratch = tables(docs.sparkSession)
    texts = texts_of(docs)
    sketches = scratch.save(texts.mapInArrow(_sketches(shingle_words), _SKETCH), "sketches")
    classes = scratch.save(
        sketches.where("n_shingles > 0").groupBy("digest", "digest_2", "n_shingles").agg(F.min("doc_id").alias("least")), "classes"
    )
    leaders = sketches.join(classes.select(F.col("least").alias("doc_id")), "doc_id").select("doc_id", "n_shingles", "registers")
    band = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda i: F.xxhash64(i, F.substr("registers", i * (2 * BAND_REGISTERS) + 1, F.lit(2 * BAND_REGISTERS))),
    )
    entries = scratch.save(leaders.select("doc_id", F.explode(band).alias("bucket")), "bands")
    centers = entries.groupBy("bucket").agg(F.min("doc_id").alias("center"), F.count("doc_id").alias("n")).where("n > 1").select("bucket", "center")
    placed = scratch.save(entries.join(centers, "bucket"), "buckets")
    needed = placed.select("doc_id").distinct()
    sets = scratch.save(texts.join(needed, "doc_id").mapInArrow(_sets(shingle_words), "doc_id long, shingles binary"), "sets")
    compare = _Comparison(sketches, sets, percent, scratch)
    star = placed.where("doc_id > center").select(*_pair("center", "doc_id")).distinct()
    links = compare.links(scratch.save(star, "star"))
    parts = compare.components(links)

    # buckets with members of several components, and the component most members are in
    inside = placed.join(parts, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    several = (
        inside.groupBy("bucket", "component")
        .agg(F.count("doc_id").alias("n"))
        .groupBy("bucket")
        .agg(F.count("component").alias("parts"), F.max_by("component", F.struct("n", "component")).alias("main"))
        .where("parts > 1")
        .drop("parts")
    )
    members = scratch.save(inside.join(several, "bucket"), "mixed")
    if not members.isEmpty():
        # a document counts as outside if it is so in any of its buckets
        found = members.groupBy("doc_id").agg(
            F.max("component").alias("component"), F.max((F.col("component") != F.col("main")).cast("int")).alias("outside")
        )
        clusters = compare.components(members.select(*_pair("center", "doc_id")).distinct()).withColumnRenamed("component", "cluster")
        found = scratch.save(found.join(clusters, "doc_id"), "outside")
        more = scratch.save(_links_in_cells(found, sets, percent), "links")
        parts = compare.components(links.unionByName(more))
    return (
        sketches.select("doc_id", "n_shingles", "digest", "digest_2")
        .join(classes, ["digest", "digest_2", "n_shingles"], "left")
        .join(parts.withColumnRenamed("doc_id", "least"), "least", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "least", "doc_id").alias("component_id"))
        .withColumn("kept", F.col("doc_id") == F.col("component_id"))
    )
