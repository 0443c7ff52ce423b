"""Quality rules: an isolation forest over the statistics that rules look at."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from temporal_tree.llm.anchored import slices
from temporal_tree.llm.batches import SPACES, Words, grams, mix, text_bytes
from temporal_tree.llm.documents import tables, texts_of

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_MORE = ("n_lines", "n_upper", "n_letters", "n_marks")
_STATS = "doc_id long, " + ", ".join(f"{c} long" for c in _COUNTS + _MORE)
FEATURES = ("symbols", "dup_lines", "upper", "marks")
MORE_FEATURES = ("word_length", "repeats", "length")
_NODES = "tree int, node int, feature int, cut double, left int, right int, rows int"


def _table(characters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters)] = True
    return out


_SYMBOL = _table(b"#*$%&|<>")
_UPPER = _table(bytes(range(65, 91)))
_LETTER = _UPPER | _table(bytes(range(97, 123)))
_MARK = _table(b"!?|*#$%&<>=+~^_")


def _per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _repeated(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Which (row, value) pairs occur twice or more."""
    with np.errstate(over="ignore"):
        key = mix(value ^ mix(row.astype(np.uint64), 7))
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(key), bool)
    same[1:] = key[order[1:]] == key[order[:-1]]
    out = np.zeros(len(key), bool)
    out[order[same]] = True
    out[order[np.flatnonzero(same) - 1]] = True
    return out


def _duplicate_lines(text: str) -> tuple[int, int]:
    seen, lines, duplicates = set(), 0, 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            lines += 1
            duplicates += line in seen
            seen.add(line)
    return lines, duplicates


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole):
            raw, bounds = text_bytes(batch.column("text"))
            words = Words(raw, bounds)
            hashes = words.hashes()
            n = len(hashes) - 4
            covered = np.zeros(len(hashes) + 1, np.int64)
            if n > 0:
                inside = np.flatnonzero(words.doc[:n] == words.doc[4:])
                again = inside[_repeated(words.doc[inside], grams(hashes, 5)[inside])]
                np.add.at(covered, again, 1)
                np.add.at(covered, again + 5, -1)
            repeat = np.cumsum(covered[:-1]) > 0
            lines = [_duplicate_lines(t.as_py() or "") for t in batch.column("text")]
            columns = {
                "n_words": words.counts,
                "word_chars": _per_row(((raw & 0xC0) != 0x80) & ~SPACES[raw], bounds),
                "n_symbols": _per_row(_SYMBOL[raw], bounds),
                "n_dup_lines": [d for _, d in lines],
                "n_repeat_words": _per_row(repeat, words.first),
                "n_lines": [n for n, _ in lines],
                "n_upper": _per_row(_UPPER[raw], bounds),
                "n_letters": _per_row(_LETTER[raw], bounds),
                "n_marks": _per_row(_MARK[raw], bounds),
            }
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(v, pa.int64()) for v in columns.values())], ["doc_id", *columns]
            )


def rule_statistics(texts: DataFrame) -> DataFrame:
    """Counts of every text, `base_failed`, and the ratios the forest splits on."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    ratios = {
        "symbols": F.col("n_symbols") / words,
        "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "upper": F.col("n_upper") / F.greatest(F.col("n_letters"), F.lit(1)),
        "marks": F.col("n_marks") / words,
        "word_length": F.col("word_chars") / words,
        "repeats": F.col("n_repeat_words") / words,
        "length": F.log(words),
    }
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return texts.mapInArrow(_stats, _STATS).withColumns(ratios | {"base_failed": failed})


def _expected_path(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search among n rows."""
    n = np.asarray(n, float)
    m = np.maximum(n, 2)
    return np.where(n < 2, 0.0, 2 * (np.log(m - 1) + np.euler_gamma) - 2 * (m - 1) / m)


def _grow(rows: pd.DataFrame) -> pd.DataFrame:
    """One isolation tree from its rows: random features, random cuts between their extremes."""
    tree = int(rows["tree"].iloc[0])
    data = rows.sort_values("doc_id").drop(columns=["doc_id", "tree"]).to_numpy(float)
    rng = np.random.default_rng(tree)
    limit = max(1, int(np.ceil(np.log2(max(2, len(data))))))
    nodes: list[list] = []
    open_ = [(np.arange(len(data)), 0, None)]
    while open_:
        held, depth, parent = open_.pop()
        node = len(nodes)
        if parent is not None:
            nodes[parent[0]][parent[1]] = node
        low, high = data[held].min(0), data[held].max(0)
        splittable = np.flatnonzero(high > low)
        if depth == limit or not len(splittable):
            nodes.append([tree, node, -1, 0.0, node, node, len(held)])
            continue
        feature = int(rng.choice(splittable))
        cut = float(rng.uniform(low[feature], high[feature]))
        nodes.append([tree, node, feature, cut, node, node, len(held)])
        below = data[held, feature] <= cut
        open_ += [(held[below], depth + 1, (node, 4)), (held[~below], depth + 1, (node, 5))]
    return pd.DataFrame(nodes, columns=["tree", "node", "feature", "cut", "left", "right", "rows"])


class Forest:
    """The trees as flat arrays; their number and sizes are parameters, not those of the corpus."""

    def __init__(self, nodes: pd.DataFrame, sample: int):
        self.trees = []
        for _, part in nodes.sort_values(["tree", "node"]).groupby("tree"):
            self.trees.append({c: part[c].to_numpy() for c in ("feature", "cut", "left", "right", "rows")})
        self.norm = max(float(_expected_path(np.array(sample))), 1e-9)

    def scores(self, data: np.ndarray) -> np.ndarray:
        """2 ** -(mean path length / expected one): near 1 for rows that few splits isolate."""
        total = np.zeros(len(data))
        at = np.arange(len(data))
        for t in self.trees:
            node, depth = np.zeros(len(data), int), np.zeros(len(data))
            while True:
                feature = t["feature"][node]
                inner = feature >= 0
                if not inner.any():
                    break
                below = data[at, np.maximum(feature, 0)] <= t["cut"][node]
                node = np.where(inner, np.where(below, t["left"][node], t["right"][node]), node)
                depth += inner
            total += depth + _expected_path(t["rows"][node])
        return 2.0 ** -(total / max(1, len(self.trees)) / self.norm)


def fit_forest(stats: DataFrame, trees: int, sample: int, features: Sequence[str] = FEATURES) -> Forest:
    """A forest on a bounded sample: the `trees * sample` rows with the least hashes of their ids."""
    chosen = (
        stats.select("doc_id", *features)
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(trees * sample)
        .withColumn("tree", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(trees)).cast("int"))
    )
    nodes = chosen.groupBy("tree").applyInPandas(_grow, _NODES).toPandas()
    mean_rows = int(nodes[nodes["node"] == 0]["rows"].mean()) if len(nodes) else 0
    return Forest(nodes, mean_rows)


def calibrate(scored: DataFrame, labels: DataFrame, most_good_lost: float) -> float:
    """The score above which documents are rejected: the one that catches most rows of quality 0 while
    it loses at most `most_good_lost` of those of quality 1. Counts of all labelled rows are taken per
    thousandth of the score. Without labels of both kinds nothing is rejected."""
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int")).where("quality in (0, 1)").distinct()
    counted = (
        scored.join(known, "doc_id")
        .groupBy(F.floor(F.col("score") * 1000).cast("int").alias("step"))
        .agg(F.sum(F.col("quality")).alias("good"), F.sum(1 - F.col("quality")).alias("bad"))
        .toPandas()
        .sort_values("step", ascending=False)
    )
    good, bad = counted["good"].sum(), counted["bad"].sum()
    if not good or not bad:
        return 1.0
    lost, caught = counted["good"].cumsum() / good, counted["bad"].cumsum() / bad
    fits = counted[lost <= most_good_lost]
    if fits.empty or not caught[fits.index[-1]]:
        return 1.0
    # of equal catches the highest threshold
    best = caught[fits.index].max()
    return float(fits[caught[fits.index] == best]["step"].max()) / 1000


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    *,
    trees: int = 256,
    sample: int = 64,
    most_good_lost: float = 0.005,
    features: Sequence[str] = FEATURES,
) -> DataFrame:
    """Per document its counts, `base_failed`, the forest's `score` and `kept`.

    The base rules reject texts of fewer than ten words or with over a fifth of their words in
    repeated 5-word windows. An isolation forest over `features`, ratios of the counts (`FEATURES`, and
    `MORE_FEATURES`: letters a word, the share of repeated words, the logarithm of the length), is grown on
    documents that pass them, `trees` groups of about `sample` rows (small ones, so that a cluster of
    bad documents does not hide itself). The
    threshold of its score is calibrated on all rows of `labels` (`doc_id`, `quality`) that pass them.

    Words are runs of anything but space, tab and line ends. Null and empty texts have counts of 0 and
    fail. Labels with nulls are ignored, and contradictory ones count on both sides. Rows that repeat
    an id are one document and rows without an id are left out (see `texts_of`); other columns are
    ignored. An empty table gives an empty result; without labels only the base rules reject.
    """
    scratch = tables(docs.sparkSession)
    stats = scratch.save(rule_statistics(texts_of(docs)), "statistics")
    passing = stats.where(~F.col("base_failed"))
    forest = fit_forest(passing, trees, sample, features)
    bound = docs.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def score(*ratios: pd.Series) -> pd.Series:
        return pd.Series(bound.value.scores(np.column_stack([r.to_numpy(float) for r in ratios])))

    scored = scratch.save(stats.withColumn("score", score(*features)), "scored")
    threshold = calibrate(scored.where(~F.col("base_failed")), labels, most_good_lost)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") < threshold if threshold < 1 else F.lit(True)))
