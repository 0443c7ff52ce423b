"""Toxic passages as maximal scoring segments of token log-odds."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from temporal_tree.llm.anchored import slices
from temporal_tree.llm.documents import tables, texts_of

_WORD = re.compile(r"[^\W\d_]+")
_HEAD = 4
_PREFIXES = (4, 5, 6)
_SCORED = "doc_id long, n_tokens long, n_passages long, passages array<struct<start:int,end:int,bits:double>>, statistic double"


def tokens(text: str) -> list[str]:
    """Runs of letters in lower case."""
    return _WORD.findall(text.lower())


def parts(token: str) -> list[str]:
    """What a token is looked up by: itself, and beginnings, which inflected forms share."""
    return [token, *(f"{token[:n]}-" for n in _PREFIXES if len(token) > n)]


def maximal_segments(places: list[int], scores: list[float], gap: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (Ruzzo and Tompa, 1999) as (first place, last place, score), where
    the given places have positive scores and every other place has the score `gap` < 0. One pass:
    segments are merged only with those that they reach back to."""
    stack: list[tuple[int, int, float, float, int]] = []  # first, last, sum before, sum after, reach
    total, last = 0.0, -1
    for place, score in zip(places, scores, strict=True):
        total += (place - last - 1) * gap
        last = place
        first, left = place, total
        total += score
        right = total
        j = len(stack) - 1
        while True:
            # the nearest segment to the left with a lesser sum before it
            while j >= 0 and stack[j][2] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= right:
                break
            first, left = stack[j][0], stack[j][2]
            del stack[j:]
            j = len(stack) - 1
        stack.append((first, place, left, right, j))
    return [(a, b, right - left) for a, b, left, right, _ in stack]


@dataclass
class Model:
    """Log-odds of the tokens that tell toxic texts, and how great a passage's score may be by chance."""

    odds: dict[str, float] = field(default_factory=dict)
    gap: float = -0.02
    decay: float = 1.0  # lambda: the score's scale among clean texts
    rate: float = 0.01  # K: by which the expected number of passages grows with a text's length
    slope: float = 1.0
    intercept: float = -5.0

    def __post_init__(self):
        self.heads = {t[:_HEAD] for t in self.odds}

    def segments(self, text: str) -> tuple[int, int, float, list[tuple[int, int, float]]]:
        """The numbers of tokens and of those with odds, the sum of their odds, and all maximal scoring
        segments."""
        words = tokens(text)
        heads, odds = self.heads, self.odds
        places, scores, met = [], [], {}
        for place, word in enumerate(words):
            if word[:_HEAD] in heads:
                best = met.get(word)
                if best is None:
                    best = met[word] = max(odds.get(p, 0.0) for p in parts(word))
                if best > 0:
                    places.append(place)
                    scores.append(best)
        return len(words), len(places), sum(scores), maximal_segments(places, scores, self.gap)

    def passages(self, text: str, most_expected: float = 0.05) -> tuple[int, list[tuple[int, int, float]], float]:
        """The number of tokens, all passages of which so high a score is expected at most so often in
        a clean text of this length, with their scores beyond chance, and the sum of those."""
        n, _, _, segments = self.segments(text)
        found, total = [], 0.0
        for first, last, score in segments:
            beyond = self.decay * score - math.log(max(self.rate * n, 1e-9))
            if beyond >= -math.log(most_expected):
                found.append((first, last + 1, beyond))
                total += beyond
        return n, found, total

    def probability(self, statistic: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * statistic + self.intercept, -40, 40)))


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each class that have a token, and its occurrences in them, summed over the batch."""
    for batch in batches:
        counts, places = (Counter(), Counter()), (Counter(), Counter())
        for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist(), strict=True):
            words = tokens(text.as_py())
            counts[toxic].update({p for w in set(words) for p in parts(w)})
            for w, k in Counter(words).items():
                for p in parts(w):
                    places[toxic][p] += k
        names = list(counts[0] | counts[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *(pa.array([c[t] for t in names], pa.int64()) for c in (*counts, *places))],
            ["token", "clean", "toxic", "clean_places", "toxic_places"],
        )


def log_odds(counts: DataFrame, prior: float, floor: float, least_z: float, least_odds: float, most_tokens: int) -> DataFrame:
    """Tokens that significantly more toxic documents have, with the odds of their occurrences, both under
    a Dirichlet prior of `prior` of the tokens' overall counts, at least `floor` (Monroe et al.,
    "Fightin' Words", 2008). Significance is of documents: one that repeats a word is one witness."""
    columns = ("clean", "toxic", "clean_places", "toxic_places")
    totals = counts.agg(*(F.sum(c).alias(f"all_{c}") for c in columns))

    def delta(clean: str, toxic: str):
        a = F.greatest(F.lit(floor), F.lit(prior) * (F.col(clean) + F.col(toxic)))
        whole = F.lit(prior) * (F.col(f"all_{clean}") + F.col(f"all_{toxic}")) + floor

        def odds(count: str):
            return F.log((F.col(count) + a) / (F.col(f"all_{count}") + whole - F.col(count) - a))

        return odds(toxic) - odds(clean), F.sqrt(1 / (F.col(toxic) + a) + 1 / (F.col(clean) + a))

    (of_documents, spread), (of_places, _) = delta("clean", "toxic"), delta("clean_places", "toxic_places")
    return (
        counts.crossJoin(F.broadcast(totals))  # one row of totals
        .select("token", of_places.alias("odds"), of_documents.alias("document_odds"), (of_documents / spread).alias("z"))
        .where((F.col("z") >= least_z) & (F.col("document_odds") >= least_odds) & (F.col("odds") > 0))
        .orderBy(F.desc("z"), "token")
        .limit(most_tokens)
        .select("token", "odds", "z")
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    most_rows: int = 20_000,
    prior: float = 0.01,
    floor: float = 0.5,
    least_z: float = 2.5,
    least_odds: float = 2.0,
    most_tokens: int = 50_000,
) -> Model:
    """A model from the labelled rows with the `most_rows` least hashes of their ids."""
    scratch = tables(docs.sparkSession)
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id is not null and toxic in (0, 1)")
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most_rows)
    )
    train = scratch.save(texts_of(docs).join(F.broadcast(chosen), "doc_id"), "train")
    counts = (
        train.mapInArrow(_token_counts, "token string, clean long, toxic long, clean_places long, toxic_places long")
        .groupBy("token").agg(*(F.sum(c).alias(c) for c in ("clean", "toxic", "clean_places", "toxic_places")))
    )
    rows = log_odds(scratch.save(counts, "counts"), prior, floor, least_z, least_odds, most_tokens).collect()
    if not rows:
        return Model()
    model = Model(odds={r["token"]: float(r["odds"]) for r in rows})
    _calibrate(model, train)
    return model


def _calibrate(model: Model, train: DataFrame) -> None:
    """Sets the gap, the extreme-value constants and the logistic curve from the training rows."""
    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [model.segments(t.as_py())[:3] for t in batch.column("text")]
            n, k, total = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(n, pa.int64()), pa.array(k, pa.int64()), pa.array(total, pa.float64())],
                ["toxic", "n", "k", "total"],
            )

    by_class = {
        r["toxic"]: r
        for r in train.mapInArrow(hits, "toxic int, n long, k long, total double")
        .groupBy("toxic").agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.sum("total").alias("total")).collect()
    }
    if 0 not in by_class or 1 not in by_class:
        return
    toxic, clean = by_class[1], by_class[0]
    density = (toxic["k"] + 1) / (toxic["n"] + 2)
    stray = (clean["k"] + 0.5) / (clean["n"] + 1)
    # what a token without odds says against a toxic passage
    model.gap = min(-1e-4, math.log((1 - density) / (1 - min(stray, density / 2))))
    score = toxic["total"] / max(1, toxic["k"])
    model.decay = _decay(score, stray, model.gap)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, weight = [], []
            for text in batch.column("text"):
                size, _, _, segments = model.segments(text.as_py())
                n.append(size)
                weight.append(size * math.exp(-model.decay * max((s for _, _, s in segments), default=0.0)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(n, pa.int64()), pa.array(weight, pa.float64())], ["toxic", "n", "weight"]
            )

    seen = train.mapInArrow(best, "toxic int, n long, weight double").where("toxic = 0").agg(F.count("n").alias("rows"), F.sum("weight").alias("weight")).first()
    # maximum likelihood of K in P(max <= x) = exp(-K n e^(-lambda x)) over the clean texts
    if seen["weight"]:
        model.rate = seen["rows"] / seen["weight"]
    values = (
        train.select("doc_id", "text", "toxic")
        .mapInArrow(_score(model, keep="toxic"), _SCORED + ", toxic int")
        .select("statistic", "toxic").toPandas()
    )
    model.slope, model.intercept = _logistic(values["statistic"].to_numpy(), values["toxic"].to_numpy())


def _decay(score: float, stray: float, gap: float) -> float:
    """The positive root of E[e^(lambda s)] = 1 among clean tokens (Karlin and Altschul, 1990)."""
    low, high = 1e-6, 50.0 / max(score, 1e-6)
    for _ in range(100):
        mid = (low + high) / 2
        if stray * math.exp(mid * score) + (1 - stray) * math.exp(mid * gap) < 1:
            low = mid
        else:
            high = mid
    return low


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt's curve: smoothed targets keep it finite where the classes are apart."""
    positive, negative = y.sum(), (1 - y).sum()
    target = np.where(y == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    scale = max(float(np.abs(x).max(initial=0)), 1.0)
    design = np.column_stack([x / scale, np.ones(len(x))])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, design.T @ (target - p) - 1e-3 * w)
        w += np.clip(step, -5, 5)
    return float(w[0] / scale), float(w[1])


def _score(model: Model, keep: str | None = None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [model.passages(t.as_py()) for t in batch.column("text")]
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("bits", pa.float64())]))
            arrays = [
                batch.column("doc_id"),
                pa.array([n for n, _, _ in rows], pa.int64()),
                pa.array([len(f) for _, f, _ in rows], pa.int64()),
                pa.array([[{"start": a, "end": b, "bits": s} for a, b, s in f] for _, f, _ in rows], kind),
                pa.array([s for _, _, s in rows], pa.float64()),
            ]
            names = ["doc_id", "n_tokens", "n_passages", "passages", "statistic"]
            if keep:
                arrays.append(batch.column(keep))
                names.append(keep)
            yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """Per document `n_tokens`, its significant toxic `passages` (in tokens, with how far beyond chance
    they are, in nats), `statistic` (their sum), and `score`, the probability of label 1.

    Null and empty texts have no passages and the score of a clean text. Rows that repeat an id are
    one document and rows without an id are left out (see `texts_of`); other columns are ignored.
    """
    found = texts_of(docs).select("doc_id", "text").mapInArrow(_score(model), _SCORED)
    line = F.col("statistic") * model.slope + model.intercept
    return found.withColumn("score", 1 / (1 + F.exp(-line)))


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose text does not score 0.5 or more, with all their columns: one pass, and no join.
    Every row is judged by itself, whatever its id. A null text counts as an empty one."""

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, column=text_col):
                lines = [model.passages(t.as_py() or "")[2] * model.slope + model.intercept for t in batch.column(text_col)]
                yield batch.filter(pa.array([not 1 / (1 + math.exp(-max(line, -700.0))) >= 0.5 for line in lines], pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)


def held_out(doc_id="doc_id"):
    """The fifth of the documents whose labels are not learned from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def toxicity(docs: DataFrame, labels: DataFrame, **fitting) -> DataFrame:
    """`score_toxicity` of all documents by a model of the labels that are not held out, with `held_out`
    and `predicted` (1 if the score is at least 0.5).

    A token's odds come from class-conditional counts of its occurrences under a Dirichlet prior, for tokens
    and their beginnings, if significantly more toxic documents have it. Every occurrence of such a token
    scores, also a repeated one; all others count slightly against; every
    maximal scoring segment that is beyond what clean texts of the same length show by chance is a
    passage. Without labels of both classes no text is toxic. An empty table gives an empty result.
    """
    model = fit(docs, labels.where(~held_out()), **fitting)
    return (
        score_toxicity(docs, model)
        .withColumn("held_out", held_out())
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    )
