"""License scans by diagonal voting."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from temporal_tree.llm.anchored import slices
from temporal_tree.llm.batches import LOWER, Words, grams, same_row, text_bytes
from temporal_tree.llm.documents import tables, texts_of

# fixed values: phrases that count as they stand, and their labels
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# fixed values: sentences of public licenses and notices, found also with small changes
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "this work is licensed under the gnu general public license version 3": "gpl-3",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2",
    "licensed under a creative commons attribution sharealike 4 0 international license": "cc-by-sa-4",
    "all rights reserved": "all-rights-reserved",
}
_K = 2
_SLACK = 2  # words by which neighbouring diagonals of one span may differ
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_UPPER = {c: c + 32 for c in range(65, 91)}
_OTHER = np.ones(256, bool)
_OTHER[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_OUT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<label:string,start:int,end:int,similarity:double>>"
)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.translate(_UPPER))


def _hashes(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, Words]:
    words = Words(LOWER[raw], bounds, _OTHER)
    values = grams(words.hashes(), _K)
    return np.where(same_row(words.doc, _K), values, 0).astype(np.int64), words


def _gram_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document the hashes of all `_K` consecutive words, in order."""
    for whole in batches:
        for batch in slices(whole):
            values, words = _hashes(*text_bytes(batch.column("text")))
            n = np.maximum(words.counts - _K + 1, 0)
            first = np.repeat(words.first[:-1] - (np.cumsum(n) - n), n)
            offsets = np.append(0, np.cumsum(n)).astype(np.int32)
            flat = values[np.arange(len(first)) + first] if len(first) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["doc_id", "grams"]
            )


def _template_rows(templates: list[str]) -> list[tuple[int, int, int]]:
    rows = []
    for number, text in enumerate(templates):
        raw = np.frombuffer(text.encode(), np.uint8)
        values, _ = _hashes(raw, np.array([0, len(raw)]))
        rows += [(int(v), number, at) for at, v in enumerate(values)]
    return rows


def common_words(a: list[str], b: list[str]) -> int:
    """The length of the longest common subsequence, with a bit per word of `a`."""
    places: dict[str, int] = {}
    for i, w in enumerate(a):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        hit = row & places.get(w, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def least_votes(n: int, least: float) -> int:
    """The fewest grams of a notice of `n` words, at least 1, that stand unbroken in a span with a similarity
    of `least`: a changed word breaks `_K`, an added one `_K - 1`, one that the text's end cuts off 1."""
    broken = [
        _K * changed + (_K - 1) * added + cut
        for changed in range(n)
        for cut in range(n - changed)
        for added in range(2 * n + 1)
        if 2 * (n - changed - cut) >= least * (2 * n - cut + added) - 1e-9
    ]
    return max(1, n - _K + 1 - max(broken, default=0))


def similar_spans(notice: list[str], words: list[str], start: int, end: int, least: float) -> list[tuple[int, int, float]]:
    """The span if it is similar enough; else what is, of its stretches of the notice's length, the most similar
    first: words beside a notice that look like parts of it make a span longer."""
    n, end = len(notice), min(end, len(words))

    def similarity(a: int, b: int) -> float:
        return 2 * common_words(notice, words[a:b]) / (n + b - a)

    whole = similarity(start, end)
    if whole >= least:
        return [(start, end, whole)]
    found: list[tuple[int, int, float]] = []
    inside = [(a, a + n, similarity(a, a + n)) for a in range(start, end - n + 1)]
    for a, b, value in sorted((w for w in inside if w[2] >= least), key=lambda w: (-w[2], w[0])):
        if all(b <= c or d <= a for c, d, _ in found):
            found.append((a, b, value))
    return found


def _verify(phrases: list[tuple[list[str], str]], notices: list[tuple[list[str], str]], least: float):
    def one(text: str, places: list[dict], spans: list[dict]) -> tuple:
        if not places and not spans:
            return 0, None, None, "", "", 0.0, []
        words = words_of(text)
        starts, labels, score, found = [], set(), 0.0, []
        for p in places:
            phrase, label = phrases[p["template"]]
            if words[p["start"] : p["start"] + len(phrase)] == phrase:
                starts.append(p["start"])
                labels.add(label)
                score = 1.0
        base = ",".join(sorted(labels))
        for s in spans:
            notice, label = notices[s["template"] - len(phrases)]
            for start, end, similarity in similar_spans(notice, words, max(0, s["start"]), s["end"], least):
                labels.add(label)
                score = max(score, similarity)
                found.append({"label": label, "start": start, "end": end, "similarity": similarity})
        return len(starts), min(starts, default=None), max(starts, default=None), base, ",".join(sorted(labels)), score, found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("similarity", pa.float64())]))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), kind]
        for whole in batches:
            for batch in slices(whole):
                raw, bounds = text_bytes(batch.column("text"))
                counts = Words(LOWER[raw], bounds, _OTHER).counts
                rows = [
                    one(t.as_py(), p or [], s or [])
                    for t, p, s in zip(batch.column("text"), batch.column("places").to_pylist(), batch.column("spans").to_pylist(), strict=True)
                ]
                columns = list(zip(*rows, strict=True)) if rows else [[]] * len(types)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(counts, pa.int64()), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                    ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"],
                )

    return run


def scan_licenses(docs: DataFrame, *, least_similarity: float = 0.8) -> DataFrame:
    """Per document `n_words`, places of the base phrases (`n_base`, `first_word`, `last_word`,
    `base_labels`), all `labels`, the best `score` (similarity of a span, 1 for a base phrase) and the
    verified `spans`.

    The hashes of all rolling two words are joined to their places in the templates, which are a
    constant of this module. A hit votes for the diagonal on which a template would begin. A phrase
    stands where all its hashes vote for one diagonal; diagonals of a notice at most two words apart
    are one span, which is a candidate from as many votes on as `least_similarity` leaves (see `least_votes`). All candidates are verified on the
    words themselves: phrases exactly, spans by twice their longest common subsequence over both lengths.

    Words are runs of digits, a-z and characters beyond ASCII, with A-Z in lower case. Null and empty
    texts have no words and no labels. Rows that repeat an id are one document and rows without an id
    are left out (see `texts_of`); other columns are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = tables(spark)
    texts = texts_of(docs)
    phrases = [(p.split(), label) for p, label in PHRASES.items()]
    notices = [(p.split(), label) for p, label in NOTICES.items()]
    sizes = [len(w) - _K + 1 for w, _ in phrases + notices]
    templates = spark.createDataFrame(_template_rows([*PHRASES, *NOTICES]), "gram long, template int, place int")
    needed = F.element_at(F.array(*[F.lit(n) for n in sizes]), F.col("template") + 1)
    enough = F.element_at(F.array(*[F.lit(least_votes(n + _K - 1, least_similarity)) for n in sizes]), F.col("template") + 1)
    votes = (
        texts.mapInArrow(_gram_rows, "doc_id long, grams array<long>")
        .select("doc_id", F.posexplode("grams").alias("pos", "gram"))
        .join(F.broadcast(templates), "gram")
        .groupBy("doc_id", "template", (F.col("pos") - F.col("place")).alias("diagonal"))
        .agg(F.count(F.lit(1)).alias("votes"))
    )
    in_order = Window.partitionBy("doc_id", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(in_order)
    spans = (
        votes.withColumn("head", F.when(apart <= _SLACK, 0).otherwise(1))
        .withColumn("span", F.sum("head").over(in_order))
        .groupBy("doc_id", "template", "span")
        .agg(
            F.min("diagonal").alias("start"),
            (F.max("diagonal") + F.max(needed) + _K - 1).alias("end"),
            F.sum("votes").alias("votes"),
            F.max(needed).alias("needed"),
            F.collect_list(F.when(F.col("votes") >= needed, F.col("diagonal"))).alias("whole"),
        )
    )
    phrase = F.col("template") < len(phrases)
    candidates = scratch.save(
        spans.where(F.when(phrase, F.size("whole") > 0).otherwise(F.col("votes") >= enough))
        .groupBy("doc_id")
        .agg(
            F.flatten(
                F.collect_list(F.when(phrase, F.transform("whole", lambda d: F.struct(F.col("template"), d.cast("int").alias("start")))))
            ).alias("places"),
            F.collect_list(F.when(~phrase, F.struct("template", F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end")))).alias("spans"),
        ),
        "candidates",
    )
    return texts.join(candidates, "doc_id", "left").select("doc_id", "text", "places", "spans").mapInArrow(
        _verify(phrases, notices, least_similarity), _OUT
    )
