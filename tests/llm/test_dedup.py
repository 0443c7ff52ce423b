from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from temporal_tree.llm import anchored, documents, induced, rlz, setsketch
from temporal_tree.llm.batches import Words, anchors, byte_hashes
from temporal_tree.sources.scratch import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def test_anchors_and_byte_hashes():
    rng = np.random.default_rng(1)
    raw = rng.integers(0, 3, 5000).astype(np.uint8)
    for k in (1, 3, 24):
        hashes = byte_hashes(raw, k)
        strings = [raw[i : i + k].tobytes() for i in range(len(raw) - k + 1)]
        by_string = dict(zip(strings, hashes.tolist(), strict=True))
        assert [by_string[s] for s in strings] == hashes.tolist()
        assert len(set(by_string.values())) == len(by_string)
        upper = hashes >> np.uint64(24)
        assert [i + int(np.argmin(upper[i : i + 9])) for i in range(len(hashes) - 8)] == anchors(hashes, 9).tolist()


def test_words_of_a_batch():
    texts = ["ab  c\n", "", "ç d", "d"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    words = Words(raw, np.cumsum([0, *(len(t.encode()) for t in texts)]))
    got = [raw[a:b].tobytes().decode() for a, b in zip(words.start, words.end, strict=True)]
    assert got == ["ab", "c", "ç", "d", "d"] and words.counts.tolist() == [2, 0, 2, 1]
    assert len(set(words.hashes().tolist())) == 4


def substrings(texts: dict, size: int) -> dict:
    """What should be left, from all windows of all documents."""
    seen, out = set(), {}
    for i in sorted(texts):
        words = WORD.findall(texts[i] or "")
        windows = [tuple(words[j : j + size]) for j in range(len(words) - size + 1)]
        cut = {k for j, w in enumerate(windows) if w in seen for k in range(j, j + size)}
        seen.update(windows)
        out[i] = (len(words), len(cut), " ".join(w for k, w in enumerate(words) if k not in cut))
    return out


def byte_strings(texts: dict, size: int) -> dict:
    seen, out = set(), {}
    for i in sorted(texts):
        raw = (texts[i] or "").encode()
        cut = bytearray(len(raw))
        for j in range(len(raw) - size + 1):
            window = raw[j : j + size]
            if window in seen:
                cut[j : j + size] = b"\1" * size
            seen.add(window)
        runs = len(re.findall(rb"\x01+", cut))
        out[i] = (len(raw), sum(cut), runs, bytes(b for b, c in zip(raw, cut, strict=True) if not c))
    return out


@pytest.mark.parametrize("words", [1, 4, 13])
def test_relative_lempel_ziv(frame, corpus, words):
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in rlz.substring_dedup(frame(corpus, True), words=words).collect()}
    assert got == substrings(corpus, words)


@pytest.mark.parametrize("size", [20, 100])
def test_suffix_dedup(frame, corpus, size):
    rows = induced.suffix_dedup(frame(corpus, True), size=size).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in rows}
    assert got == byte_strings(corpus, size)
    texts = {r["doc_id"]: r["kept_text"] for r in induced.suffix_dedup(frame(corpus), size=size, as_text=True).collect()}
    assert texts == {i: kept.decode("utf-8", "ignore") for i, (_, _, _, kept) in got.items()}


@pytest.mark.parametrize("windows", [anchored.Windows("word", 13, 6, False, hot=40), anchored.Windows("byte", 100, 25, True, hot=40)], ids=["words", "bytes"])
def test_no_group_gathers_a_passage_of_many(spark, scratch, windows):
    """A third of all documents share a passage of 60 words, each in surroundings of its own."""
    rng = random.Random(11)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = []
    for i in range(900):
        own = [f"w{rng.randrange(10**6)}" for _ in range(80)]
        if i % 3 == 0:
            own[40:40] = [passage]
        rows.append((i, " ".join(own)))
    texts = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    marks, _, hot = anchored.live_anchors(texts, windows, scratch)
    assert hot
    groups = anchored.live_segments(texts, marks, windows).where("content is not null").groupBy("key").count()
    assert (groups.agg(F.max("count")).first()[0] or 0) <= 2 * windows.hot
    decide = rlz.factor_spans(13) if windows.unit == "word" else induced.suffix_spans(100, memory=10_000)
    found = anchored.repeated_spans(texts, windows, decide, scratch).collect()
    want = (substrings if windows.unit == "word" else byte_strings)(dict(rows), windows.size)
    removed = {r["doc_id"]: sum(e - s for s, e in anchored.merged(r["spans"])) for r in found}
    assert {i: n for i, n in removed.items() if n} == {i: v[1] for i, v in want.items() if v[1]}


def test_hot_anchors_are_divided(frame, corpus, scratch, monkeypatch):
    """All anchors count as hot, and slices hold one document: the same result."""
    monkeypatch.setattr(anchored, "_SEGMENT_BYTES", 1)
    texts = frame(corpus).selectExpr("doc_id", "coalesce(text, '') AS text")
    for windows, decide, want in (
        (anchored.Windows("word", 13, 6, False), rlz.factor_spans(13, block_seeds=50), substrings(corpus, 13)),
        (anchored.Windows("byte", 100, 25, True), induced.suffix_spans(100, memory=10_000), byte_strings(corpus, 100)),
    ):
        found = anchored.repeated_spans(texts, replace(windows, hot=0), decide, scratch).collect()
        removed = {r["doc_id"]: sum(e - s for s, e in anchored.merged(r["spans"])) for r in found}
        assert {i: n for i, n in removed.items() if n} == {i: w[1] for i, w in want.items() if w[1]}


def test_groups_of_a_shard_are_small():
    """Keys of a shard are settled together up to a megabyte, which induced sorting holds many times over."""
    made = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("content", pa.binary())])
    batches = [pa.RecordBatch.from_pylist([{"key": k, "doc_id": k, "starts": [0], "ends": None, "content": bytes(100_000)}], schema=made) for k in range(40)]
    sizes = []

    def decide(_docs, _starts, contents):
        sizes.append(sum(map(len, contents)))
        return iter(())

    for _ in anchored._shard_rows(decide)(iter(batches)):
        pass
    assert sum(sizes) == 4_000_000 and max(sizes) < 1_300_000


def test_hot_windows_are_exchanged_once(spark, scratch):
    """Windows of hot anchors go to their groups by one exchange, and no table of them is written first."""
    texts = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(30)) + f" x{i}") for i in range(50)], "doc_id long, text string")
    windows = anchored.Windows("word", 13, 6, False, hot=10)
    found = anchored.repeated_spans(texts, windows, rlz.factor_spans(13), scratch)
    assert sum(r["spans"] != [] for r in found.collect()) == 49
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [" in plan and "hot-windows" not in plan


def test_anchors_go_when_they_are_counted(spark, tmp_path, monkeypatch):
    """Their table is as large as the corpus and not read again."""
    monkeypatch.setattr(documents, "Scratch", lambda session: Scratch(session, str(tmp_path)))
    texts = spark.createDataFrame([(i, "a passage of words " * 20) for i in range(4)], "doc_id long, text string")
    scratch = Scratch(spark, str(tmp_path))
    marks, total, _ = anchored.live_anchors(texts, anchored.Windows("byte", 100, 25, True), scratch)
    assert total and marks.count() == 4
    assert [p.name for p in tmp_path.glob("run-*/*")] == ["001-live"]


def test_induced_sorting():
    rng = np.random.default_rng(5)
    for trial in range(120):
        text = rng.integers(0, int(rng.integers(1, 5)), int(rng.integers(1, 200))).astype(np.uint8)
        if trial % 4 == 0:
            text = np.tile(text[: max(1, len(text) // 5)], 5)
        limit = int(rng.choice([3, 9, 100]))
        suffixes, shared = [], []
        for a, b in induced.Induction(text, limit, memory=int(rng.choice([50, 10**7]))).run():
            suffixes += a.tolist()
            shared += b.tolist()
        raw = text.tobytes()
        assert sorted(suffixes) == list(range(len(raw)))
        for x, y, common in zip(suffixes, suffixes[1:], shared[1:], strict=False):
            assert raw[x : x + limit] >= raw[y : y + limit]
            want = next((k for k in range(limit) if raw[x + k : x + k + 1] != raw[y + k : y + k + 1] or y + k >= len(raw)), limit)
            assert common == min(want, len(raw) - x, len(raw) - y)


def near_groups(texts: dict) -> dict:
    sets = {}
    for i, text in texts.items():
        words = WORD.findall((text or "").translate(LOWER))
        sets[i] = {tuple(words[j : j + 5]) for j in range(len(words) - 4)} or ({tuple(words)} if words else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in sets:
        for y in sets:
            if x < y and sets[x] and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]):
                a, b = sorted((root(x), root(y)))
                parent[b] = a
    groups = defaultdict(list)
    for i in sets:
        groups[root(i)].append(i)
    return {i: (len(sets[i]), min(g), i == min(g)) for g in groups.values() for i in g}


def test_near_duplicates(frame, corpus):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in setsketch.near_duplicates(frame(corpus, True)).collect()}
    assert got == near_groups(corpus)


def test_near_duplicates_in_a_chain(frame):
    """A chain of texts of which only neighbours are similar enough is one group."""
    rng = random.Random(3)
    long = [f"v{rng.randrange(9999)}" for _ in range(400)]
    chain = {100 - k: " ".join(long[8 * k : 8 * k + 100]) for k in range(30)}
    got = {r["doc_id"]: r["component_id"] for r in setsketch.near_duplicates(frame(chain)).collect()}
    assert got == {i: g for i, (_, g, _) in near_groups(chain).items()} and set(got.values()) == {71}


def test_register_likelihood_finds_the_similarity():
    rng = np.random.default_rng(2)
    for similarity in (0.1, 0.5, 0.8):
        pool = rng.integers(0, 2**63, 4000, dtype=np.uint64)
        both = int(4000 * similarity)
        only = (4000 - both) // 2
        x, y = pool[: both + only], np.append(pool[:both], pool[both + only :])
        a, b = (setsketch.registers_of(np.sort(v), np.zeros(1, int))[0] for v in (x, y))
        grid = np.linspace(0, 1, 101)[None, :]
        chances = setsketch.log_likelihood(np.array([[(a > b).sum()]]), np.array([[(a < b).sum()]]), np.array([[len(x) / (len(x) + len(y))]]), grid)
        assert abs(grid[0, chances.argmax()] - similarity) < 0.15


@pytest.mark.parametrize("operator", [rlz.substring_dedup, induced.suffix_dedup, setsketch.near_duplicates])
def test_empty_table(frame, operator):
    assert operator(frame({})).collect() == []


def test_kept_hash_of_nothing(frame):
    row = rlz.substring_dedup(frame({1: None})).first()
    assert hashlib.sha256(row["kept_text"].encode()).hexdigest().startswith("e3b0c442")
