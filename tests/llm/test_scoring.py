from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from temporal_tree.llm import backoff, histogram_sort, latent, licenses, packing, quality_forest, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def some_words(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    """Words of letters that no suffix of one makes another."""
    return ["w" + f"{rng.randrange(vocabulary):05d}".translate({48 + k: 97 + k for k in range(10)}) for _ in range(n)]


def by_id(df) -> dict:
    rows = df.collect()
    out = {r["doc_id"]: r for r in rows}
    assert len(out) == len(rows)
    return out


# quality


def test_base_rules(frame, corpus):
    got = by_id(quality_forest.quality_rules(frame(corpus, True), frame({}).selectExpr("doc_id", "1 AS quality")))
    assert set(got) == set(corpus)
    for i, text in corpus.items():
        words = WORD.findall(text or "")
        windows = Counter(tuple(words[j : j + 5]) for j in range(len(words) - 4))
        repeated = {k for j in range(len(words) - 4) if windows[tuple(words[j : j + 5])] > 1 for k in range(j, j + 5)}
        lines = [line for line in (text or "").split("\n") if WORD.search(line)]
        row = got[i]
        assert (row["n_words"], row["word_chars"], row["n_symbols"]) == (
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
        )
        assert (row["n_dup_lines"], row["n_repeat_words"]) == (len(lines) - len(set(lines)), len(repeated))
        assert row["base_failed"] == (len(words) < 10 or 100 * len(repeated) > 20 * len(words))
        assert row["kept"] == (not row["base_failed"])  # no labels, so the forest rejects nothing


def test_forest_isolates_what_is_rare(spark, frame):
    rng = random.Random(1)
    texts = {i: " ".join(some_words(rng, 60, 9999)) for i in range(400)}
    bad = {i: " ".join(w + rng.choice("#*%") * 3 for w in some_words(rng, 60, 9999)) for i in range(400, 420)}
    labels = spark.createDataFrame([(i, int(i < 400)) for i in range(0, 420, 2)] + [(7, None), (None, 0)], "doc_id long, quality int")
    got = by_id(quality_forest.quality_rules(frame(texts | bad), labels))
    assert all(got[i]["kept"] for i in texts) and not any(got[i]["kept"] for i in bad)


def test_forest_takes_any_statistics(spark, frame):
    rng = random.Random(2)
    texts = {i: " ".join(some_words(rng, 60, 9999)) for i in range(400)}
    bad = {i: " ".join(w * 7 for w in some_words(rng, 60, 9999)) for i in range(400, 420)}
    labels = spark.createDataFrame([(i, int(i < 400)) for i in range(0, 420, 2)], "doc_id long, quality int")
    features = (*quality_forest.FEATURES, *quality_forest.MORE_FEATURES)
    got = by_id(quality_forest.quality_rules(frame(texts | bad), labels, features=features))
    assert all(got[i]["kept"] for i in texts) and not any(got[i]["kept"] for i in bad)


def test_path_lengths_by_hand():
    nodes = pd.DataFrame(
        [(0, 0, 0, 0.5, 1, 2, 4), (0, 1, -1, 0.0, 1, 1, 3), (0, 2, -1, 0.0, 2, 2, 1)],
        columns=["tree", "node", "feature", "cut", "left", "right", "rows"],
    )
    got = quality_forest.Forest(nodes, 4).scores(np.array([[0.0], [1.0]]))

    def c(n):
        return 2 * (math.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n

    assert np.allclose(got, [2 ** -((1 + c(3)) / c(4)), 2 ** -(1 / c(4))])


# toxicity


def test_maximal_segments():
    """Against the definition: segments found by taking the best one and recursing on both sides."""

    def recursive(scores, lo, hi):
        best = max(((sum(scores[a:b]), a - b, a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=(0,))
        if best[0] <= 0:
            return []
        _, _, a, b = best
        return recursive(scores, lo, a) + [(a, b - 1)] + recursive(scores, b, hi)

    rng = random.Random(4)
    for _ in range(200):
        n = rng.randrange(0, 14)
        places = sorted(rng.sample(range(n), rng.randrange(0, n + 1)))
        gap = -rng.choice([0.3, 1.1, 2.3])
        scores = [gap] * n
        for p in places:
            scores[p] = rng.random() * 3 + 0.01
        got = toxicity.maximal_segments(places, [scores[p] for p in places], gap)
        assert [(a, b) for a, b, _ in got] == recursive(scores, 0, n)
        assert all(abs(s - sum(scores[a : b + 1])) < 1e-9 for a, b, s in got)


def test_toxicity_on_held_out_rows(spark, frame):
    rng = random.Random(2)
    texts, toxic = {}, {}
    for i in range(600):
        words = some_words(rng, 80, 3000)
        toxic[i] = int(i % 6 == 0)
        for _ in range(3 * toxic[i]):
            words[rng.randrange(80)] = rng.choice(["foulword", "nastyone", "uglyterm"]) + rng.choice(["", "s", "ly"])
        texts[i] = " ".join(words)
    texts |= {1000: None, 1001: "", 1002: "foulword nastyone, UGLYTERM!"}
    labels = spark.createDataFrame([*toxic.items(), (3, None), (None, 1)], "doc_id long, toxic int")
    got = by_id(toxicity.toxicity(frame(texts, True), labels))
    assert set(got) == set(texts)
    for i, row in got.items():
        assert row["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert row["predicted"] == int(row["score"] >= 0.5) and 0 <= row["score"] <= 1
    assert sum(got[i]["predicted"] != t for i, t in toxic.items()) <= 3
    assert [got[i]["predicted"] for i in (1000, 1001, 1002)] == [0, 0, 1]
    assert got[1002]["passages"][0]["start"] == 0
    none = by_id(toxicity.toxicity(frame(texts), labels.where("toxic = 0")))
    assert not any(r["predicted"] for r in none.values())


def test_repeated_words_score_again():
    model = toxicity.Model(odds={"foul": 3.0, "nasty": 3.0, "ugly": 3.0}, gap=-0.3, decay=1.0, rate=0.01)
    passage = ["foul", "nasty", "ugly"]
    two = ["w"] * 50 + passage + ["w"] * 200 + passage + ["w"] * 50
    assert [(a, b) for a, b, _ in model.passages(" ".join(two))[1]] == [(50, 53), (253, 256)]
    # strays far apart, then the passage, in a very long text
    strays = [w for p in passage for w in [p] + ["w"] * 10_000]
    long = toxicity.Model(odds=model.odds, gap=-0.3, decay=1.0, rate=1e-4)
    assert [(a, b) for a, b, _ in long.passages(" ".join(strays + passage + ["w"] * 100))[1]] == [(30_003, 30_006)]
    # one word again and again is more than one hit
    assert [(a, b) for a, b, _ in model.passages(" ".join(["w"] * 50 + ["foul"] * 4 + ["w"] * 50))[1]] == [(50, 54)]


# language model


def test_backoff(frame, corpus):
    got = by_id(backoff.stupid_backoff(frame(corpus, True)))
    words = {i: WORD.findall((t or "").translate(LOWER)) for i, t in corpus.items()}
    ones, twos = Counter(), Counter()
    for w in words.values():
        ones.update([None, *w] if w else [])
        twos.update(zip([None, *w], w))
    total = sum(n for w, n in ones.items() if w is not None)
    assert set(got) == set(corpus)
    for i, w in words.items():
        own, own_twos, score = Counter([None, *w]), Counter(zip([None, *w], w)), 0.0
        for a, b in zip([None, *w], w):
            pair = twos[a, b] - own_twos[a, b]
            score += math.log(pair / (ones[a] - own[a]) if pair else 0.4 * max(ones[b] - own[b], 0.5) / total)
        assert got[i]["n_words"] == len(w) and math.isclose(got[i]["log_score"], score, rel_tol=1e-9, abs_tol=1e-9)
        assert (got[i]["mean_log_score"] is None) == (not w)


def test_a_slice_asks_once_for_a_pair():
    """Documents of a slice share what they ask, a frequent pair costs a number for all of them; answers come in order."""
    batch = pa.RecordBatch.from_pydict({"doc_id": [7, 8, 9], "text": ["a b a b", " ", "A b c"]})
    (made,) = backoff._slice_rows([batch])
    asked = [r for turn in range(3) for out in backoff._requests(4, turn, 3)([made]) for r in out.to_pylist()]
    keys = np.concatenate([np.frombuffer(r["keys"], np.uint64) for r in asked])
    n = np.concatenate([np.frombuffer(r["n"], np.uint32) for r in asked])
    assert {r["part"] for r in asked} <= set(range(4))
    # start, a, b, c; start a, a b, b a, b c
    assert len(keys) == len(set(keys.tolist())) == 8 and sorted(n.tolist()) == [1, 1, 1, 2, 2, 3, 3, 3]
    asked = pa.Table.from_pylist(sorted(asked * 2, key=lambda r: r["part"]), made_of_requests())
    answers = [r for out in backoff._counted(iter(asked.to_batches(max_chunksize=3))) for r in out.to_pylist()]
    for r, was in zip(answers, asked.to_pylist(), strict=True):
        own = np.frombuffer(was["n"], np.uint32)
        assert (np.frombuffer(r["n"], f"u{len(r['n']) // len(own)}") == 2 * own).all()


def made_of_requests() -> pa.Schema:
    return pa.schema([("part", pa.int32()), ("slice", pa.int64()), ("keys", pa.binary()), ("n", pa.binary())])


# packing


def test_packing(frame, corpus):
    tokenizers = pytest.importorskip("tokenizers")
    texts = corpus | {70: "a  b\n \tc     d", 71: "<|endoftext|> x", 72: " lead and trail ", 73: "it's\x1c \x85 we'll"}
    rows = packing.pack(frame(texts, True), size=64, open_bins=8, shard_tokens=20_000).collect()
    encode = tokenizers.Tokenizer.from_file(packing.default_tokenizer()).encode
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(texts)
    for i, text in texts.items():
        ids = np.array([*encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        own = sorted(pieces[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert b"".join(r["ids"] for r in own) == ids.tobytes()
        assert [r["start"] for r in own] == [0, *np.cumsum([r["length"] for r in own])[:-1]]
        assert all(r["ids_crc32"] == zlib.crc32(r["ids"]) and len(r["ids"]) == 4 * r["length"] for r in own)
        assert len(own) == 1 if len(ids) <= 64 else all(r["length"] == 64 for r in own[1:])
    for parts in sequences.values():
        place = 0
        for offset, length in sorted(parts):
            assert offset == place
            place += length
        assert place <= 64
    assert len(sequences) <= 1.1 * sum(r["length"] for r in rows) / 64 + 3


def test_the_fullest_bin_closes_first():
    bins = packing.OpenBins(10, 2)
    assert [bins.place(n) for n in (7, 5, 6)] == [(0, 0), (1, 0), (2, 0)]
    assert bins.place(3) == (2, 6)  # bin 0 is closed, of 5 and 4 free the tighter one is taken
    assert bins.rest() == [(9, 2), (5, 1)]


# shards


@pytest.mark.parametrize("shards", [1, 5])
def test_histogram_sort(frame, corpus, shards):
    rng = random.Random(9)
    texts = {i: " ".join(some_words(rng, rng.randrange(1, 60))) for i in range(300)} | {2000 + i: "the same text" for i in range(250)}
    texts |= {-(2**62): None, 2**62: "", 999: "long " * 50}
    rows = histogram_sort.document_rows(frame(texts, True))
    got = by_id(histogram_sort.shard_by_bytes(rows, shards, tolerance=0.02))
    assert set(got) == set(texts)
    size = {i: len((t or "").encode()) + 8 for i, t in texts.items()}
    members = defaultdict(list)
    for i, r in got.items():
        assert r["size"] == size[i] and (r["text"] or "") == (texts[i] or "")
        members[r["shard"]].append(i)
    share = sum(size.values()) / shards
    assert sorted(members) == list(range(shards))
    for ids in members.values():
        assert sorted(got[i]["slot"] for i in ids) == list(range(len(ids)))
        assert abs(sum(size[i] for i in ids) - share) <= 2 * (0.02 * share + max(size.values()))
    of_text = defaultdict(set)
    for i, t in texts.items():
        of_text[t].add(got[i]["shard"])
    assert sum(len(s) > 1 for s in of_text.values()) <= 1  # only the text that is too large for a shard


def test_histogram_sort_of_nothing(frame):
    assert histogram_sort.shard_by_bytes(histogram_sort.document_rows(frame({}))).collect() == []


# licenses


def test_licenses(frame, corpus):
    texts = corpus | {
        80: "Released UNDER the MIT-License. cc by nc cc by nc; Apache License, Version 2",
        81: "this work is licensed under the GNU public license, version 3",
        82: "redistribution and use in source and binary forms, with or without any modification, are permitted",
        83: "under the mit", 84: "license version 2",
    }
    got = by_id(licenses.scan_licenses(frame(texts, True)))
    assert set(got) == set(texts)
    for i, text in texts.items():
        words = licenses.words_of(text or "")
        places = [(k, label) for p, label in licenses.PHRASES.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
        row = got[i]
        assert (row["n_words"], row["n_base"]) == (len(words), len(places))
        assert row["first_word"] == min((k for k, _ in places), default=None)
        assert row["last_word"] == max((k for k, _ in places), default=None)
        assert row["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(row["base_labels"].split(",")) - {""} <= set(row["labels"].split(","))
    assert got[80]["labels"] == "apache-2,cc-by-nc,mit" and got[80]["score"] == 1
    assert (got[81]["labels"], got[82]["labels"]) == ("gpl-3", "bsd") and 0.8 <= got[82]["score"] < 1
    assert (got[83]["labels"], got[84]["labels"], got[83]["score"]) == ("", "", 0)


def test_notices_with_words_changed_at_every_place(frame):
    """Every choice of one or two places whose words are changed, as far as the similarity stays."""
    texts, want = {}, {}
    for notice, label in licenses.NOTICES.items():
        words = notice.split()
        n = len(words)
        for a in range(n):
            for b in range(a, n):
                changed = [f"x{j}" if j in (a, b) else w for j, w in enumerate(words)]
                similarity = 1 - len({a, b}) / n
                if similarity >= 0.8:
                    want[len(texts)] = (label, similarity)
                    texts[len(texts)] = " ".join(["some", "text", *changed, "and", "more"])
    got = by_id(licenses.scan_licenses(frame(texts)))
    for i, (label, similarity) in want.items():
        assert any(s["label"] == label and abs(s["similarity"] - similarity) < 1e-9 for s in got[i]["spans"]), texts[i]


def test_words_beside_a_notice_do_not_hide_it():
    notice = "released under the mit license".split()
    words = "the mit released under x mit license the mit".split()
    assert licenses.similar_spans(notice, words, 0, 9, 0.8) == [(2, 7, 0.8)]


# decontamination


def test_decontamination(spark, frame, corpus):
    rng = random.Random(11)
    items = {k: some_words(rng, 14 + 6 * k, 100_000) for k in range(8)}
    benchmark = spark.createDataFrame(
        [(k, " ".join(w)) for k, w in items.items()] + [(0, " ".join(items[0])), (50, None), (51, ""), (None, "x y")], "item_id long, text string"
    )
    texts = dict(corpus)
    want = {}
    for k, item in items.items():
        body = some_words(rng, 300)
        at = rng.randrange(300)
        texts[200 + k] = " ".join(body[:at] + item + body[at:]).upper()
        # a fifth of the words changed, not the last ones
        changed = [w if (j % 4 or j >= len(item) - 5) else f"q{rng.random()}" for j, w in enumerate(item)]
        texts[300 + k] = ", ".join(body[:at] + changed + body[at:])
        # too little of it
        texts[400 + k] = " ".join(body[:at] + item[: len(item) // 3] + body[at:])
        want[200 + k] = want[300 + k] = k
    got = by_id(latent.decontaminate(frame(texts, True), benchmark))
    assert set(got) == set(texts)

    assert {i: r["item_id"] for i, r in got.items() if r["contaminated"]} == want
    assert all(got[200 + k]["similarity"] == 1 and got[200 + k]["n_items"] >= 1 for k in items)
    none = by_id(latent.decontaminate(frame(texts), benchmark.where("item_id is null")))
    assert len(none) == len(texts) and not any(r["contaminated"] for r in none.values())


def test_sums_of_blocks_and_passages():
    rng = random.Random(11)
    texts = [" ".join(some_words(rng, n, 60)) for n in (0, 3, 8, 70, 200, 5000)] + [None, "  "]
    column = pa.array(texts, pa.string())
    words, hashes = latent.words_in(column)
    vocabulary = latent.Vocabulary(np.random.default_rng(2).uniform(1, 3, latent._BUCKETS), np.unique(hashes)[::2])
    probe = np.random.default_rng(3).standard_normal((len(vocabulary.items), 5), dtype=np.float32)
    blocks = latent._Blocks(words)
    at, number = vocabulary.look_up(hashes)
    # passages of 32 words that do not cross documents, as a plain matrix
    own = [(d, k // 32) for d in range(len(texts)) for k in range(words.counts[d])]
    numbered = {passage: i for i, passage in enumerate(dict.fromkeys(own))}
    matrix = np.zeros((len(numbered), len(vocabulary.items)))
    for place, n in zip(at.tolist(), number.tolist(), strict=True):
        matrix[numbered[own[place]], n] += vocabulary.weights(hashes[place : place + 1])[0]
    image = np.zeros_like(probe)
    latent._add_image(image, column, vocabulary, probe)
    assert np.allclose(image, matrix.T @ (matrix @ probe), rtol=1e-4, atol=1e-2)
    wanted, got = (np.zeros((len(blocks), 5), np.float32) for _ in range(2))
    np.add.at(wanted, blocks.of_word[at], probe[number])
    latent._block_sums(blocks.of_word[at], number, probe, got)
    assert np.allclose(got, wanted, atol=1e-4)


def test_long_items_are_found(spark, frame):
    """Copies of items that are many times as long as a searched passage, against brute force."""
    rng = random.Random(12)
    items = {k: some_words(rng, n, 100_000) for k, n in enumerate((49, 64, 130, 200, 500))}
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")
    texts = {k: " ".join(some_words(rng, 300, 100_000)) for k in range(30)}
    for k, item in items.items():
        body = some_words(rng, 300, 100_000)
        at = rng.randrange(300)
        texts[100 + k] = " ".join(body[:at] + item + body[at:])
        texts[200 + k] = " ".join(body[:at] + item[: len(item) // 2] + body[at:])  # too little of it
    want = {}
    for i, text in texts.items():
        words = text.split()
        for k, item in items.items():
            if any(words[a : a + len(item)] == item for a in range(len(words))):
                want[i] = k
    got = by_id(latent.decontaminate(frame(texts), benchmark))
    assert {i: r["item_id"] for i, r in got.items() if r["contaminated"]} == want
    assert all(got[i]["similarity"] == 1 for i in want)


def test_frequent_words_and_paraphrases_are_found(spark, frame):
    """Items of frequent words only, and paraphrases that keep 62 to 75 % of the words with rare words in
    place of the others, against the longest common subsequence."""
    rng = random.Random(13)
    common = [w for w in some_words(rng, 40, 10**5) for _ in range(2)]
    rare = (f"q{k}z" for k in range(10**6))
    texts = {k: " ".join(rng.choice(common) if rng.random() < 0.5 else next(rare) for _ in range(200)) for k in range(100)}
    items, want = {}, {}
    for k in range(24):
        n = (16, 30, 60)[k % 3]
        item = [rng.choice(common) if k < 6 or rng.random() < 0.4 else next(rare) for _ in range(n)]
        items[k] = item
        part = 1 if k < 6 else (0.62, 0.68, 0.75)[k // 3 % 3]
        kept = set(rng.sample(range(n - 5), math.ceil(part * n) - 5)) | set(range(n - 5, n))
        passage = [w if j in kept else next(rare) for j, w in enumerate(item)]
        body = texts[k].split()
        at = rng.randrange(200)
        texts[1000 + k] = " ".join(body[:at] + passage + body[at:])
        assert licenses.common_words(item, passage) >= 0.6 * n
        want[1000 + k] = k
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")
    got = by_id(latent.decontaminate(frame(texts), benchmark))
    assert all(got[i]["contaminated"] for i in want)
    assert all(got[1000 + k]["similarity"] == 1 for k in range(6))


# pipeline


def test_pipeline(spark, tmp_path):
    """Every stage keeps what it should of its input; the result is what its stages give."""
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic = 1").collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        stage(spark, docs, sf_dir).write.parquet(path := str(tmp_path / f"{k}-{name}"))
        after_df = spark.read.parquet(path)
        assert after_df.columns == docs.columns
        after = {r["doc_id"]: r["text"] for r in after_df.collect()}
        assert set(after) <= set(before)
        gone = set(before) - set(after)
        if name == "toxicity":
            assert len(gone & toxic) >= 0.4 * len(toxic & set(before)) and len(gone) < 0.2 * len(before)
        elif name == "near_dedup":
            assert 0 < len(gone) < 0.3 * len(before)
        elif name == "suffix_dedup":
            assert not gone and sum(map(len, after.values())) < sum(map(len, before.values()))
            assert {r["n_chars"] == len(r["text"]) for r in after_df.collect()} == {True}
        else:
            assert 0 < len(gone) < 0.2 * len(before)
        docs = after_df
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert set(map(tuple, last.select(columns).collect())) == set(map(tuple, corpus_pipeline.run(spark, sf_dir).select(columns).collect()))


def test_stages_hand_small_batches_to_python(spark, tmp_path, frame):
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(batch)], pa.int64())})

    try:
        for allowed, most in (("10000", corpus_pipeline.BATCH_ROWS), ("0", corpus_pipeline.BATCH_ROWS), ("7", 7)):
            spark.conf.set(setting, allowed)
            dict(corpus_pipeline.STAGES)["suffix_dedup"](spark, frame({1: "some text", 2: None}), str(tmp_path)).collect()
            seen = spark.range(0, 3_000, 1, 1).mapInArrow(sizes, "n long").collect()
            assert max(row["n"] for row in seen) == most
        assert all(hasattr(stage, "__wrapped__") for _, stage in corpus_pipeline.STAGES)
    finally:
        spark.conf.set(setting, before)


def test_pipeline_keeps_every_row(spark, tmp_path):
    """Rows without an id, rows that repeat one, and columns with the names of stages' own."""
    rng = random.Random(9)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 60))) for _ in range(40)]
    ids = [None, None, 2, 2, 2, *range(3, 38)]
    rows = [(i, t, "en", "s", len(t)) for i, t in zip(ids, texts, strict=True)] + [(1, None, None, None, None), (None, "", None, None, 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema).repartition(3)
    docs = docs.selectExpr("*", "'k' AS kept_text", "1 AS spans", "'x' AS _row", "2 AS others", "3 AS kept", "4 AS place")
    before = sorted(map(repr, docs.collect()))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, "/root/testdata/sf0.001").write.parquet(path := str(tmp_path / f"{k}-{name}"))
        docs = spark.read.parquet(path)
        assert sorted(map(repr, docs.collect())) == before, name
        stage(spark, docs.limit(0), "/root/testdata/sf0.001").write.parquet(empty := str(tmp_path / f"{k}-empty"))
        assert spark.read.schema(docs.schema).parquet(empty).count() == 0
    packed = corpus_pipeline.pack_sequences(spark, docs, "").collect()
    assert len({r["doc_id"] for r in packed}) == len(rows)


@pytest.mark.parametrize(
    "operator",
    [
        lambda d, s: quality_forest.quality_rules(d, d.select("doc_id", F.lit(1).alias("quality"))),
        lambda d, s: toxicity.toxicity(d, d.select("doc_id", F.lit(1).alias("toxic"))),
        lambda d, s: backoff.stupid_backoff(d),
        lambda d, s: packing.pack(d),
        lambda d, s: licenses.scan_licenses(d),
        lambda d, s: latent.decontaminate(d, s.createDataFrame([(1, "a b c")], "item_id long, text string")),
    ],
)
def test_empty_table(spark, frame, operator):
    assert operator(frame({}), spark).collect() == []
