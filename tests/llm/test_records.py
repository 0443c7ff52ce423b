"""Personal data, Merkle manifests, conversations."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from temporal_tree.llm import conversations, merkle, personal_data, queries

# personal data


def digits(span: str) -> str:
    return re.sub("[^0-9]", "", span)


def luhn(number: str) -> bool:
    values = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(number))]
    return sum(v - 9 if v > 9 else v for v in values) % 10 == 0


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
]


def base_spans(text: str) -> str:
    return ",".join(
        f"{kind}:{m.start()}:{m.end()}" for kind, p, valid in BASE for m in re.finditer(p, text) if valid(m[0])
    )


def listing(spark, texts: dict) -> dict:
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = personal_data.personal_data(docs)
    rows = found.select("doc_id", personal_data.listed(personal_data.base_spans(F.col("found"))).alias("spans"))
    return {r["doc_id"]: r["spans"] for r in rows.collect()}


def test_base_spans_equal_plain_matching(spark):
    rng = random.Random(3)
    letters = "ab.@@--_%+++0123456789 ()é😀\n."
    texts = {i: "".join(rng.choice(letters) for _ in range(rng.randrange(300))) for i in range(1500)}
    texts |= {
        2000: "a@b.co " * 5000,
        2001: "a@b.com_x@y.z 1.2.3.4.5.6.7.8 0001.2.3.4 300.1.1.1.1 4111 1111 1111 1111 4111-1111-1111-11112222",
        2002: "x" * 2000 + "@" + "a." * 20_000,
        2003: None,
        2004: "",
    }
    assert listing(spark, texts) == {i: base_spans(t or "") for i, t in texts.items()}


def test_texts_that_make_matchers_backtrack(spark):
    texts = {1: "1" * 200_000 + " +" + "(" * 100_000, 2: "a." * 100_000 + "@", 3: "1." * 100_000, 4: "AB12 " * 50_000}
    spans = listing(spark, texts)
    assert [spans[i] for i in (1, 2, 4)] == ["", "", ""] and spans[3].count("ip:") == 25_000


def test_added_kinds_are_confirmed_and_need_context(spark):
    texts = [
        (1, "iban DE89 3704 0044 0532 0130 00, GB82WEST12345698765432, DE89 3704 0044 0532 0130 01 is wrong"),
        (2, "ssn 123-45-6789, 666-45-6789"),
        (3, "part 123-45-6789"),
        (4, "ssn of invoice 123-45-6789"),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = {r["doc_id"]: r for r in personal_data.personal_data(docs).collect()}
    assert [(r["n_iban"], r["n_ssn"]) for _, r in sorted(rows.items())] == [(2, 0), (0, 1), (0, 0), (0, 0)]
    assert [tuple(s) for s in rows[1]["found"]] == [("iban", 5, 32, 1.0), ("iban", 34, 56, 0.8)]
    assert [s["score"] for s in rows[2]["found"]] == [0.6]


def test_personal_data_of_a_corpus(frame, corpus):
    got = personal_data.personal_data(frame(corpus, twice=True)).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(corpus)
    assert personal_data.personal_data(frame({})).collect() == []


def test_personal_data_runs_without_python(spark):
    docs = spark.createDataFrame([(1, "a@b.co")], "doc_id long, text string")
    plan = personal_data.personal_data(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# Merkle manifests


@pytest.mark.parametrize("levels", range(1, 12))
def test_addresses_are_a_van_emde_boas_order(levels):
    rows = [merkle.addresses(levels, d, np.arange(1 << d)) for d in range(levels)]
    assert sorted(np.concatenate(rows).tolist()) == list(range((1 << levels) - 1))
    # the upper half of the levels comes first, then each subtree below it in one stretch
    upper = levels // 2
    assert sorted(np.concatenate(rows[:upper] or [[]]).tolist()) == list(range((1 << upper) - 1))
    for i in range(1 << upper if levels > 1 else 0):
        tree = np.concatenate([rows[d][i << (d - upper) : (i + 1) << (d - upper)] for d in range(upper, levels)])
        assert tree.max() - tree.min() == len(tree) - 1


def sha(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree_of(leaves: list[str]) -> tuple[str, list[list[tuple[str, int]]]]:
    """Root, and per leaf its siblings with the side it stands on."""
    ways, at, row = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(row) > 1:
        for i, a in enumerate(at):
            ways[i].append((row[a ^ 1] if a ^ 1 < len(row) else "", a & 1))
        row = [sha(*row[i : i + 2]) for i in range(0, len(row), 2)]
        at = [a >> 1 for a in at]
    return row[0], ways


def manifest_of(rows: list[tuple]) -> list[tuple]:
    key = lambda v: (v is not None, v if v is not None else 0)
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    leaf = {lang: [] for lang in langs}
    for doc_id, text, lang, source, n_chars in rows:
        def of(n, doc_id=doc_id, text=text, lang=lang, source=source):
            return sha(*map(field, (doc_id, source, lang, n, text)))

        changed = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and n_chars is not None
        leaf[lang].append((key(doc_id), of(n_chars), doc_id, of(n_chars + 1) if changed else of(n_chars)))
    trees = {lang: (sorted(leaf[lang]),) for lang in langs}
    trees = {lang: (rs, *tree_of([r[1] for r in rs])) for lang, (rs,) in trees.items()}
    root, top = tree_of([trees[lang][1] for lang in langs])
    out = []
    for lang, above in zip(langs, top, strict=True):
        rs, subroot, ways = trees[lang]
        for (_, digest, doc_id, given), way in zip(rs, ways, strict=True):
            d = given
            for other, side in way + above:
                d = sha(d) if not other else sha(other, d) if side else sha(d, other)
            out.append((doc_id, digest, subroot, root, sha(*(o for o, _ in way + above)), d, d == root))
    return out


def records(n: int, langs: list) -> list[tuple]:
    rng = random.Random(n)
    return [(i, f"text {i}" * rng.randrange(3), rng.choice(langs), rng.choice([None, "s"]), rng.choice([None, i])) for i in range(n)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize(
    "rows",
    [
        records(200, ["en", None, "zz", "é"]),
        records(65, ["en"]),
        records(1, ["en"]),
        records(30, [f"l{i}" for i in range(30)]),
        records(20, ["en", None]) + records(9, ["en"]) + [(None, None, None, None, None)] * 3 + [(None, "x", "en", None, 2**63 - 1)],
    ],
    ids=["mixed", "power of blocks", "one row", "many languages", "repeated and null rows"],
)
def test_manifest_equals_plain_trees(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3).selectExpr("*", "1 AS tree", "'x' AS digest", "2 AS block", "3 AS leaf")
    got = merkle.manifest(merkle.document_leaves(docs), height=2).verify()
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    order = lambda r: tuple(map(repr, r))
    assert sorted((tuple(r) for r in got.select(columns).collect()), key=order) == sorted(manifest_of(rows), key=order)


def test_manifest_of_no_rows(spark):
    assert merkle.manifest(merkle.document_leaves(spark.createDataFrame([], SCHEMA))).verify().collect() == []


# conversations


def cheapest(rows: list[tuple[str, int]]) -> tuple[int, str]:
    """Over all sequences of edits, by extending every one of them row by row."""
    ways = {("", ""): 0}  # roles so far, edits
    insert = lambda w: {
        (roles + more, edits + "I" * len(more)): cost + 5 * len(more)
        for (roles, edits), cost in w.items()
        for more in ("", "u", "a", "ua", "au", "uau", "aua")
    }
    good = re.compile(r"s?(ua)*u?")

    def pruned(w):
        least = {}
        for (roles, edits), cost in w.items():
            if good.fullmatch(roles):
                state = (roles == "", roles[-1:])
                least.setdefault(state, []).append((cost, edits, roles))
        # everything that ties stays, so that prefixes decide nothing
        return {(r, e): c for v in least.values() for c, e, r in v if c == min(v)[0]}

    for initial, fault in rows:
        step = {}
        for (roles, edits), cost in pruned(insert(ways)).items():
            step[roles, edits + "D"] = cost + 2
            if fault not in (1, 2):
                step[roles + initial, edits + "K"] = cost + (5 if fault == 3 else 0)
                for to in "ua":
                    step[roles + to, edits + "R"] = cost + 1 + (5 if fault == 3 else 0)
        ways = pruned(step)
    done = [(c, e) for (r, e), c in insert(ways).items() if re.fullmatch("(s?(ua)+)?", r)]
    return min(done)


def test_cheapest_edits():
    rng = random.Random(5)
    for n in range(7):
        for _ in range(60):
            rows = [(rng.choice("suaux"), rng.choice((0, 0, 0, 1, 2, 3))) for _ in range(n)]
            if not n:
                continue
            cost, edits, _ = conversations.repair_plan(rows)
            assert (cost, "".join(edits)) == cheapest(rows), rows


def test_settled_edits_leave_memory():
    rng = random.Random(6)
    survivors = conversations.Survivors([conversations.START])
    longest = open_ = 0
    for _ in range(20_000):
        survivors.step(conversations._moves(rng.choice("ua"), rng.choice((0, 0, 0, 3))))
        open_ += 1 - sum(1 for _ in survivors.settled())
        longest = max(longest, open_)
    assert longest < 200


def conversation_rows(seed: int, n: int) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, 9)):
            role = rng.choice(["user", "assistant", "system", "tool", "", None])
            text = rng.choice(["", " \t", "Hello.", "no end", f"text {rng.randrange(4)}!", None, "ends? "])
            rows.append((conv, rng.choice([turn, turn, turn, None]), role, text))
    # a conversation over many blocks, and one without an id
    rows += [(1000, t, rng.choice(["user", "assistant", "system"]), f"t {t}" + rng.choice([".", ""])) for t in range(150)]
    rows += [(None, t, "user", "?") for t in range(3)]
    return rows


def repaired_of(rows: list[tuple]) -> dict:
    """Per conversation: gaps, faults, illegal neighbours, cost, edits, hash."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [(t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows if c == conv]
        content = lambda r: hashlib.md5(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).digest()
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), content(r)))
        seen, faults = set(), []
        for _, role, text in mine:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append(1 if not solid else 2 if (role, text) in seen else 3 if solid[-1] not in ".!?" else 0)
            seen.add((role, text))
        turns = [t for t, _, _ in mine if t is not None]
        cost, edits, roles = conversations.repair_plan([(r[:1], f) for (_, r, _), f in zip(mine, faults, strict=True)])
        left = []
        for (_, role, text), e, r in zip(mine, edits, roles, strict=True):
            for letter, to in zip(e, r, strict=True):
                new = {"u": "user", "a": "assistant"}.get(to)
                left += {"K": [f"{role}:{text}"], "R": [f"{new}:{text}"], "I": [f"{new}:"], "D": []}[letter]
        pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(mine)]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in (1, 2, 3)),
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost,
            "".join(edits),
            hashlib.sha256("\n".join(left).encode()).hexdigest(),
        )
    return out


TURNS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("block_rows", [1, 7, 4096])
def test_repair_over_blocks(spark, block_rows):
    rows = conversation_rows(block_rows, 60)
    turns = spark.createDataFrame(rows, TURNS).repartition(3).selectExpr("*", "1 AS place", "'x' AS edits", "2 AS fault", "3 AS copy")
    found = conversations.repair(turns, block_rows=block_rows).cache()
    counted = {r["conv_id"]: tuple(r)[1:] for r in conversations.report(found).collect()}
    hashed = {r["conv_id"]: tuple(r)[1:] for r in conversations.digest(found).collect()}
    assert {c: counted[c] + hashed[c] for c in counted} == repaired_of(rows)
    roles = {}
    for r in conversations.repaired(found).orderBy("place", "step").collect():
        roles[r["conv_id"]] = roles.get(r["conv_id"], "") + r["role"][:1]
    assert all(re.fullmatch("(s?(ua)+)?", x) for x in roles.values())
    found.unpersist()


def test_repair_of_no_rows(spark):
    empty = conversations.repair(spark.createDataFrame([], TURNS))
    assert empty.collect() == [] and conversations.digest(empty).collect() == []


def test_damage_and_conversations_that_lose_all_rows(spark, tmp_path):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"a {t}. b!") for c in range(60) for t in range(4)]
    gone = next(c for c in range(10**6) if zlib.crc32(f"{c}:0".encode()) % 20 == 0 and c >= 60)
    rows.append((gone, 0, "user", "all of it"))
    expected = []
    for c, t, role, text in rows:
        harm = zlib.crc32(f"{c}:{t}".encode()) % 20
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        expected += [(c, t, "user" if harm == 4 else role, text)] * {0: 0, 3: 2}.get(harm, 1)
    spark.createDataFrame(rows, TURNS).write.parquet(str(tmp_path / "conversations.parquet"))
    turns = spark.read.parquet(str(tmp_path / "conversations.parquet"))
    assert sorted(map(tuple, conversations.damaged(turns).collect())) == sorted(expected)
    got = {r["conv_id"]: tuple(r)[1:] for r in queries.op13_conversation_repair(spark, str(tmp_path)).collect()}
    assert got == repaired_of(expected) | {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
