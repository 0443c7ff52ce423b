"""Repair of conversations: the cheapest edits after which roles alternate, by a Viterbi search whose
survivors give out edits as soon as they share an ancestor.

Rows are put in order over the whole table and cut into blocks of a fixed number of rows, whatever the
conversations in them. A block settles the conversations that lie inside it. One that crosses an
edge of the block becomes a fragment: its cheapest edits from every state at its beginning to every state
at its end. Fragments are then chained by the same search, whose steps are fragments instead of rows, so
that a conversation of any length is searched in many tasks.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from temporal_tree.llm.documents import tables
from temporal_tree.operators.numbering import number_in_place
from temporal_tree.sources.scratch import Scratch

# states: nothing kept yet, after the system row, after a user row, after an assistant row
START, SYSTEM, USER, ASSISTANT = range(4)
_ENDS = (START, ASSISTANT)
_REROLE, _DELETE, _INSERT, _TRUNCATED = 1, 2, 5, 5

# first fault of a row
FAULTS = ("none", "blank", "duplicate", "truncated")


# What it costs at most to go on from the first state as from the second one, whatever rows follow: an
# insertion makes up for a missing row, a deletion for a system row that may only come first.
_INSTEAD = {
    (ASSISTANT, START): _DELETE,
    (ASSISTANT, SYSTEM): 0,
    (ASSISTANT, USER): _INSERT,
    (USER, ASSISTANT): _INSERT,
    (USER, START): _INSERT + _DELETE,
    (USER, SYSTEM): _INSERT,
    (START, SYSTEM): 0,
    (START, USER): _INSERT,
    (START, ASSISTANT): 2 * _INSERT,
}


class _Node:
    """The best way to one state after some steps: its last step, the way before, how many ways go on from it."""

    __slots__ = ("parent", "edits", "roles", "uses", "child")

    def __init__(self, parent: _Node | None, edits: str, roles: str):
        self.parent, self.edits, self.roles = parent, edits, roles
        self.uses, self.child = 0, None


class Survivors:
    """Viterbi over steps that are given one by one. Of equally cheap ways the one whose edits come first
    in ASCII order survives.

    Ways form a tree of backpointers. A node that no survivor descends from is cut off, and counts of uses
    tell where the survivors' last common ancestor is: all steps before it are settled and come out of
    `settled`, so that memory holds only what the survivors disagree about. Ties are compared over all of
    that, from the common ancestor of the two ways on. Of two ways with equal cost over the same steps
    neither is the beginning of the other, as that would have to insert more, so a comparison never waits
    for steps to come. A state that another one can stand in for at a lower cost, whatever follows, has no
    survivor: else the way that has deleted everything would never let the others settle.
    """

    def __init__(self, starts: Iterable[int]):
        self.base = _Node(None, "", "")
        self.best: dict[int, tuple[int, _Node]] = {s: (0, self.base) for s in starts}
        self.base.uses = len(self.best)

    @staticmethod
    def _less(a: _Node, more_a: str, b: _Node, more_b: str) -> bool:
        x, y = [more_a], [more_b]
        while a is not b:  # both are equally many steps deep
            x.append(a.edits)
            y.append(b.edits)
            a, b = a.parent, b.parent
        return "".join(reversed(x)) < "".join(reversed(y))

    def step(self, moves: Iterable[tuple[int, int, int, str, str]]) -> None:
        """Goes on by one of `moves` (state before, state after, cost, edits, roles)."""
        found: dict[int, tuple[int, _Node, str, str]] = {}
        for before, after, cost, edits, roles in moves:
            if before not in self.best:
                continue
            sum_, node = self.best[before]
            sum_ += cost
            other = found.get(after)
            if other is None or sum_ < other[0] or (sum_ == other[0] and self._less(node, edits, other[1], other[2])):
                found[after] = (sum_, node, edits, roles)
        old = self.best
        self.best = {}
        for state, (sum_, parent, edits, roles) in found.items():
            if any((s, state) in _INSTEAD and sum_ > w[0] + _INSTEAD[s, state] for s, w in found.items()):
                continue
            node = _Node(parent, edits, roles)
            node.uses = 1
            parent.uses += 1
            parent.child = node
            self.best[state] = (sum_, node)
        for _, node in old.values():
            self._drop(node)

    def _drop(self, node: _Node) -> None:
        while node is not None:
            node.uses -= 1
            if node.uses or node is self.base:
                return
            node = node.parent

    def settled(self) -> Iterator[tuple[str, str]]:
        """Edits and roles of the steps that all survivors share, in order, each once."""
        ends = {id(node) for _, node in self.best.values()}
        while self.base.uses == 1 and id(self.base) not in ends:
            # the child that was made last may have been cut off since
            node = self.base.child
            if node.uses == 0:
                node = self._only_child()
            node.parent = None
            self.base = node
            yield node.edits, node.roles

    def _only_child(self) -> _Node:
        _, node = next(iter(self.best.values()))
        while node.parent is not self.base:
            node = node.parent
        return node

    def finish(self, state: int) -> tuple[int, list[tuple[str, str]]]:
        """Cost and unsettled steps of the way that ends in a state."""
        cost, node = self.best[state]
        steps = []
        while node is not self.base:
            steps.append((node.edits, node.roles))
            node = node.parent
        return cost, steps[::-1]


# Per state, the states that inserted rows lead to: (state, edits, roles).
_INSERTED = {
    START: [(START, "", ""), (USER, "I", "u"), (ASSISTANT, "II", "ua")],
    SYSTEM: [(SYSTEM, "", ""), (USER, "I", "u"), (ASSISTANT, "II", "ua")],
    USER: [(USER, "", ""), (ASSISTANT, "I", "a")],
    ASSISTANT: [(ASSISTANT, "", ""), (USER, "I", "u")],
}
_NEXT = {START: ((USER, "u"),), SYSTEM: ((USER, "u"),), ASSISTANT: ((USER, "u"),), USER: ((ASSISTANT, "a"),)}


@functools.cache
def _moves(initial: str, fault: int) -> list[tuple[int, int, int, str, str]]:
    """All ways over one row: rows inserted before it, then what becomes of it."""
    out = []
    for before, ways in _INSERTED.items():
        for state, edits, roles in ways:
            cost = _INSERT * len(edits)
            out.append((before, state, cost + _DELETE, edits + "D", roles + "-"))
            if fault in (1, 2):
                continue
            kept = cost + (_TRUNCATED if fault == 3 else 0)
            if state == START and initial == "s":
                out.append((before, SYSTEM, kept, edits + "K", roles + "s"))
            for after, role in _NEXT[state]:
                if role == initial:
                    out.append((before, after, kept, edits + "K", roles + role))
                else:
                    out.append((before, after, kept + _REROLE, edits + "R", roles + role))
    return out


# what may be inserted after the last row, as moves to the state that stands for the end
_CLOSING = [
    (before, START, _INSERT * len(edits), edits, roles)
    for before, ways in _INSERTED.items()
    for state, edits, roles in ways
    if state in _ENDS
]


def _closed(survivors: Survivors) -> tuple[int, list[tuple[str, str]]]:
    survivors.step(_CLOSING)
    steps = list(survivors.settled())
    cost, rest = survivors.finish(START)
    return cost, steps + rest


def repair_plan(rows: Iterable[tuple[str, int]]) -> tuple[int, list[str], list[str]]:
    """Cost, edits and roles per row of the cheapest repair of one conversation from its rows' role initials
    and faults; rows inserted at the end belong to the last one."""
    survivors, steps, n = Survivors([START]), [], 0
    for initial, fault in rows:
        survivors.step(_moves(initial, fault))
        steps += survivors.settled()
        n += 1
    cost, rest = _closed(survivors)
    steps += rest
    edits, roles = [e for e, _ in steps[:n]], [r for _, r in steps[:n]]
    if n:
        edits[-1] += steps[n][0]
        roles[-1] += steps[n][1]
    return cost, edits, roles


_FOUND = pa.schema(
    [
        ("first_place", pa.int64()),
        ("conv_id", pa.int64()),
        ("entry", pa.int32()),
        ("exit", pa.int32()),
        ("cost", pa.int64()),
        ("edits", pa.string()),
        ("roles", pa.string()),
    ]
)
_FOUND_TYPES = "first_place long, conv_id long, entry int, exit int, cost long, edits string, roles string"


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation inside a block its repair, without entry; per fragment the ways between all states."""
    for batch in batches:
        for i in range(batch.num_rows):
            rows = batch.column("rows").slice(i, 1).to_pylist()[0]
            bounds = [k for k in range(len(rows)) if not k or rows[k]["conv_id"] != rows[k - 1]["conv_id"]]
            bounds.append(len(rows))
            out = []
            for a, b in zip(bounds, bounds[1:], strict=False):
                head = (rows[a]["place"], rows[a]["conv_id"])
                steps = [(r["initial"], r["fault"]) for r in rows[a:b]]
                if 0 < a and b < len(rows):
                    cost, edits, roles = repair_plan(steps)
                    out.append((*head, None, None, cost, ",".join(edits), ",".join(roles)))
                    continue
                for entry in range(4):
                    survivors, settled = Survivors([entry]), []
                    for step in steps:
                        survivors.step(_moves(*step))
                        settled += survivors.settled()
                    for exit_ in survivors.best:
                        cost, rest = survivors.finish(exit_)
                        way = settled + rest
                        out.append((*head, entry, exit_, cost, ",".join(e for e, _ in way), ",".join(r for _, r in way)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _FOUND, strict=True)], schema=_FOUND
            )


class _Fragments(Survivors):
    """Survivors whose steps are fragments: commas part the rows of a step and do not count in comparisons."""

    @staticmethod
    def _less(a: _Node, more_a: str, b: _Node, more_b: str) -> bool:
        x, y = [more_a], [more_b]
        while a is not b:
            x.append(a.edits)
            y.append(b.edits)
            a, b = a.parent, b.parent
        return "".join(reversed(x)).replace(",", "") < "".join(reversed(y)).replace(",", "")


_CHOSEN = pa.schema([("first_place", pa.int64()), ("conv_id", pa.int64()), ("edits", pa.string()), ("roles", pa.string())])
_CHOSEN_TYPES = "first_place long, conv_id long, edits string, roles string"


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fragments come by conversation and place. A conversation's choice of ways comes out fragment by fragment."""

    def fragments() -> Iterator[tuple[int, int, list]]:
        key, moves = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                at = (row["conv_id"], row["first_place"])
                if key is not None and at != key:
                    yield *key, moves
                    moves = []
                key = at
                moves.append((row["entry"], row["exit"], row["cost"], row["edits"], row["roles"]))
        if key is not None:
            yield *key, moves

    def chosen() -> Iterator[tuple[int, int, str, str]]:
        survivors, open_, conv = None, [], None

        def close() -> Iterator[tuple[int, int, str, str]]:
            _, steps = _closed(survivors)
            *steps, last = steps
            for k, (place, (edits, roles)) in enumerate(zip(open_, steps, strict=True)):
                more = last if k == len(open_) - 1 else ("", "")
                yield place, conv, edits + more[0], roles + more[1]

        for conv_id, place, moves in fragments():
            if survivors is None or conv_id != conv:
                if survivors is not None:
                    yield from close()
                survivors, open_, conv = _Fragments([START]), [], conv_id
            survivors.step(moves)
            open_.append(place)
            # the last fragment stays open for rows inserted at the end
            settled = survivors.settled()
            while len(open_) > 1 and (step := next(settled, None)):
                yield open_.pop(0), conv, *step
        if survivors is not None:
            yield from close()

    rows = []
    for row in chosen():
        rows.append(row)
        if len(rows) == 100:
            yield _as_batch(rows)
            rows = []
    if rows:
        yield _as_batch(rows)


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _CHOSEN, strict=True)], schema=_CHOSEN
    )


def repair(turns: DataFrame, block_rows: int = 4096, scratch: Scratch | None = None) -> DataFrame:
    """Rows of conversations with their faults and what the cheapest repair does with them.

    `turns` has `conv_id`, `turn` (long), `role` and `text`; further columns are ignored. Rows of a conversation
    are in order of `turn`, null first; rows that share it in order of role and a hash of role and text, so equal
    rows stand side by side. A null role or text counts as one space, a null conversation id as one more
    conversation.

    Gives `conv_id`, `place` (ascends within a conversation, gapless), `turn`, `role`, `text`, `fault` (of `FAULTS`),
    `illegal` (its role may not follow the row's before), `new_turn` (its turn is the first of its kind), `edits` and
    `roles`: one letter each per edit, the row's own (K, R or D) among those of rows inserted around it (I);
    a role is s, u or a, and `-` for a deleted row. An empty table gives no rows.

    A conversation may hold any share of all rows: order, duplicates, blocks and edits are found by exchanges
    that divide it. Only its fragments, one in `block_rows` rows, come to one task, as a stream.
    """
    scratch = scratch or tables(turns.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(" "))
    role = F.coalesce(F.col("role"), F.lit(" "))
    solid = "[^\\x20\\x09-\\x0D]"
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("content"),
        F.when(~text.rlike(solid), 1)
        .when(~text.rlike("[.!?][\\x20\\x09-\\x0D]*\\z"), 3)
        .otherwise(0)
        .alias("fault"),
    ).withColumn("copy", F.monotonically_increasing_id())
    order = ["conv_id", "turn", "role", "content", "copy"]
    rows = number_in_place(rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("copy"), "place", scratch)
    narrow = scratch.save(
        rows.select("place", "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "fault", "content"), "narrow"
    )
    repeated = (
        narrow.where("fault <> 1")
        .groupBy("conv_id", "content")
        .agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.col("conv_id").alias("_conv"), F.col("content").alias("_content"), "first")
    )
    repeated = scratch.save(repeated, "repeated")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("content") == F.col("_content"))
    marked = narrow.join(repeated, same, "left").withColumn(
        "fault", F.when((F.col("fault") != 1) & (F.col("place") > F.col("first")), 2).otherwise(F.col("fault"))
    )
    marked = scratch.save(marked.select("place", "conv_id", "turn", "initial", "fault"), "marked")
    # neighbours meet by place, the first row of a conversation has none
    before = marked.select(
        (F.col("place") + 1).alias("place"),
        F.col("conv_id").alias("_conv"),
        F.col("turn").alias("_turn"),
        F.col("initial").alias("_initial"),
        F.lit(True).alias("_there"),
    )
    follows = F.coalesce(F.col("_there"), F.lit(False)) & F.col("conv_id").eqNullSafe(F.col("_conv"))
    pair = F.concat("_initial", "initial").isin("su", "ua", "au")
    marked = marked.join(before, "place", "left").select(
        "place",
        "conv_id",
        "turn",
        "initial",
        "fault",
        (follows & ~pair).alias("illegal"),
        (F.col("turn").isNotNull() & ~(follows & F.col("turn").eqNullSafe(F.col("_turn")))).alias("new_turn"),
    )
    marked = scratch.save(marked, "marked")
    blocks = marked.groupBy(F.floor(F.col("place") / block_rows).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("place", "conv_id", "initial", "fault"))).alias("rows")
    )
    found = scratch.save(blocks.mapInArrow(_searched, _FOUND_TYPES), "found")
    chained = (
        found.where("entry is not null")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "first_place")
        .mapInArrow(_chained, _CHOSEN_TYPES)
    )
    chosen = found.where("entry is null").select("first_place", "conv_id", "edits", "roles").unionByName(chained)
    spread = (
        chosen.select("first_place", F.split("edits", ",").alias("edits"), F.split("roles", ",").alias("roles"))
        .select("first_place", F.posexplode(F.arrays_zip("edits", "roles")))
        .select((F.col("first_place") + F.col("pos")).alias("place"), "col.edits", "col.roles")
    )
    plan = scratch.save(marked.drop("conv_id", "turn", "initial").join(spread, "place"), "plan")
    names = F.array(*[F.lit(name) for name in FAULTS])
    return rows.drop("content", "fault").join(plan, "place").withColumn("fault", F.get(names, F.col("fault")))


def edited(rows: DataFrame) -> DataFrame:
    """The edits of `repair` one by one: `conv_id`, `place`, `step` (order of those at the same place), `edit`, and
    `role` and `text` after it. Inserted rows have an empty text, deleted ones no role and text."""
    steps = F.transform(
        F.sequence(F.lit(1), F.length("edits")),
        lambda i: F.struct(
            i.alias("step"), F.substring("edits", i, F.lit(1)).alias("edit"), F.substring("roles", i, F.lit(1)).alias("to")
        ),
    )
    new_role = F.when(F.col("to") == "u", "user").otherwise("assistant")
    return (
        rows.select("conv_id", "place", "role", "text", F.explode(steps).alias("s"))
        .select("conv_id", "place", "s.step", "s.edit", "s.to", "role", "text")
        .select(
            "conv_id",
            "place",
            "step",
            "edit",
            F.when(F.col("edit") == "K", F.col("role")).when(F.col("edit") != "D", new_role).alias("role"),
            F.when(F.col("edit") == "I", F.lit("")).when(F.col("edit") != "D", F.col("text")).alias("text"),
        )
    )


def repaired(rows: DataFrame) -> DataFrame:
    """The conversations after the edits of `repair`."""
    return edited(rows).where("edit <> 'D'")


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with damage that depends on the CRC-32 of `conv_id:turn` modulo 20: 0 drops a row, 1 empties its
    text, 2 takes out `[.!?]`, 3 repeats it, 4 makes it a user's. A null role or text, and a null id or turn within
    the key, is one space."""
    filled = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    key = F.crc32(F.concat(filled["conv_id"], F.lit(":"), filled["turn"]).cast("binary")) % 20
    return (
        turns.select("conv_id", "turn", filled["role"].alias("role"), filled["text"].alias("text"), key.alias("harm"))
        .where("harm <> 0")
        .withColumn("twice", F.explode(F.when(F.col("harm") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .select(
            "conv_id",
            "turn",
            F.when(F.col("harm") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("harm") == 1, F.lit(""))
            .when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text"))
            .alias("text"),
        )
    )


def report(rows: DataFrame) -> DataFrame:
    """Per conversation of `repair`: `gaps` between its turns, rows by first fault, `illegal` neighbours, `cost`."""

    def n(condition):
        return F.sum(condition.cast("long"))

    def of(letter: str):
        return F.length("edits") - F.length(F.replace("edits", F.lit(letter), F.lit("")))

    undone = (F.col("fault") == "truncated") & ~F.contains(F.col("edits"), F.lit("D"))
    cost = of("R") * _REROLE + of("D") * _DELETE + of("I") * _INSERT + undone.cast("int") * _TRUNCATED
    return rows.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - n(F.col("new_turn")), F.lit(0)).cast("long").alias("gaps"),
        *[n(F.col("fault") == fault).alias(fault) for fault in FAULTS[1:]],
        n(F.col("illegal")).alias("illegal"),
        F.sum(cost).cast("long").alias("cost"),
    )


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])
    state = None

    def done() -> tuple:
        return state[0], "".join(state[1]), state[2].hexdigest()

    for batch in batches:
        out = []
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "edit", "role", "text"))
        for conv_id, edit, role, text in zip(*columns, strict=True):
            if state is None or state[0] != conv_id:
                if state is not None:
                    out.append(done())
                state = (conv_id, [], hashlib.sha256(), [""])
            state[1].append(edit)
            if edit != "D":
                state[2].update(f"{state[3][0]}{role}:{text}".encode())
                state[3][0] = "\n"
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema
            )
    if state is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip(done(), schema, strict=True)], schema=schema
        )


def digest(rows: DataFrame) -> DataFrame:
    """Per conversation of `repair` its edits in order (`audit`) and the SHA-256 of what is left, as `role:text` lines.

    A hash of a sequence is taken in order, so a conversation streams through one task, which keeps the state of
    the hash and the letters of the edits.
    """
    steps = edited(rows).select("conv_id", "place", "step", "edit", "role", "text")
    return (
        steps.repartition("conv_id")
        .sortWithinPartitions("conv_id", "place", "step")
        .mapInArrow(_digested, "conv_id long, audit string, repaired_sha256 string")
    )
