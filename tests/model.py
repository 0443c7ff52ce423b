"""A plain Python model of the pipeline, by direct enumeration, and random inputs for it."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

OPEN = date(2099, 12, 31)
DAY = timedelta(days=1)


def rows(df) -> list[tuple]:
    """The rows of a DataFrame in a fixed order, NULLs first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, v) for v in r])


def ordered(values) -> list[tuple]:
    return sorted(values, key=lambda r: [(v is not None, v) for v in r])


def random_raw(seed: int, accounts: int = 7, hub: bool = False, far: bool = False):
    """Dirty raw rows over few accounts, so that cycles, ties and overlaps are common. With `hub`
    one account owns about half of the rows, with `far` some dates lie beyond the open end."""
    rnd = random.Random(seed)
    names = [f"N{i}" for i in range(accounts)]
    day = lambda: date(2024, 1, 1) + timedelta(days=rnd.randrange(0, 25))

    edges = []
    for _ in range(accounts + 4):
        made = datetime.combine(day(), datetime.min.time())
        edges.append(
            (
                names[0] if hub and rnd.random() < 0.5 else rnd.choice(names),
                rnd.choice(names + ["", None]),
                made,
                made + rnd.randrange(0, 3) * DAY,
                rnd.choice(["N", "N", "N", "N", "Y", None]),
            )
        )
    partners = [
        (
            rnd.choice(names),
            "G",
            rnd.choice("YN"),
            rnd.choice("YN"),
            rnd.choice(["N", "N", "N", "Y", None]),
        )
        for _ in range(5)
    ]
    mappings = []
    for i in range(18):
        begin = day()
        if far and rnd.random() < 0.2:
            begin = rnd.choice([date(2099, 12, 31), date(2120, 1, 1)])
        later = [None, begin + timedelta(days=rnd.randrange(-2, 15)), OPEN]
        if far:
            later += [date(2110, 1, 1), date(2150, 1, 1)]
        mappings.append(
            (
                names[0] if hub and rnd.random() < 0.5 else rnd.choice(names),
                rnd.choice(["E1", "E2", None]),
                rnd.choice([1, None]),
                rnd.choice([begin, begin, begin, None]),
                rnd.choice(later),
                rnd.choice(["api", "MANUAL", "feed", "other", None]),
                f"ADV{i}",
                rnd.choice(["Y", "Y", "Y", "N"]),
            )
        )
    return edges, partners, mappings


def _nulls_last(value):
    return (value is None, value or "")


class Model:
    def __init__(self, raw, *, half_open=False, keep_unmapped=False, unmapped_flags="partner",
                 succession_key="child", max_depth=12):
        raw_edges, raw_partners, raw_mappings = raw
        newest = {}
        for parent, child, created, updated, flag in raw_edges:
            if flag in (None, "Y") or not parent or not child or parent == child:
                continue
            stamp = (updated, created)
            newest[parent, child] = max(newest.get((parent, child), stamp), stamp)
        self.edges = {edge: created for edge, (_, created) in newest.items()}
        self.partners = {p[0] for p in raw_partners if p[4] not in (None, "Y")}

        groups: dict[tuple, list] = {}
        for manager, entity, place, begin, end, source, advertiser, linked in raw_mappings:
            end, source = end or OPEN, source and source.upper()
            if linked == "Y" and begin is not None and begin <= end:
                rank = {"API": 1, "MANUAL": 2}.get(source, 3)
                order = (rank, -end.toordinal(), _nulls_last(source), _nulls_last(advertiser))
                groups.setdefault((manager, entity, place, begin), []).append(
                    (order, end, source)
                )
        self.best = [
            (*key, *min(options, key=lambda x: x[0])[1:]) for key, options in groups.items()
        ]

        cuts = {m[3] for m in self.best} | {d.date() for d in self.edges.values()}
        cuts |= {m[4] + DAY if half_open else m[4] for m in self.best if m[4] != OPEN}
        starts = sorted(cuts)
        self.periods = [
            (d, starts[i + 1] - DAY if i + 1 < len(starts) else OPEN)
            for i, d in enumerate(starts)
        ]

        self.paths = []
        frontier = [edge for edge in self.edges]
        for depth in range(1, max_depth + 1):
            self.paths += frontier
            if depth < max_depth:
                frontier = [
                    path + (child,)
                    for path in frontier
                    for parent, child in self.edges
                    if parent == path[-1] and child not in path
                ]

        self.segments = []
        for path in self.paths:
            parent, child, root, level = path[-2], path[-1], path[0], len(path) - 1
            partner_root = int(parent == root and parent in self.partners)
            for begin, end in self.periods:
                held = [
                    m for m in self.best
                    if m[0] == parent and begin >= m[3] and end <= m[4]
                ]
                for m in held:
                    self.segments.append(
                        (parent, child, root, level, begin, end, 1, m[1], m[2], m[5],
                         int(parent == root), partner_root)
                    )
                if not held:
                    alone = 1 if unmapped_flags == "always" else int(parent in self.partners)
                    both = 1 if unmapped_flags == "always" else int(
                        parent in self.partners and child in self.partners
                    )
                    self.segments.append(
                        (parent, child, root, level, begin, end, 0, None, None, None, alone, both)
                    )

        last: dict[str, date] = {}
        for s in self.segments:
            if s[6]:
                account = s[1] if succession_key == "child" else s[0]
                last[account] = max(last.get(account, s[5]), s[5])
        self.standalone = {
            a: d + DAY for a, d in last.items() if d < OPEN and a in self.partners
        }

        candidates: dict[tuple, list] = {}
        for p, c, root, level, begin, end, mapped, entity, place, source, own, partner in self.segments:
            if not mapped and not keep_unmapped:
                continue
            if keep_unmapped and source is None:
                source = "HIERARCHY"
            candidates.setdefault((p, entity, place, begin, end), []).append(
                (level, root, own, partner, source, "HIERARCHY")
            )
        for account, begin in self.standalone.items():
            candidates.setdefault((account, None, None, begin, OPEN), []).append(
                (0, account, 1, 1, "INHERITANCE", "STANDALONE")
            )
        rank = {"API": 1, "INHERITANCE": 2, "MANUAL": 3}
        chosen = {
            key: min(options, key=lambda x: (-x[3], rank.get(x[4], 4), x[0], _nulls_last(x[4]), x[1], x[2]))
            for key, options in candidates.items()
        }
        in_order = sorted(
            chosen,
            key=lambda k: (k[0], k[3], (k[1] is not None, k[1]), (k[2] is not None, k[2]), k[4]),
        )
        # hierarchy_key, account, entity, marketplace, root, level, start, end, flags, source, kind
        self.fact = [
            (i + 1, k[0], k[1], k[2], chosen[k][1], chosen[k][0], k[3], k[4], chosen[k][2],
             chosen[k][3], chosen[k][4], chosen[k][5])
            for i, k in enumerate(in_order)
        ]
