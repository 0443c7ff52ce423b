"""Personal data: regular expressions propose spans, checksums confirm them, words nearby move their score.

DataFrame functions only, and one pass: texts are not shuffled, and a row never meets another one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from temporal_tree.llm.documents import texts_of

# code points before and after a span that count as nearby
_BEFORE, _AFTER = 48, 24
_CONTEXT = 0.2

# Words near a span that make it likelier, and words that make it less likely.
_NEAR = {
    "email": "mail|contact|write|schreib|correo|courriel",
    "ip": "ip|address|host|server|adresse|dirección",
    "card": "card|visa|master|credit|karte|carte|tarjeta",
    "phone": "phone|call|tel|fax|mobile|telefon|téléphone|teléfono",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "ssn": "ssn|social|security|insurance|tax",
}
_AGAINST = "version|isbn|order|invoice|serial|bestell|commande|pedido"


def _digits(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits, 19 at most, passes the Luhn check."""
    backwards = F.reverse(digits)

    def counted(i: Column) -> Column:
        digit = F.substring(backwards, i, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when(i % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + counted(i)) % 10 == 0


def mod_97(code: Column) -> Column:
    """Whether an account number of letters A-Z and digits has the remainder 1 that ISO 7064 asks for: its
    first four characters go to the end, letters count 10 to 35."""
    moved = F.concat(F.substring(code, 5, 30), F.substring(code, 1, 4))

    def step(rest: Column, i: Column) -> Column:
        c = F.ascii(F.substring(moved, i, F.lit(1)))
        return F.when(c < 58, rest * 10 + c - 48).otherwise(rest * 100 + c - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), step) == 1


def _small_parts(span: Column) -> Column:
    return F.forall(
        F.split(span, r"\."),
        lambda part: F.length(F.ltrim(part, F.lit("0"))).between(0, 3)
        & (F.coalesce(F.try_to_number(F.right(part, F.lit(3)), F.lit("999")), F.lit(0)) <= 255),
    )


@dataclass(frozen=True)
class Kind:
    """`pattern` proposes, `valid` confirms. `prior` is the score of a confirmed span without context; spans
    of kinds that are not `base` are left out below `least`."""

    name: str
    pattern: str
    valid: Callable[[Column], Column]
    prior: float
    base: bool = True
    least: float = 0.5


# Groups and runs are possessive, so that no text makes a matcher backtrack or recurse deeply. A run is
# tried from its first character, or from where the match before ended: later starts in the run fail
# or succeed with the first.
KINDS = [
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda span: F.lit(True),
        0.8,
    ),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _small_parts, 0.6),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        lambda span: F.when(F.length(_digits(span)).between(16, 19), luhn(_digits(span))).otherwise(False),
        0.7,
    ),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda span: F.length(_digits(span)).between(8, 15), 0.7),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        lambda span: mod_97(F.replace(span, F.lit(" "), F.lit(""))),
        0.8,
        base=False,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        lambda span: F.lit(True),
        0.4,
        base=False,
    ),
]


def _placed(matches: Column, gaps: Column) -> Column:
    """Array of (start, end, span, before, after) from the matches of a pattern and the text between them.

    Starts are running sums. They are made in blocks of about the square root of their number, so that
    appending to arrays copies n * sqrt(n) references and not the square of n.
    """
    n = F.size(matches)
    block = F.ceil(F.sqrt(n)).cast("int")

    def extended(state: Column, i: Column) -> Column:
        start = state["at"] + F.length(F.get(gaps, i))
        end = start + F.length(F.get(matches, i))
        entry = F.struct(
            start.cast("long").alias("start"),
            end.cast("long").alias("end"),
            F.get(matches, i).alias("span"),
            F.right(F.get(gaps, i), F.lit(_BEFORE)).alias("before"),
            F.left(F.get(gaps, i + 1), F.lit(_AFTER)).alias("after"),
        )
        return F.struct(end.cast("long").alias("at"), F.array_append(state["out"], entry).alias("out"))

    entries = "array<struct<start:bigint,end:bigint,span:string,before:string,after:string>>"

    def of_block(state: Column, b: Column) -> Column:
        here = F.aggregate(
            F.sequence(b * block, F.least((b + 1) * block, n) - 1),
            F.struct(state["at"].alias("at"), F.array().cast(entries).alias("out")),
            extended,
        )
        return F.struct(here["at"].alias("at"), F.array_append(state["blocks"], here["out"]).alias("blocks"))

    blocks = F.aggregate(
        F.sequence(F.lit(0), F.ceil(n / block).cast("int") - 1),
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{entries}>").alias("blocks")),
        of_block,
        lambda state: F.flatten(state["blocks"]),
    )
    return F.when(n > 0, blocks).otherwise(F.array().cast(entries))


def _scored(kind: Kind, placed: Column) -> Column:
    def nearby(entry: Column, words: str) -> Column:
        around = F.lower(F.concat_ws(" ", entry["before"], entry["after"]))
        return around.rlike(rf"(?<!\p{{L}})(?:{words})")

    def scored(entry: Column) -> Column:
        score = (
            F.lit(kind.prior)
            + F.when(nearby(entry, _NEAR[kind.name]), _CONTEXT).otherwise(0.0)
            - F.when(nearby(entry, _AGAINST), _CONTEXT).otherwise(0.0)
        )
        return F.struct(
            F.lit(kind.name).alias("kind"),
            entry["start"].alias("start"),
            entry["end"].alias("end"),
            F.round(score, 2).alias("score"),
        )

    found = F.transform(F.filter(placed, lambda entry: kind.valid(entry["span"])), scored)
    return found if kind.base else F.filter(found, lambda s: s["score"] >= kind.least)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of personal data per document: `doc_id`, `n_email`, `n_ip`, `n_card`, `n_phone`, `n_iban`, `n_ssn`
    (long) and `found`, an array of (`kind`, `start`, `end`, `score`) by kind as listed in `KINDS`, then start.

    Places count code points, `end` is exclusive. Matches of a kind are leftmost and do not overlap; those
    of different kinds may. Every confirmed match of a base kind is listed whatever its score. Account
    numbers need a mod-97 remainder of 1, social security numbers words nearby that speak for them.
    Null, empty and blank texts have no spans; rows without an id are left out, and rows that repeat an
    id are one document (see `texts_of`); other columns are ignored. An empty table gives no rows.
    """
    rows = texts_of(docs, id_col, text_col)
    rows = rows.withColumns({f"_m_{k.name}": F.regexp_extract_all("text", F.lit(k.pattern), F.lit(0)) for k in KINDS})
    # texts are cut a second time only where something matched
    rows = rows.withColumns(
        {f"_g_{k.name}": F.when(F.size(f"_m_{k.name}") > 0, F.split("text", k.pattern, -1)) for k in KINDS}
    ).drop("text")
    rows = rows.withColumns({f"_p_{k.name}": _placed(F.col(f"_m_{k.name}"), F.col(f"_g_{k.name}")) for k in KINDS})
    rows = rows.withColumns(
        {f"_s_{k.name}": _scored(k, F.col(f"_p_{k.name}")) for k in KINDS}
    )
    return rows.select(
        "doc_id",
        *[F.size(f"_s_{k.name}").cast("long").alias(f"n_{k.name}") for k in KINDS],
        F.flatten(F.array(*[F.col(f"_s_{k.name}") for k in KINDS])).alias("found"),
    )


def listed(found: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def base_spans(found: Column) -> Column:
    base = [k.name for k in KINDS if k.base]
    return F.filter(found, lambda s: s["kind"].isin(base))
