"""Column expressions shared by the operators."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Source priority, best first. Sources not listed come last.
MAPPING_SOURCES = ("API", "MANUAL")
FACT_SOURCES = ("API", "INHERITANCE", "MANUAL")


def yes(flag: str) -> Column:
    """'Y' to 1, anything else (NULL too) to 0."""
    return F.when(F.col(flag) == "Y", 1).otherwise(0)


def _rank(source: Column, order: tuple[str, ...]) -> Column:
    # array_position is 0 for an absent value and NULL for a NULL source
    position = F.array_position(F.array(*[F.lit(s) for s in order]), source)
    return F.coalesce(F.nullif(position, F.lit(0)), F.lit(len(order) + 1)).cast("int")


def mapping_source_rank(source: str | Column = "source") -> Column:
    """Priority of a mapping's source, 1 = best; the source is compared in upper case."""
    source = F.col(source) if isinstance(source, str) else source
    return _rank(F.upper(source), MAPPING_SOURCES)


def fact_source_rank(source: str | Column = "source") -> Column:
    """Priority of a fact row's source, 1 = best."""
    source = F.col(source) if isinstance(source, str) else source
    return _rank(source, FACT_SOURCES)


def trace(path: str | Column = "path") -> Column:
    """A path array rendered as 'A/B/C'."""
    return F.concat_ws("/", path)


def moment(at: datetime | None = None) -> Column:
    """A timestamp literal without time zone; the present UTC time, taken now, if none is given."""
    at = at or datetime.now(timezone.utc)
    return F.lit(at.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
