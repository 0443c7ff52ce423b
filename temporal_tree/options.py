"""Options of a pipeline run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

_CHOICES = {
    "unmapped_flags": ("partner", "always"),
    "succession_key": ("child", "manager"),
    "closure_method": ("doubling", "cte"),
    "persist": ("table", "cache", "none"),
}


@dataclass(frozen=True)
class PipelineOptions:
    """What to compute, and how much one task may be given.

    max_depth        longest path, in edges
    half_open        a mapping that ends on day d covers d (breakpoint d+1) instead of d-1
    keep_unmapped    keep periods in which the parent manages nothing
    unmapped_flags   flags on those rows: from partner status, or always 1
    succession_key   whose last mapped day ends the hierarchy: the child or the manager itself
    collapse         build the fact from edges and date spans; False walks every path and segment
    closure_method   'doubling' (default) or 'cte' (recursive SQL)
    one_row_per_account  account dimension keeps only PARTNER where an account is both kinds
    partition_by_account  keep the fact gathered by account, for repeated joins
    validate         build the check reports; a batch writes them to its log
    persist          how intermediate results that are read more than once are kept:
                     'table' (written, lineage cut), 'cache' or 'none'
    load_ts          value of created_at; taken once per run when None
    cell_rows        join keys that would produce more rows than this are split
    hot_account_rows accounts with more fact rows than this are spread over several tasks
    rows_per_task    fact rows that one task sorts
    """

    max_depth: int = 12
    half_open: bool = False
    keep_unmapped: bool = False
    unmapped_flags: str = "partner"
    succession_key: str = "child"
    collapse: bool = True
    closure_method: str = "doubling"
    one_row_per_account: bool = False
    partition_by_account: bool = False
    validate: bool = True
    persist: str = "table"
    load_ts: datetime | None = None
    cell_rows: int = 1_000_000
    hot_account_rows: int = 1_000_000
    rows_per_task: int = 10_000_000

    def __post_init__(self):
        for name, allowed in _CHOICES.items():
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {allowed}")
        if self.max_depth < 1:
            raise ValueError("max_depth must be at least 1")
        for name in ("cell_rows", "hot_account_rows", "rows_per_task"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be positive")
