"""The five stages, extract to star schema, as one call or one at a time."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from temporal_tree.functions import trace
from temporal_tree.operators import closure, extract, normalize, parts, quality, star, temporal
from temporal_tree.options import PipelineOptions
from temporal_tree.sources.raw import RawInputs
from temporal_tree.sources.resumable import ResumableScratch, fingerprint
from temporal_tree.sources.scratch import Scratch

# tables up to this size of files are broadcast while a run's tables are made
_BROADCAST_BYTES = 1 << 20


@dataclass
class Run:
    """Options and scratch tables of one run, shared by its stages."""

    options: PipelineOptions
    scratch: Scratch
    cached: list[DataFrame] = field(default_factory=list)

    def keep(self, build: Callable[[], DataFrame], name: str) -> DataFrame:
        """What `build` makes, in the form the options ask for when it is read more than once. It is not
        called where the table is taken over from a run before."""
        if self.options.persist == "table":
            return self.scratch.stage(name, build)
        df = build()
        if self.options.persist == "cache":
            df = df.persist(StorageLevel.MEMORY_AND_DISK)
            self.cached.append(df)
        return df

    def keep_all(self, **named: Callable[[], DataFrame]) -> list[DataFrame]:
        """`keep` for results that do not depend on each other: their jobs share the cluster."""
        keep = inheritable_thread_target(self.scratch.spark)(self.keep)
        with ThreadPoolExecutor(len(named)) as pool:
            return list(pool.map(keep, named.values(), named))


class Normalized:
    """Edges, kinds and best mappings. Each table is made, and written, when it is first used."""

    def __init__(self, extracted: RawInputs, run: Run):
        self._extracted, self._run = extracted, run

    @cached_property
    def entity_types(self) -> DataFrame:
        # not kept: most uses want partners only, for which Catalyst drops the scan of mappings
        return normalize.entity_types(self._extracted.partners, self._extracted.mappings)

    def _new_edges(self) -> DataFrame:
        newest = normalize.latest_relationships(self._extracted.relationships)
        return closure.flag_edges(newest, self.entity_types)

    def _new_mappings(self) -> DataFrame:
        return normalize.best_mappings(self._extracted.mappings)

    @cached_property
    def edges(self) -> DataFrame:
        """The newest edges, with the partner status of both ends."""
        return self._run.keep(self._new_edges, "edges")

    @cached_property
    def mappings(self) -> DataFrame:
        """The best mappings."""
        return self._run.keep(self._new_mappings, "best_mappings")

    def both(self) -> tuple[DataFrame, DataFrame]:
        """Edges and mappings for those who need both: their jobs share the cluster."""
        if not {"edges", "mappings"} & self.__dict__.keys():
            self.edges, self.mappings = self._run.keep_all(
                edges=self._new_edges, best_mappings=self._new_mappings
            )
        return self.edges, self.mappings


class Temporal:
    """Date-aware intermediates, each made when it is first used. `hierarchy` is a function that builds
    it: only segments need one. In the literal form the fact comes from segments, in the collapsed
    form from spans."""

    def __init__(self, normalized: Normalized, hierarchy: Callable[[], DataFrame], run: Run):
        self._normalized, self._hierarchy, self._run = normalized, hierarchy, run

    @cached_property
    def calendar(self) -> DataFrame:
        edges, mappings = self._normalized.both()
        cuts = temporal.periods(mappings, edges, self._run.options.half_open)
        return self._run.keep(lambda: temporal.calendar(cuts), "calendar")

    @cached_property
    def periods(self) -> DataFrame:
        return temporal.numbered_periods(self.calendar).select("period_start", "period_end")

    @cached_property
    def covered(self) -> DataFrame:
        # not kept: two broadcast lookups cost less than writing the spans of every mapping
        return temporal.coverage(self._normalized.mappings, self.calendar)

    def _segments(self, hierarchy: DataFrame, keep_unmapped: bool, spread: bool) -> DataFrame:
        options = self._run.options
        rows = temporal.segments(
            hierarchy,
            self.periods,
            self._normalized.mappings,
            keep_unmapped=keep_unmapped,
            cell_rows=options.cell_rows,
            days=self.calendar,
            scratch=self._run.scratch,
            spread=spread,
        )
        return temporal.inherit(rows, options.unmapped_flags)

    @cached_property
    def segments(self) -> DataFrame:
        """What the literal fact is made of: every path with each span of its parent, not spread over periods,
        and with the order of the roots of each parent."""

        def build() -> DataFrame:
            rooted = self._run.scratch.save(temporal.root_order(self._hierarchy()), "rooted")
            return self._segments(rooted, self._run.options.keep_unmapped, spread=False)

        return self._run.keep(build, "segments")

    @cached_property
    def all_segments(self) -> DataFrame:
        """Every path in every period, mapped or not, whatever the form of the fact."""
        if not self._run.options.collapse and self._run.options.keep_unmapped:
            return temporal.spread_segments(self.segments.drop("root_order"), self.calendar)
        return self._segments(self._hierarchy(), True, spread=True)

    @cached_property
    def standalone(self) -> DataFrame:
        kinds, key = self._normalized.entity_types, self._run.options.succession_key
        if not self._run.options.collapse:
            return temporal.succession(self.segments, kinds, key, self.calendar)
        return temporal.succession_from_spans(
            self._normalized.edges, self.covered, self.calendar, kinds, key
        )

    @cached_property
    def measured_spans(self) -> tuple[DataFrame, int, int]:
        """Spans, the fact rows they stand for (before deduplication) and their number."""
        options = self._run.options
        # always written: sampling, weighing and spreading each read it
        spans, seen = self._run.scratch.stage_measured(
            "spans",
            lambda: star.fact_spans(
                self._normalized.edges,
                self.covered,
                self.calendar,
                self.standalone,
                keep_unmapped=options.keep_unmapped,
                unmapped_flags=options.unmapped_flags,
            ),
            rows=F.coalesce(F.sum(F.col("hi") - F.col("lo") + 1), F.lit(0)),
            spans=F.count(F.lit(1)),
        )
        return spans, seen["rows"], seen["spans"]


class Star:
    """The fact and its dimensions, each made when it is first used. Dimensions of the collapsed form
    come from spans and need no fact."""

    def __init__(self, times: Temporal, normalized: Normalized, run: Run):
        self._times, self._normalized, self._run = times, normalized, run

    @cached_property
    def _consolidated(self) -> DataFrame:
        return star.consolidate(
            self._times.segments,
            self._times.standalone,
            keep_unmapped=self._run.options.keep_unmapped,
            days=self._times.calendar,
        )

    @cached_property
    def fact(self) -> DataFrame:
        options, scratch = self._run.options, self._run.scratch
        if not options.collapse:
            rows = star.fact(self._consolidated, scratch, options.load_ts)
        else:
            spans, total_rows, total_spans = self._times.measured_spans
            rows = star.fact_from_spans(
                spans,
                self._times.calendar,
                scratch,
                total_rows=total_rows,
                total_spans=total_spans,
                load_ts=options.load_ts,
                hot_account_rows=options.hot_account_rows,
                rows_per_task=options.rows_per_task,
            )
        if options.partition_by_account:
            rows = star.by_account(rows)
            self._run.cached.append(rows)
        return rows

    @cached_property
    def dim_accounts(self) -> DataFrame:
        options = self._run.options
        accounts = self._times.measured_spans[0] if options.collapse else self.fact
        return star.dim_accounts(
            accounts,
            self._normalized.entity_types,
            options.load_ts,
            one_row_per_account=options.one_row_per_account,
        )

    @cached_property
    def dim_date(self) -> DataFrame:
        if not self._run.options.collapse:
            return star.dim_date(self.fact)
        return star.dim_date_from_spans(self._times.measured_spans[0], self._times.calendar)

    def tables(self) -> dict[str, DataFrame]:
        """By the names they are written under."""
        return {
            "fact_account_hierarchy": self.fact,
            "dim_accounts": self.dim_accounts,
            "dim_date": self.dim_date,
        }


def extract_stage(raw: RawInputs) -> RawInputs:
    return RawInputs(
        extract.relationships(raw.relationships),
        extract.partners(raw.partners),
        extract.mappings(raw.mappings),
    )


def hierarchy_stage(normalized: Normalized, run: Run) -> DataFrame:
    nodes = closure.paths(
        normalized.edges,
        run.options.max_depth,
        run.options.closure_method,
        scratch=run.scratch,
        cell_rows=run.options.cell_rows,
    )
    return closure.root_flags(nodes)


@dataclass(frozen=True)
class Result:
    """The stages of a run. A table is computed when it, or one made from it, is first used. That
    starts jobs of its own: tables that are read more than once are written then, not by the action
    that follows. In a `with` block the run's tables are deleted at the end; those of a run that can be
    resumed stay where an error ends the block."""

    run: Run
    raw: RawInputs
    extracted: RawInputs

    @cached_property
    def normalized(self) -> Normalized:
        return Normalized(self.extracted, self.run)

    @cached_property
    def hierarchy(self) -> DataFrame:
        """Every path with its flags. The collapsed fact does not depend on it."""
        return hierarchy_stage(self.normalized, self.run)

    @cached_property
    def cycle_parts(self) -> DataFrame:
        """Accounts on cycles by strongly connected part."""
        return parts.cycle_parts(self.normalized.edges, scratch=self.run.scratch)

    @cached_property
    def edges_on_cycles(self) -> DataFrame:
        return parts.inside_parts(self.normalized.edges, self.cycle_parts)

    @cached_property
    def path_counts(self) -> DataFrame:
        """How many paths the hierarchy has per parent and level, without the hierarchy."""
        options = self.run.options
        return self.run.keep(
            lambda: parts.path_counts(
                self.normalized.edges,
                options.max_depth,
                members=self.cycle_parts,
                scratch=self.run.scratch,
                cell_rows=options.cell_rows,
            ),
            "path-counts",
        )

    @cached_property
    def temporal(self) -> Temporal:
        return Temporal(self.normalized, lambda: self.hierarchy, self.run)

    @cached_property
    def star(self) -> Star:
        return Star(self.temporal, self.normalized, self.run)

    def check(self, name: str) -> DataFrame:
        """The report of one stage: relationships, mappings, hierarchy, segments or fact."""
        return _CHECKS[name](self)

    @cached_property
    def checks(self) -> dict[str, DataFrame]:
        """The reports of all stages; empty when validation is off."""
        names = _CHECKS if self.run.options.validate else ()
        return {name: self.check(name) for name in names}

    def create_views(self, *names: str) -> list[str]:
        """Register stage tables as temporary views for SQL: all of them, or those named.

        A view of a later stage computes what it depends on when it is registered."""
        for name in names or _VIEWS:
            _VIEWS[name](self).createOrReplaceTempView(name)
        return list(names or _VIEWS)

    def release(self) -> None:
        """Release caches."""
        for df in self.run.cached:
            df.unpersist()

    def close(self) -> None:
        """Release caches and delete the run's scratch tables; its DataFrames stop working."""
        self.release()
        self.run.scratch.drop()

    def __enter__(self) -> Result:
        return self

    def __exit__(self, error, *_) -> None:
        if error is not None and isinstance(self.run.scratch, ResumableScratch):
            self.release()
        else:
            self.close()


def _raw_edges(result: Result) -> DataFrame:
    """The edges as they came in, under the names of the clean ones."""
    return result.raw.relationships.select(
        F.col("entity_id_one").alias("parent_account_id"),
        F.col("entity_id_two").alias("child_account_id"),
    )


def _check_segments(result: Result) -> DataFrame:
    first_level = result.normalized.edges.withColumn("level_depth", F.lit(1))
    managed = temporal.managed_spans(
        first_level, result.normalized.mappings, result.temporal.calendar
    )
    return quality.segments(
        result.path_counts, managed, result.normalized.mappings, result.run.options.max_depth
    )


_CHECKS = {
    "relationships": lambda r: quality.relationships(_raw_edges(r), r.normalized.edges),
    "mappings": lambda r: quality.mappings(r.normalized.mappings),
    "hierarchy": lambda r: quality.hierarchy(
        r.path_counts, r.edges_on_cycles, r.run.options.max_depth
    ),
    "segments": _check_segments,
    "fact": lambda r: quality.fact(
        r.star.fact, r.temporal.measured_spans[1] if r.run.options.collapse else None
    ),
}


_VIEWS = {
    "account_relationships": lambda r: r.extracted.relationships,
    "partner_accounts": lambda r: r.extracted.partners,
    "account_mappings": lambda r: r.extracted.mappings,
    "normalized_relationships": lambda r: r.normalized.edges,
    "entity_types": lambda r: r.normalized.entity_types,
    "clean_mappings": lambda r: r.normalized.mappings,
    "hierarchy": lambda r: r.hierarchy.withColumn("path_trace", trace()),
    "date_breakpoints": lambda r: r.temporal.periods,
    "temporal_segments": lambda r: r.temporal.all_segments,
    "post_hierarchy": lambda r: r.temporal.standalone,
    "fact_account_hierarchy": lambda r: r.star.fact,
    "dim_accounts": lambda r: r.star.dim_accounts,
    "dim_date": lambda r: r.star.dim_date,
}


def run(
    raw: RawInputs, options: PipelineOptions | None = None, *, resume: str | None = None
) -> Result:
    """All five stages. Nothing is computed before a table of the result is used.

    Scratch tables go to the session's spark.checkpoint.dir; `Result.close` deletes them.

    With `resume`, a folder that driver and executors share, the tables of the stages go there, and those
    that a run before has finished over the same inputs with the same options are taken over. The inputs
    are told apart by their content, which is one pass over the raw tables at the start. Other inputs or
    options have tables of their own in the same folder.
    """
    options = options or PipelineOptions()
    spark = raw.relationships.sparkSession
    raw = raw.conformed()
    if resume is None:
        scratch = Scratch(spark, broadcast_bytes=_BROADCAST_BYTES)
    elif options.persist != "table":
        raise ValueError("only written tables can be resumed: persist must be 'table'")
    else:
        # reports change no table
        scratch = ResumableScratch(
            spark,
            resume,
            fingerprint(raw, replace(options, validate=True)),
            broadcast_bytes=_BROADCAST_BYTES,
        )
    if options.load_ts is None:
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        if resume is not None:
            now = datetime.fromisoformat(scratch.remember("load-ts", now.isoformat()))
        options = replace(options, load_ts=now)
    state = Run(options, scratch)
    return Result(state, raw, extract_stage(raw))
