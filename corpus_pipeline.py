"""From raw documents to packed training sequences, in stages that each write what the next one reads.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of `docs`,
whatever others there are beside those of documents. Every row is a document of its own: rows without an
id, and rows that repeat one with the same or another text, are judged and kept like all others. Where the
order of documents matters they come by id, unknown ids last, and text. A null text is kept as it is and
counts as an empty one. An empty table stays empty.

All stages hand whole texts to Python, so a stage lowers the session's rows of an Arrow batch to `BATCH_ROWS` and
leaves it so: what it returns is run by the caller. Spark's 10,000 texts of a few kB are tens of MB, several times
over in the JVM and in Python, in every running task.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from temporal_tree.llm import induced, latent, packing, setsketch, toxicity
from temporal_tree.llm.documents import dropped_at_end, row_keys, tables
from temporal_tree.sources.scratch import Scratch

# no stage can be expressed in SQL; tests hold them against brute force
ORACLE_SQL = None

BATCH_ROWS = 1_000
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def small_batches(stage: Stage) -> Stage:
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        # the session may have less already; nothing or less is without limit
        if not 0 < int(spark.conf.get(_ARROW_ROWS)) <= BATCH_ROWS:
            spark.conf.set(_ARROW_ROWS, str(BATCH_ROWS))
        return stage(spark, docs, sf_dir)

    return run_stage


@small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose passages make label 1 likelier than not go. Labels are joined by id to learn from."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels.where(~toxicity.held_out()))
    return toxicity.without_toxic(docs, model)


@small_batches
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the first row stays."""
    scratch = tables(spark)
    keyed, key = row_keys(docs, scratch)
    found = setsketch.near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text"))
    # written first: where they are few, Spark knows and leaves the texts where they are
    gone = scratch.save(found.where("not kept").select(F.col("doc_id").alias(key)), "gone")
    return keyed.join(gone, key, "left_anti").select(*[keyed[c] for c in docs.columns])


@small_batches
def drop_repeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every string of 100 bytes stays where it begins first; what is left of a cut character goes."""
    keyed, key = row_keys(docs, tables(spark))
    return induced.without_repeats(keyed, key, size=100)


@small_batches
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return latent.without_contaminated(docs, benchmark)


@small_batches
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their token ids and places in sequences of 1024 tokens. `doc_id` is the row's id where ids are
    unique and known, else its number in order of id and text."""
    keyed, key = row_keys(docs, tables(spark))
    return packing.pack(keyed.select(F.col(key).alias("doc_id"), "text"), size=1024)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("suffix_dedup", drop_repeated_text),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    last = None
    for name, stage in STAGES[:-1]:
        scratch = Scratch(spark)
        with dropped_at_end():
            docs = scratch.save(stage(spark, docs, sf_dir), name)
        if last is not None:
            last.drop()
        last = scratch
    return STAGES[-1][1](spark, docs, sf_dir)
