"""What the corpus operators share: one row per document, and where intermediate tables go."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from temporal_tree.operators.numbering import number_in_place
from temporal_tree.sources.scratch import Scratch


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id` (long) and `text`, one row per document; a null text is empty.

    Rows without an id are no documents and are left out. Ids are expected to be unique; where they
    repeat, which one narrow count of the id column tells, the least text of an id is the document.
    Other columns, whatever their names, are not looked at.
    """
    texts = docs.select(
        docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text")
    ).where(F.col("doc_id").isNotNull())
    if texts.groupBy("doc_id").count().where("count > 1").isEmpty():
        return texts
    return texts.groupBy("doc_id").agg(F.min("text").alias("text"))


_collecting: list[list[Scratch]] = []


def tables(spark) -> Scratch:
    """A folder for the intermediate tables of one call, below the session's checkpoint folder."""
    scratch = Scratch(spark)
    for made in _collecting:
        made.append(scratch)
    return scratch


@contextmanager
def dropped_at_end():
    """Deletes all folders of `tables` made inside the block, so what depends on them must be written by then."""
    _collecting.append([])
    try:
        yield
    finally:
        for scratch in _collecting.pop():
            scratch.drop()


def row_keys(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, str]:
    """`docs` with a column, named by the second value, that tells all rows apart and is in order of `doc_id`.

    That is the id itself where ids are unique and known, which one narrow count tells. Else rows are numbered
    in order of id, unknown ones last, and text, so that rows without an id and rows that repeat one are
    documents of their own.
    """
    name = "_row"
    while name in docs.columns:
        name += "_"
    if docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").isEmpty():
        return docs.withColumn(name, F.col("doc_id").cast("long")), name
    whole = docs.select(F.struct(*docs.columns).alias("doc")).withColumn("copy", F.monotonically_increasing_id())
    order = [F.col("doc.doc_id").asc_nulls_last(), F.col("doc.text"), F.col("copy")]
    numbered = number_in_place(whole.repartitionByRange(*order).sortWithinPartitions(*order), "place", scratch)
    return numbered.select("doc.*", F.col("place").alias(name)), name


def partitions(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
