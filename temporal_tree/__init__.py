"""Account trees that change over time, as PySpark DataFrames."""

from temporal_tree.options import PipelineOptions
from temporal_tree.plans import Result, run
from temporal_tree.sources import (
    RawInputs,
    Scratch,
    load_raw,
    publish_star,
    read_published,
    read_star,
    write_star,
)

__all__ = [
    "PipelineOptions",
    "RawInputs",
    "Result",
    "Scratch",
    "load_raw",
    "publish_star",
    "read_published",
    "read_star",
    "run",
    "write_star",
]
