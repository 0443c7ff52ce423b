from temporal_tree.sources.published import publish_star, read_published
from temporal_tree.sources.raw import RawInputs, load_raw
from temporal_tree.sources.scratch import Scratch
from temporal_tree.sources.star import read_star, write_star

__all__ = [
    "RawInputs",
    "Scratch",
    "load_raw",
    "publish_star",
    "read_published",
    "read_star",
    "write_star",
]
