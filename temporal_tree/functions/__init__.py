from temporal_tree.functions.columns import (
    fact_source_rank,
    mapping_source_rank,
    moment,
    trace,
    yes,
)

__all__ = ["fact_source_rank", "mapping_source_rank", "moment", "trace", "yes"]
