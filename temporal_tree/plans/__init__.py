from temporal_tree.plans.pipeline import Result, run

__all__ = ["Result", "run"]
