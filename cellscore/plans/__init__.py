"""Helpers that shape physical plans: lineage cuts, size-checked broadcasts, numbering, and rules checked as rows pass."""

from cellscore.plans.guards import Guard
from cellscore.plans.lineage import cut_lineage, numbered_within, small_enough

__all__ = ["Guard", "cut_lineage", "numbered_within", "small_enough"]
