"""Plan building blocks shared by the operators: staging, ranges, block cells, skewed joins."""

from tablework.plans.blocks import block_cells
from tablework.plans.packed import list_parts, pack, unpack
from tablework.plans.ranges import dense_index, running_total
from tablework.plans.skew import join_by_count, join_lookup
from tablework.plans.staging import StagedTables, drop_staged, spread, stage, unnest

__all__ = [
    "StagedTables", "block_cells", "dense_index", "drop_staged", "join_by_count", "join_lookup", "list_parts", "pack", "running_total", "spread", "stage",
    "unnest", "unpack",
]
