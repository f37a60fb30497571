from tripmart.operators.links import extract_links
from tripmart.operators.manifest import mark_available, month_grid, run_grid, split_available
from tripmart.operators.relational import conform_constants, dedup_first, sample, sample_groups, tag_union
from tripmart.operators.roles import fits_broadcast, join_roles

__all__ = [
    "conform_constants",
    "dedup_first",
    "extract_links",
    "fits_broadcast",
    "join_roles",
    "mark_available",
    "month_grid",
    "run_grid",
    "sample",
    "sample_groups",
    "split_available",
    "tag_union",
]
