from tidemark.plans.borders import border_rows, is_after, sortable, tile_ends, with_tiles
from tidemark.plans.calendars import date_series, dense
from tidemark.plans.durable import durable, release, scratch_path, written
from tidemark.plans.joins import null_safe_join
from tidemark.plans.quantiles import exact_quantiles, value_counts
from tidemark.plans.ranking import global_rank
from tidemark.plans.sweep import running_level

__all__ = [
    "border_rows",
    "date_series",
    "dense",
    "durable",
    "exact_quantiles",
    "global_rank",
    "is_after",
    "null_safe_join",
    "release",
    "running_level",
    "scratch_path",
    "sortable",
    "tile_ends",
    "value_counts",
    "with_tiles",
    "written",
]
