"""User-based collaborative filtering on Spark DataFrames."""

from kinrate.config import DEFAULTS, Defaults
from kinrate.plans.batch import run_batch
from kinrate.plans.comparing import Comparison
from kinrate.plans.maintained import MaintainedAverages, rating_changes
from kinrate.plans.prepared import (
    Prepared,
    Targets,
    find_similar_users,
    load_prepared,
    load_targets,
    nearest_of_all,
    pooled_similarities,
    prepare,
    recommend,
)
from kinrate.plans.profiles import NewUsers
from kinrate.plans.storage import scratch
from kinrate.sources.files import read_items, read_ratings, read_table, write_table

__all__ = [
    "Comparison",
    "DEFAULTS",
    "Defaults",
    "MaintainedAverages",
    "NewUsers",
    "Prepared",
    "Targets",
    "find_similar_users",
    "load_prepared",
    "load_targets",
    "nearest_of_all",
    "pooled_similarities",
    "prepare",
    "rating_changes",
    "read_items",
    "read_ratings",
    "read_table",
    "recommend",
    "run_batch",
    "scratch",
    "write_table",
]
