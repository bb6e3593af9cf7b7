"""Default parameters, all of which the operators take as arguments."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Defaults:
    # The defaults every published result depends on.
    target_user: int = 10
    neighbors: int = 50
    profile_neighbors: int = 10
    min_common: int = 3
    recommendations: int = 5
    profile_recommendations: int = 10
    similarity_digits: int = 4
    rating_digits: int = 2
    mean_digits: int = 3
    rating_low: float = 0.5
    rating_high: float = 5.0
    min_candidate_ratings: int = 10
    max_contributors: int = 50
    explained_contributors: int = 5
    min_profile_size: int = 5
    loved: float = 4.0
    disliked: float = 2.5
    agreement_gap: float = 1.0
    histogram_bins: int = 20


DEFAULTS = Defaults()

# A side is broadcast only after its rows were counted and found within this.
BROADCAST_ROWS = 500_000

# When no side is broadcast, a single task takes on this many rows of one join key
# from the large side and from the other. The most frequent keys of each side are
# dealt out accordingly, this many of them for each shuffle partition.
SHARE_ROWS = 50_000
SIDE_ROWS = 2_000
SPLIT_KEYS = 10

# Pairs of users, one a common item, that a task adds up: their groups fit into its memory.
PAIR_ROWS = 2_000_000

# Values of others, such as a rating, that the lists of raters hold for all pairs together: beyond so many, and so many
# for each rating, pairs are found in rounds, so that lists take up room in proportion to the ratings.
ROUND_VALUES = 1_000_000_000
ROUND_VALUES_EACH = 27

# Values that stand for a neighbour's rating on its way to the predictions, by what it was found to take.
PREDICTION_VALUES = 27

# An item with more raters than this is large: it may be left out of pair generation
# where an exact rule says that it cannot decide whether there is a pair.
LARGE_RATERS = 5_000

# How many of the most-rated items may be left out of pair generation: the longest array
# of ratings that a user carries for it.
DEFERRED_ITEMS = 1_024

# How many of them one user may leave out at most, which every pair of the user carries along.
DEFERRED_EACH = 8

# Up to this many targets, popular items are not worth looking for beforehand.
FEW_TARGETS = 16

# Popularity ranks that are looked at together for a target without neighbours.
RANK_BLOCK = 256

# Stored ratings: bytes of a row group, the least that a look-up of some ids reads. Up to
# so many ids are looked up by their values, so that scans skip all other row groups.
ROW_GROUP_BYTES = 8 << 20
LOOKUP_IDS = 500
