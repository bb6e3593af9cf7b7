"""Mean-centred Pearson similarity between users.

Deviations are taken from each user's mean over all of the user's ratings, not
over the co-rated ones, so the built-in correlation does not apply.

A *profile* table holds the rated items of all targets:
``targetId, movieId, target_rating, target_mean``.

All forms below first add up raw ratings per pair and centre the sums afterwards.
With n shared items, S, Q and P the sums of ratings, squares and products, and m
the means:

    dot  = P - m_v*S_u - m_u*S_v + n*m_u*m_v
    sq_u = Q_u - 2*m_u*S_u + n*m_u*m_u        (sq_v alike)

So means are joined to one row per pair, not to every rating, and sums of
half-step ratings are exact whatever the order in which tasks deliver them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from kinrate.config import DEFAULTS, DEFERRED_EACH, DEFERRED_ITEMS, LARGE_RATERS, SHARE_ROWS, SIDE_ROWS
from kinrate.functions.scores import pearson, round_half_up
from kinrate.operators.joins import heavy_keys, join_lists, join_side, top_per

PAIR = ("targetId", "userId")
SUMS = ("n", "p", "s_u", "s_v", "q_u", "q_v")
# Fixed value: comes after the place of every item.
NO_PLACE = 2**31 - 1
Keep = Callable[[DataFrame, str], DataFrame]
Tasks = Callable[[DataFrame, DataFrame], int | None]
Found = Callable[[DataFrame, int | None], DataFrame]
Rounds = Callable[[Found, DataFrame, DataFrame, str, bool, int | None, str], DataFrame]


def as_is(df: DataFrame, name: str) -> DataFrame:
    """Keeps nothing: each use of a table works it out again."""
    return df


def as_planned(left: DataFrame, right: DataFrame) -> None:
    """Leaves the number of tasks that pairs are dealt to to Spark."""


def at_once(
    found: Found, left: DataFrame, right: DataFrame, user: str, above: bool, tasks: int | None, name: str
) -> DataFrame:
    """``found`` in all rows of ``left``: what it makes of their pairs with those of ``right``.

    As all pairs of a ``user`` are found together, others may find them one part of the users after
    the other and store what they found, so that only the lists of one part take up room at a time.
    ``above`` says that each pair is met from one side only.
    """
    return found(left, tasks)


# A centred sum of squares this small against the raw one is rounding noise: a
# mean kept to three digits leaves a share of at least 1e-8 unless it is zero.
NO_VARIANCE = 1e-12


def target_ratings(ratings: DataFrame, targets: DataFrame) -> DataFrame:
    """The rating rows of the users in ``targets(targetId)``."""
    return ratings.join(targets, ratings.userId == targets.targetId).select(
        "targetId", "movieId", "rating"
    )


def target_means(averages: DataFrame, targets: DataFrame) -> DataFrame:
    """``targetId, target_mean`` of the targets that have ratings."""
    return averages.join(targets, averages.userId == targets.targetId).select(
        "targetId", F.col("avg_rating").alias("target_mean")
    )


def target_profiles(
    ratings: DataFrame, means: DataFrame, broadcast_targets: bool = False
) -> DataFrame:
    """The targets' ratings, each with its target's mean.

    ``means`` is :func:`target_means`; broadcast where its rows were counted.
    """
    side = F.broadcast(means) if broadcast_targets else means
    return ratings.join(side, ratings.userId == side.targetId).select(
        "targetId", "movieId", F.col("rating").alias("target_rating"), "target_mean"
    )


def co_ratings(
    ratings: DataFrame,
    profiles: DataFrame,
    broadcast_profiles: bool = False,
    share_rows: int = SHARE_ROWS,
    side_rows: int = SIDE_ROWS,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Every rating of another user for an item that a target rated too.

    Each rating meets each target at most once, so the result grows with the
    number of targets and not with the square of an item's raters.
    """
    others = ratings.select("userId", "movieId", "rating", *carry)
    return join_side(
        others,
        profiles,
        "movieId",
        "userId",
        "targetId",
        broadcast_profiles,
        share_rows,
        side_rows,
    ).filter(F.col("userId") != F.col("targetId"))


def _pairs(
    left: DataFrame,
    right: DataFrame,
    u: str,
    v: str,
    above: bool,
    count: int | None,
    share_rows: int,
    side_rows: int,
) -> DataFrame:
    """A row per common item of two users ``u, v``: the columns of both sides, ``_block`` and no item.

    ``above`` keeps the pairs ``u < v`` only. What is shuffled are not pairs but the rows of u,
    each with a list of an item's raters, one array a column. All pairs of a user and
    ``_block`` then stand in one task, so that grouping them by ``u, _block, v`` needs no
    further shuffle. A user with very many rows has several blocks, dealt by v. Users without
    blocks take a list as it is: going through its elements costs more than dropping their own.
    ``count`` is the number of tasks, if it is given.
    """
    # fewer tasks for the lists, so that the shuffle's blocks do not grow with the square
    before = min(count, count // 4 + 8) if count else None
    met = join_lists(left, right, "movieId", u, v, "_met", share_rows, side_rows, before)
    heavy = heavy_keys(left, u, share_rows, "_blocks")
    blocks = F.coalesce("_blocks", F.lit(1))

    def in_block(x: Column) -> Column:
        return F.pmod(F.xxhash64(x[v]), F.col("_blocks")) == F.col("_block")

    wanted = F.when(F.col("_blocks").isNull(), F.col("_met")).otherwise(F.filter("_met", in_block))
    others_only = F.col(u) < F.col(v) if above else F.col(u) != F.col(v)
    if above:
        # lists are in order of v, and mostly hold the row's own user: the others come after
        place = F.array_position(F.col("_met")[v], F.col(u)).cast("int")
        later = F.slice("_met", place + 1, F.size("_met"))
        met = met.withColumn(
            "_met", F.when(place > 0, later).otherwise(F.filter("_met", lambda x: x[v] > F.col(u)))
        )
    own = [c for c in left.columns if c != "movieId"]
    others = [c for c in right.columns if c != "movieId"]
    dealt = (
        met.join(F.broadcast(heavy), u, "left")
        .withColumn("_block", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("_met", wanted)
        .select(*own, "_block", *[F.col("_met")[c].alias(c) for c in others])
    )
    by = ([count] if count else []) + [u, "_block"]
    met = dealt.repartition(*by).select(*own, "_block", F.inline(F.arrays_zip(*others)))
    return met.filter(others_only)


def _centred_square(n: Column, s: Column, q: Column, m: Column) -> Column:
    centred = q - 2 * m * s + n * m * m
    return F.when(centred > q * NO_VARIANCE, centred).otherwise(0.0)


def _centred(sums: DataFrame) -> DataFrame:
    """Adds ``dot, sq_u, sq_v`` from the columns ``n, p, s_u, s_v, q_u, q_v, m_u, m_v``.

    As columns of their own, so that what reads them several times does not repeat their terms.
    """
    n, p, s_u, s_v, q_u, q_v, m_u, m_v = (F.col(c) for c in (*SUMS, "m_u", "m_v"))
    return sums.withColumns(
        {
            "dot": p - m_v * s_u - m_u * s_v + n * m_u * m_v,
            "sq_u": _centred_square(n, s_u, q_u, m_u),
            "sq_v": _centred_square(n, s_v, q_v, m_v),
        }
    )


def _similarity(on_zero_variance: str) -> Column:
    """Pearson from the columns of :func:`_centred`, not yet rounded."""
    similarity = pearson(F.col("dot"), F.col("sq_u"), F.col("sq_v"))
    if on_zero_variance == "zero":
        return F.coalesce(similarity, F.lit(0.0))
    if on_zero_variance not in ("drop", "null"):
        raise ValueError("on_zero_variance must be 'zero', 'drop' or 'null'")
    return similarity


def _scored(sums: DataFrame, keys, on_zero_variance: str, digits: int | None) -> DataFrame:
    exact = _centred(sums).withColumn("_exact", _similarity(on_zero_variance))
    scored = exact.select(
        *keys,
        round_half_up(F.col("_exact"), digits).alias("similarity"),
        F.col("n").cast("bigint").alias("common_movies"),
    )
    if on_zero_variance == "drop":
        return scored.filter(F.col("similarity").isNotNull())
    return scored


def _pair_sums(left: Column, right: Column) -> list[Column]:
    left, right = left.cast("double"), right.cast("double")
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum(left * right).alias("p"),
        F.sum(left).alias("s_u"),
        F.sum(right).alias("s_v"),
        F.sum(left * left).alias("q_u"),
        F.sum(right * right).alias("q_v"),
    ]


def _other_means(averages: DataFrame, min_candidate_ratings: int | None = None) -> DataFrame:
    if min_candidate_ratings is not None:
        averages = averages.filter(F.col("num_ratings") >= min_candidate_ratings)
    return averages.select("userId", F.col("avg_rating").alias("m_v"))


def _set_aside(min_common: int) -> int:
    """How many items a user may set aside, at most ``DEFERRED_EACH``."""
    return min(min_common - 1, DEFERRED_EACH)


def _hot_vectors(ratings: DataFrame, hot: DataFrame, defer: int) -> DataFrame:
    """Per user the ratings of hot items, the ``defer`` most-rated ones marked.

    ``hot`` has at most a fixed number of items, which bounds each array. ``place`` numbers
    them from the most-rated one on.
    """
    order = Window.orderBy(F.col("raters").desc(), "movieId")
    places = hot.select("movieId", F.row_number().over(order).alias("place"))
    rated = F.struct("place", "movieId", F.col("rating").cast("double").alias("rating"))
    ranked = (
        ratings.join(F.broadcast(places), "movieId")
        .groupBy("userId")
        .agg(F.sort_array(F.collect_list(rated)).alias("ranked"))
    )
    return ranked.select(
        "userId",
        F.transform(
            "ranked",
            lambda x, i: F.struct(
                x["place"].alias("place"),
                x["movieId"].alias("movieId"),
                x["rating"].alias("rating"),
                (i < defer).alias("deferred"),
            ),
        ).alias("hot"),
    )


def _late_columns(defer: int, ratings: bool = True) -> list[str]:
    """What each row says of the items its user set aside: see :func:`_undeferred`."""
    return [
        "edge",
        *[f"place{i}" for i in range(defer)],
        *[f"late{i}" for i in range(defer) if ratings],
    ]


def _undeferred(rows: DataFrame, vectors: DataFrame, defer: int, user: str = "userId") -> DataFrame:
    """Ratings that generate pairs, with what their user set aside.

    That is ``place0, place1, ...`` and the ratings ``late0, late1, ...``. An item that this user
    rated and did not set aside comes after the place ``edge``, so that there is none
    unless the user has more hot items than were set aside.
    """
    item = [F.get("hot", F.lit(i)) for i in range(defer)]
    edge = F.when(F.size("hot") > defer, item[-1]["place"]).otherwise(NO_PLACE)
    marks = vectors.select(
        F.col("userId").alias(user),
        edge.alias("edge"),
        *[F.when(x["rating"].isNotNull(), x["place"]).alias(f"place{i}") for i, x in enumerate(item)],
        *[x["rating"].alias(f"late{i}") for i, x in enumerate(item)],
        F.transform(F.slice("hot", 1, defer), lambda x: x["movieId"]).alias("_ids"),
    )
    none = F.array().cast("array<bigint>")
    return (
        rows.join(marks, user, "left")
        .filter(~F.array_contains(F.coalesce("_ids", none), F.col("movieId")))
        .withColumn("edge", F.coalesce("edge", F.lit(NO_PLACE)))
        .drop("_ids")
    )


def _late_sums(names: Sequence[str], defer: int, means: bool) -> dict[str, Column]:
    """What a pair shares among the items that both users set aside, as additions to its sums.

    ``open`` is how many more items the pair may share that one of the two set aside. Such an
    item comes after all that the other one set aside, so only one of the two can have any.
    With ``means``, ``x_u`` and ``x_v`` are the squared deviations of these items.
    """
    zero, added = F.lit(0.0), dict.fromkeys(names, F.lit(0.0))
    for i in range(defer):
        x, y, hit = F.col(f"late{i}_u"), F.col(f"_met{i}"), F.col(f"_met{i}").isNotNull()
        values = {"n": F.lit(1.0), "p": x * y, "s_u": x, "s_v": y, "q_u": x * x, "q_v": y * y}
        added = {c: added[c] + F.when(hit, values[c]).otherwise(zero) for c in names}

    def after(side: str, other: str, value) -> Column:
        parts = [
            F.when(F.col(f"place{i}_{side}") > F.col(f"edge_{other}"), value(i)).otherwise(zero)
            for i in range(defer)
        ]
        return reduce(Column.__add__, parts)

    def deviation(side: str):
        return lambda i: (F.col(f"late{i}_{side}") - F.col(f"m_{side}")) * (
            F.col(f"late{i}_{side}") - F.col(f"m_{side}")
        )

    sides = (("u", "v"), ("v", "u"))
    found = {f"_late_{c}": value for c, value in added.items()}
    found["open"] = F.greatest(*[after(a, b, lambda i: F.lit(1.0)) for a, b in sides])
    if means:
        found |= {f"x_{a}": after(a, b, deviation(a)) for a, b in sides}
    return found


def _summed(
    pairs: DataFrame,
    keys: Sequence[str],
    sums: Sequence[Column],
    names: Sequence[str],
    carried: Sequence[str] = (),
    defer: int = 0,
    means: bool = False,
) -> DataFrame:
    """The sums ``names`` of each pair, over shared items that not just one of the two set aside.

    What both set aside is read off the columns of their rows, before these are grouped, so
    that no pair is joined with its users again.
    """
    most = [F.max(c).alias(c) for c in carried]
    if not defer:
        return pairs.groupBy(*keys).agg(*sums, *most)
    rating = (lambda j: F.col(f"late{j}_v")) if "p" in names else (lambda j: F.lit(1.0))
    met = {
        f"_met{i}": F.coalesce(
            *[F.when(F.col(f"place{i}_u") == F.col(f"place{j}_v"), rating(j)) for j in range(defer)]
        )
        for i in range(defer)
    }
    late = _late_sums(names, defer, means)
    grouped = (
        pairs.withColumns(met)
        .withColumns(late)
        .groupBy(*keys)
        .agg(*sums, *most, *[F.max(c).alias(c) for c in late])
    )
    return grouped.withColumns({c: F.col(c) + F.col(f"_late_{c}") for c in names}).drop(
        *[f"_late_{c}" for c in names]
    )


def _add_open(
    sums: DataFrame, u: str, vectors_u: DataFrame, v: str, vectors_v: DataFrame
) -> DataFrame:
    """Add to each pair the shared items that just one of the two had set aside."""
    both = sums.join(
        vectors_u.select(F.col("userId").alias(u), F.col("hot").alias("_hot_u")), u
    ).join(vectors_v.select(F.col("userId").alias(v), F.col("hot").alias("_hot_v")), v)

    def deferred(hot: str) -> Column:
        return F.filter(hot, lambda x: x["deferred"])

    def rating(hot: str, item: Column) -> Column:
        rated = F.filter(hot, lambda y: ~y["deferred"] & (y["movieId"] == item))
        return F.get(rated, F.lit(0))["rating"]

    shared = F.concat(
        F.transform(
            deferred("_hot_u"),
            lambda x: F.struct(x["rating"].alias("x"), rating("_hot_v", x["movieId"]).alias("y")),
        ),
        F.transform(
            deferred("_hot_v"),
            lambda y: F.struct(rating("_hot_u", y["movieId"]).alias("x"), y["rating"].alias("y")),
        ),
    )
    shared = F.filter(shared, lambda s: s["x"].isNotNull() & s["y"].isNotNull())
    values = {
        "n": lambda s: F.lit(1.0),
        "p": lambda s: s["x"] * s["y"],
        "s_u": lambda s: s["x"],
        "s_v": lambda s: s["y"],
        "q_u": lambda s: s["x"] * s["x"],
        "q_v": lambda s: s["y"] * s["y"],
    }

    def plus(name: str) -> Column:
        start = F.col(name).cast("double")
        return F.aggregate("_late", start, lambda acc, s: acc + values[name](s))

    return (
        both.withColumn("_late", shared)
        .withColumns({c: plus(c) for c in values if c in sums.columns})
        .drop("_hot_u", "_hot_v", "_late")
    )


def _complete(
    met: DataFrame,
    min_common: int,
    u: str,
    vectors_u: DataFrame,
    v: str,
    vectors_v: DataFrame,
    keep: Keep,
) -> DataFrame:
    """Pairs with enough shared items, of those that may have them; only open ones meet the vectors.

    Stored in between, as either part reads it.
    """
    met = keep(met, "met")
    opened = _add_open(met.filter("open > 0"), u, vectors_u, v, vectors_v)
    whole = met.filter("open = 0").unionByName(opened)
    return whole.filter(F.col("n") >= min_common).drop("open")


def _enough(met: DataFrame, min_common: int) -> DataFrame:
    """Pairs that have enough shared items, or may have them with those left open."""
    most = F.col("n") + F.col("open") if "open" in met.columns else F.col("n")
    return met.filter(most >= min_common)


def _hottest(large: DataFrame, items: int) -> DataFrame:
    return large.orderBy(F.col("raters").desc(), "movieId").limit(items)


def _target_sums(
    ratings: DataFrame,
    profiles: DataFrame,
    min_common: int,
    large: DataFrame | None,
    broadcast_profiles: bool,
    share_rows: int,
    side_rows: int,
    deferred_items: int,
    keep: Keep,
    tasks: Tasks,
    rounds: Rounds,
    scored: bool = True,
) -> DataFrame:
    """Sums over the shared items of each target and other user with enough of them.

    Unless ``scored`` it is only their number, for which no rating goes along.
    """

    names = SUMS if scored else ("n",)
    sums = _pair_sums(F.col("target_rating"), F.col("rating"))[: len(names)]
    own = ("target_rating", "target_mean") if scored else ()
    others = ("rating",) if scored else ()

    def summed(ratings: DataFrame, profiles: DataFrame, defer: int = 0) -> DataFrame:
        late = _late_columns(defer, scored) if defer else []
        left = profiles.select("targetId", "movieId", *own, *[F.col(c).alias(f"{c}_u") for c in late])
        right = ratings.select("userId", "movieId", *others, *[F.col(c).alias(f"{c}_v") for c in late])

        def enough(pairs: DataFrame) -> DataFrame:
            if scored:
                pairs = pairs.withColumnRenamed("target_mean", "m_u")
            met = _summed(pairs, (*PAIR, "_block"), sums, names, ["m_u"] if scored else [], defer)
            return _enough(met, min_common)

        if broadcast_profiles:
            right = right.withColumn("_block", F.lit(0))
            pairs = join_side(right, left, "movieId", "userId", "targetId", True)
            return enough(pairs.filter(F.col("userId") != F.col("targetId")))

        def found(some: DataFrame, count: int | None) -> DataFrame:
            return enough(_pairs(some, right, *PAIR, False, count, share_rows, side_rows))

        return rounds(found, left, right, "targetId", False, tasks(left, right), "met")

    if large is None or min_common < 2:
        met = summed(ratings, profiles)
    else:
        defer = _set_aside(min_common)
        hot = _hottest(large, deferred_items)
        vectors = keep(_hot_vectors(ratings, hot, defer), "hot_vectors")
        rated = profiles.select(
            F.col("targetId").alias("userId"), "movieId", F.col("target_rating").alias("rating")
        )
        target_vectors = keep(_hot_vectors(rated, hot, defer), "target_vectors")
        met = summed(
            # stored, because heavy keys are counted on either side before the join
            keep(_undeferred(ratings, vectors, defer), "undeferred"),
            keep(_undeferred(profiles, target_vectors, defer, "targetId"), "undeferred_targets"),
            defer,
        )
        met = _complete(met, min_common, "targetId", target_vectors, "userId", vectors, keep)
    return met.drop("_block")


def co_rated_counts(
    ratings: DataFrame,
    profiles: DataFrame,
    min_common: int = DEFAULTS.min_common,
    large: DataFrame | None = None,
    broadcast_profiles: bool = False,
    share_rows: int = SHARE_ROWS,
    side_rows: int = SIDE_ROWS,
    deferred_items: int = DEFERRED_ITEMS,
    keep: Keep = as_is,
    tasks: Tasks = as_planned,
    rounds: Rounds = at_once,
) -> DataFrame:
    """How many items each other user shares with each target.

    ``large`` and ``keep`` as for :func:`pearson_neighbors`.
    """
    return _target_sums(
        ratings,
        profiles,
        min_common,
        large,
        broadcast_profiles,
        share_rows,
        side_rows,
        deferred_items,
        keep,
        tasks,
        rounds,
        scored=False,
    ).select(*PAIR, F.col("n").cast("bigint").alias("common_movies"))


def co_rated_counts_of_all(
    ratings: DataFrame,
    min_common: int = DEFAULTS.min_common,
    large: DataFrame | None = None,
    share_rows: int = SHARE_ROWS,
    side_rows: int = SIDE_ROWS,
    deferred_items: int = DEFERRED_ITEMS,
    keep: Keep = as_is,
    tasks: Tasks = as_planned,
    rounds: Rounds = at_once,
) -> DataFrame:
    """:func:`co_rated_counts` with all users as targets: each pair is counted once, given twice."""
    rows = ratings.select("userId", "movieId")
    sums = (F.count(F.lit(1)).alias("n"),)

    def summed(rows: DataFrame, defer: int = 0) -> DataFrame:
        late = _late_columns(defer, False) if defer else []
        left, right = (
            rows.select(F.col("userId").alias(x), "movieId", *[F.col(c).alias(f"{c}_{x}") for c in late])
            for x in "uv"
        )

        def found(some: DataFrame, count: int | None) -> DataFrame:
            pairs = _pairs(some, right, "u", "v", True, count, share_rows, side_rows)
            return _enough(_summed(pairs, ("u", "v", "_block"), sums, ("n",), defer=defer), min_common)

        return rounds(found, left, right, "u", True, tasks(left, right), "met")

    if large is None or min_common < 2:
        met = summed(rows)
    else:
        defer = _set_aside(min_common)
        vectors = keep(_hot_vectors(ratings, _hottest(large, deferred_items), defer), "hot_vectors")
        met = summed(keep(_undeferred(rows, vectors, defer), "undeferred"), defer)
        met = _complete(met, min_common, "u", vectors, "v", vectors, keep)
    sides = [F.struct(F.col(a).alias("targetId"), F.col(b).alias("userId")) for a, b in ("uv", "vu")]
    common = F.col("n").cast("bigint").alias("common_movies")
    return met.select(F.inline(F.array(*sides)), common)


def pearson_neighbors(
    ratings: DataFrame,
    averages: DataFrame,
    profiles: DataFrame,
    min_common: int = DEFAULTS.min_common,
    on_zero_variance: str = "zero",
    round_similarity: int | None = DEFAULTS.similarity_digits,
    min_candidate_ratings: int | None = None,
    large: DataFrame | None = None,
    broadcast_profiles: bool = False,
    share_rows: int = SHARE_ROWS,
    side_rows: int = SIDE_ROWS,
    deferred_items: int = DEFERRED_ITEMS,
    keep: Keep = as_is,
    tasks: Tasks = as_planned,
    rounds: Rounds = at_once,
) -> DataFrame:
    """Similarity of every target to every other user with enough shared items.

    With many targets an item that everybody rated would make a row for every
    target and user. Given :func:`large_items`, such items are deferred as in
    :func:`top_k_join`, which changes the work and not the result.
    ``keep`` may store what is read more than once.
    """
    sums = _target_sums(
        ratings,
        profiles,
        min_common,
        large,
        broadcast_profiles,
        share_rows,
        side_rows,
        deferred_items,
        keep,
        tasks,
        rounds,
    ).join(_other_means(averages, min_candidate_ratings), "userId")
    return _scored(sums, PAIR, on_zero_variance, round_similarity)


def item_totals(ratings: DataFrame) -> DataFrame:
    """``movieId, n_i, s_i, q_i``: number, sum and sum of squares of each item's ratings."""
    rating = F.col("rating").cast("double")
    return ratings.groupBy("movieId").agg(
        F.count(F.lit(1)).cast("double").alias("n_i"),
        F.sum(rating).alias("s_i"),
        F.sum(rating * rating).alias("q_i"),
    )


def pooled_sums(
    ratings: DataFrame,
    averages: DataFrame,
    totals: DataFrame,
    min_common: int = DEFAULTS.min_common,
    broadcast_items: bool = False,
    share_rows: int = SHARE_ROWS,
    side_rows: int = SIDE_ROWS,
) -> DataFrame:
    """Per user the six sums, and the mean, of which each pooled similarity is a function."""
    rating = F.col("rating").cast("double")
    met = join_side(
        ratings.select("userId", "movieId", "rating"),
        totals,
        "movieId",
        "userId",
        "movieId",
        broadcast_items,
        share_rows,
        side_rows,
    )
    return (
        met.groupBy("userId")
        .agg(
            F.sum("n_i").alias("n"),
            F.sum(rating * F.col("s_i")).alias("p"),
            F.sum("s_i").alias("s_u"),
            F.sum(rating * F.col("n_i")).alias("s_v"),
            F.sum("q_i").alias("q_u"),
            F.sum(rating * rating * F.col("n_i")).alias("q_v"),
        )
        .filter(F.col("n") >= min_common)
        .join(_other_means(averages), "userId")
    )


def pearson_pooled(
    ratings: DataFrame,
    averages: DataFrame,
    means: DataFrame,
    min_common: int = DEFAULTS.min_common,
    round_similarity: int | None = DEFAULTS.similarity_digits,
    totals: DataFrame | None = None,
    broadcast_items: bool = False,
    broadcast_targets: bool = False,
    share_rows: int = SHARE_ROWS,
    side_rows: int = SIDE_ROWS,
) -> DataFrame:
    """Similarity of every user to the pooled ratings of all users.

    Here each rating of a user is paired with every rating of the same item, by
    whomever, and the target enters through its mean alone. ``common_movies`` is
    the number of such pairs. :func:`item_totals` stand in for the pairs, so the work is
    one row per rating. With a user's six sums fixed, the similarity is a closed form in the
    target's mean m, a linear function of m over the root of a quadratic one, which is
    evaluated at each of ``means`` (:func:`target_means`). Targets that share a mean
    share its value; three digits on the rating scale leave a few thousand of them.
    """
    totals = item_totals(ratings) if totals is None else totals
    per_user = pooled_sums(
        ratings, averages, totals, min_common, broadcast_items, share_rows, side_rows
    )
    means = means.withColumnRenamed("target_mean", "m_u")
    distinct_means = means.agg(F.collect_set("m_u")).scalar()
    scored = _scored(
        per_user.withColumn("m_u", F.explode(distinct_means)),
        ("m_u", "userId"),
        "zero",
        round_similarity,
    )
    pairs = join_side(
        scored, means, "m_u", "userId", "targetId", broadcast_targets, share_rows, side_rows
    )
    return pairs.filter(F.col("userId") != F.col("targetId")).select(
        *PAIR, "similarity", "common_movies"
    )


def large_items(ratings: DataFrame, large_raters: int = LARGE_RATERS) -> DataFrame:
    """``movieId, raters`` of the items that have more raters than ``large_raters``."""
    return (
        ratings.groupBy("movieId")
        .agg(F.count(F.lit(1)).alias("raters"))
        .filter(F.col("raters") > large_raters)
    )


def _similarity_bound() -> Column:
    """The highest similarity that a pair may come to when deferred items are added.

    What is added are items that one and the same of the two alone had deferred, say u: the
    added part x of u's sum of squares is at most ``x_u``, that of the other user
    may be anything. With a and b the sums of squares so far and d their product, d >= 0,

        (d + sqrt(x y)) / sqrt((a + x) (b + y))  <=  sqrt((d*d/b + x) / (a + x))

    by Cauchy-Schwarz, which grows with x. A product below 0 counts as 0, and the bound is
    the higher one of both cases. Without deferred items it is the similarity itself, or 0.
    """
    a, b, d = F.col("sq_u"), F.col("sq_v"), F.greatest(F.lit(0.0), F.col("dot"))

    def side(own: Column, other: Column, late: Column) -> Column:
        known = F.coalesce(F.try_divide(d * d, other), F.lit(0.0))
        return F.sqrt(F.coalesce(F.try_divide(known + late, own + late), F.lit(0.0)))

    return F.greatest(side(a, b, F.col("x_u")), side(b, a, F.col("x_v")))


def _meet(
    rows: DataFrame,
    carry: tuple[str, ...],
    defer: int,
    above: bool,
    min_common: int,
    reduced: Callable[[DataFrame], DataFrame],
    name: str,
    tasks: Tasks,
    rounds: Rounds,
    share_rows: int,
    side_rows: int,
) -> DataFrame:
    """Sums of all user pairs, of ``u < v`` only with ``above``, and what each row carries.

    Pairs without enough shared items are left out. Of the others it returns what ``reduced``
    makes of them, all pairs of a u at a time.
    """
    late = _late_columns(defer) if defer else []
    left, right = (
        rows.select(
            F.col("userId").alias(side),
            "movieId",
            F.col("rating").alias(f"rating_{side}"),
            *[F.col(c).alias(f"{c}_{side}") for c in (*carry, *late)],
        )
        for side in "uv"
    )
    sums = _pair_sums(F.col("rating_u"), F.col("rating_v"))
    carried = [f"{c}_{side}" for c in carry for side in "uv"]

    def found(some: DataFrame, count: int | None) -> DataFrame:
        pairs = _pairs(some, right, "u", "v", above, count, share_rows, side_rows)
        met = _summed(pairs, ("u", "v", "_block"), sums, SUMS, carried, defer, "m" in carry)
        return reduced(_enough(met.drop("_block"), min_common))

    return rounds(found, left, right, "u", above, tasks(left, right), name)


def _sums_of_all(
    ratings: DataFrame,
    large: DataFrame | None,
    min_common: int,
    share_rows: int,
    side_rows: int,
    deferred_items: int,
    keep: Keep,
    tasks: Tasks,
    rounds: Rounds,
) -> DataFrame:
    """Sums over the shared items of all user pairs ``u < v`` with enough of them."""
    rows = ratings.select("userId", "movieId", "rating")

    def meet(rows: DataFrame, defer: int = 0) -> DataFrame:
        how = min_common, lambda met: met, "met", tasks, rounds, share_rows, side_rows
        return _meet(rows, (), defer, True, *how)

    if large is None or min_common < 2:
        return meet(rows)
    defer = _set_aside(min_common)
    vectors = keep(_hot_vectors(rows, _hottest(large, deferred_items), defer), "hot_vectors")
    met = meet(keep(_undeferred(rows, vectors, defer), "undeferred"), defer)
    return _complete(met, min_common, "u", vectors, "v", vectors, keep)


def pearson_of_all(
    ratings: DataFrame,
    averages: DataFrame,
    min_common: int = DEFAULTS.min_common,
    on_zero_variance: str = "zero",
    round_similarity: int | None = DEFAULTS.similarity_digits,
    min_candidate_ratings: int | None = None,
    large: DataFrame | None = None,
    share_rows: int = SHARE_ROWS,
    side_rows: int = SIDE_ROWS,
    deferred_items: int = DEFERRED_ITEMS,
    keep: Keep = as_is,
    tasks: Tasks = as_planned,
    rounds: Rounds = at_once,
) -> DataFrame:
    """:func:`pearson_neighbors` with all users as targets: each pair is added up once, given twice."""
    met = _sums_of_all(
        ratings, large, min_common, share_rows, side_rows, deferred_items, keep, tasks, rounds
    )
    sides = [
        F.struct(
            F.col(a).alias("targetId"),
            F.col(b).alias("userId"),
            *[F.col(f"{c}_{x}").alias(f"{c}_{y}") for c in "sq" for x, y in ((a, "u"), (b, "v"))],
        )
        for a, b in ("uv", "vu")
    ]
    means = averages.select(F.col("userId").alias("targetId"), F.col("avg_rating").alias("m_u"))
    both = (
        met.select("n", "p", F.inline(F.array(*sides)))
        .join(means, "targetId")
        .join(_other_means(averages, min_candidate_ratings), "userId")
    )
    return _scored(both, PAIR, on_zero_variance, round_similarity)


def similarity_matrix(
    ratings: DataFrame,
    averages: DataFrame,
    large: DataFrame | None = None,
    min_common: int = DEFAULTS.min_common,
    on_zero_variance: str = "zero",
    round_similarity: int | None = DEFAULTS.similarity_digits,
    share_rows: int = SHARE_ROWS,
    side_rows: int = SIDE_ROWS,
    deferred_items: int = DEFERRED_ITEMS,
    keep: Keep = as_is,
    tasks: Tasks = as_planned,
    rounds: Rounds = at_once,
) -> DataFrame:
    """Similarity of all user pairs with enough shared items: ``userA < userB``.

    ``large`` is :func:`large_items`, or None where it was found empty; such items are deferred
    as in :func:`top_k_join`. The result has a row for every such pair, none is left out.
    """
    met = _sums_of_all(
        ratings, large, min_common, share_rows, side_rows, deferred_items, keep, tasks, rounds
    )
    means = averages.select("userId", F.col("avg_rating").alias("m"))
    complete = (
        met.join(means.withColumnsRenamed({"userId": "u", "m": "m_u"}), "u")
        .join(means.withColumnsRenamed({"userId": "v", "m": "m_v"}), "v")
        .withColumnsRenamed({"u": "userA", "v": "userB"})
    )
    return _scored(complete, ("userA", "userB"), on_zero_variance, round_similarity)


def top_k_join(
    ratings: DataFrame,
    averages: DataFrame,
    k: int = DEFAULTS.neighbors,
    min_common: int = DEFAULTS.min_common,
    large: DataFrame | None = None,
    min_similarity: float | None = None,
    on_zero_variance: str = "zero",
    round_similarity: int | None = DEFAULTS.similarity_digits,
    share_rows: int = SHARE_ROWS,
    side_rows: int = SIDE_ROWS,
    deferred_items: int = DEFERRED_ITEMS,
    keep: Keep = as_is,
    tasks: Tasks = as_planned,
    rounds: Rounds = at_once,
) -> DataFrame:
    """The ``k`` most similar users of every user: at most k rows a user, exactly those of
    :func:`pearson_neighbors` and :func:`top_k_neighbors` with all users as targets.

    ``large`` is :func:`large_items`, or None where it was found empty. A user defers
    up to ``min_common - 1`` of the most-rated items. Two users with ``min_common`` items
    in common still share an item that neither has deferred, namely the least-rated
    common one, so pairs are generated from undeferred ratings only and none is lost. What both
    deferred goes along with their ratings and is added where pairs are added up. So the
    similarity of most pairs is known there, and only each user's k best of them are kept.
    The others are open: one user deferred items that the other may have rated and not deferred.
    Their sums so far and the norms of these items bound their similarity from above.
    Each user's k open candidates with the highest bounds are completed
    first; the k-th best score then rules out every candidate whose bound
    is below it, and only the rest are completed as well.

    ``keep`` may store the tables that are read more than once.
    """
    if k < 1:
        raise ValueError("k must be positive")
    if on_zero_variance not in ("zero", "drop"):
        raise ValueError("on_zero_variance must be 'zero' or 'drop'")
    means = averages.select("userId", F.col("avg_rating").alias("m"))
    rows = ratings.select("userId", "movieId", "rating")
    how = on_zero_variance, round_similarity
    users = {"u": "targetId", "v": "userId"}

    def best(scored: DataFrame) -> DataFrame:
        return top_k_neighbors(scored, k, min_similarity)

    def meet(rows: DataFrame, reduced, name: str, defer: int = 0) -> DataFrame:
        # from either side, so that all pairs of a user are ranked where they are added up
        how = min_common, reduced, name, tasks, rounds, share_rows, side_rows
        return _meet(rows, ("m",), defer, False, *how)

    if large is None or min_common < 2:
        ranked = lambda met: best(_scored(met.withColumnsRenamed(users), PAIR, *how))
        return meet(keep(rows.join(means, "userId"), "with_means"), ranked, "nearest")

    defer = _set_aside(min_common)
    vectors = keep(_hot_vectors(rows, _hottest(large, deferred_items), defer), "hot_vectors")
    undeferred = keep(_undeferred(rows, vectors, defer).join(means, "userId"), "undeferred")
    # a little above, so that neither rounding nor the order of summation makes it too low
    known = F.col("open") == 0
    highest = F.when(known, _similarity(on_zero_variance)).otherwise(_similarity_bound() + 1e-9)
    rest = F.struct(*SUMS[1:], "m_u", "m_v")

    def bounded(met: DataFrame) -> DataFrame:
        met = _centred(met).withColumn("_highest", highest).select(
            "u",
            "v",
            "n",
            round_half_up(F.col("_highest"), round_similarity).alias("bound"),
            F.when(~known, rest).alias("rest"),
            F.when(~known, F.col("v")).alias("open_user"),
        )
        if on_zero_variance == "drop":
            met = met.filter(F.col("bound").isNotNull())
        if min_similarity is not None:
            met = met.filter(F.col("bound") > min_similarity)
        # each user's k best known pairs and the first that they rule out, and every open one
        return top_per(met, ["u", "open_user"], [F.col("bound").desc(), F.col("v")], k + 1).drop("rank")

    met = keep(meet(undeferred, bounded, "bounded_pairs", defer), "bounded_pairs")
    met = met.withColumnsRenamed(users)
    order = [F.col("bound").desc(), F.col("userId")]
    exact = met.filter("open_user IS NULL").select(
        *PAIR,
        F.col("bound").alias("similarity"),
        F.col("n").cast("bigint").alias("common_movies"),
    )
    pairs = met.filter("open_user IS NOT NULL").select(*PAIR, "n", "bound", "rest.*")

    def complete(some: DataFrame) -> DataFrame:
        added = _add_open(some, "targetId", vectors, "userId", vectors)
        return _scored(added.filter(F.col("n") >= min_common), PAIR, *how)

    first = keep(top_per(pairs, ["targetId"], order, k, rank="place"), "first_candidates")
    scored = keep(exact.unionByName(complete(first.drop("place"))), "first_scores")
    last = first.filter(F.col("place") == k).select(
        "targetId", F.col("bound").alias("last_bound"), F.col("userId").alias("last_user")
    )
    by_score = [F.col("similarity").desc(), F.col("userId")]
    kth = top_per(scored, ["targetId"], by_score, k).filter(F.col("rank") == k)
    kth = kth.select("targetId", F.col("similarity").alias("least"))
    cut = keep(last.join(kth, "targetId", "full"), "cuts")
    later = (F.col("bound") < F.col("last_bound")) | (
        (F.col("bound") == F.col("last_bound")) & (F.col("userId") > F.col("last_user"))
    )
    open_ = F.col("least").isNull() | (F.col("bound") >= F.col("least"))
    others = pairs.join(cut, "targetId").filter(later & open_).drop(*cut.columns[1:])
    return best(scored.unionByName(complete(others)))


def top_k_neighbors(
    similarities: DataFrame,
    k: int | None = DEFAULTS.neighbors,
    min_similarity: float | None = None,
) -> DataFrame:
    """Each target's ``k`` most similar users, those above ``min_similarity`` only."""
    if min_similarity is not None:
        similarities = similarities.filter(F.col("similarity") > min_similarity)
    if k is None:
        return similarities
    return top_per(
        similarities, ["targetId"], [F.col("similarity").desc(), F.col("userId")], k
    )


def similarity_extremes(similarities: DataFrame, most: int = 20, least: int = 10) -> DataFrame:
    """The most and the least similar users of each target, labelled."""
    parts = [
        top_per(similarities, ["targetId"], [order, F.col("userId")], n).withColumn(
            "side", F.lit(side)
        )
        for side, order, n in (
            ("most", F.col("similarity").desc(), most),
            ("least", F.col("similarity").asc(), least),
        )
    ]
    return parts[0].unionByName(parts[1])


def top_overlap_users(counts: DataFrame, n: int = 10) -> DataFrame:
    """Each target's users with the most shared items."""
    return top_per(counts, ["targetId"], [F.col("common_movies").desc(), F.col("userId")], n)
