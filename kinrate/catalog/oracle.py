"""SQL twins of the queries, for an engine reading the same tables.

Each is written from the definitions, not from the Spark plans: similarities are
sums of products of deviations, the pooled form is the plain self-join, and all
rankings are window functions over whole tables.
"""

from __future__ import annotations


def _round(value: str, digits: int) -> str:
    """Half-up rounding in decimal arithmetic, as on the Spark side."""
    return f"CAST(round(CAST({value} AS DECIMAL(20,10)), {digits}) AS DOUBLE)"


def _rank(partition: str, order: str) -> str:
    by = f"PARTITION BY {partition} " if partition else ""
    return f"CAST(row_number() OVER ({by}ORDER BY {order}) AS INTEGER)"


def _raw_as(name: str, rating: str) -> str:
    return f"""{name} AS (
  SELECT CAST(o_custkey AS BIGINT) AS userId, CAST(l_partkey AS BIGINT) AS movieId,
         CAST({rating} AS DOUBLE) AS rating, l_shipdate, l_orderkey, l_linenumber
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


QUANTITY_RATING = "0.5 + 0.5 * floor((l_quantity - 1) / 5)"
RAW = _raw_as("raw", QUANTITY_RATING)
DIRTY = _raw_as(
    "raw",
    f"CASE WHEN l_linenumber = 6 THEN 9.0 WHEN l_linenumber <> 7 THEN {QUANTITY_RATING} END",
)


def _newest(name: str, condition: str) -> str:
    return f"""{name} AS (
  SELECT userId, movieId, rating FROM (
    SELECT userId, movieId, rating,
           row_number() OVER (PARTITION BY userId, movieId
             ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS place
    FROM raw
    WHERE userId IS NOT NULL AND movieId IS NOT NULL AND rating IS NOT NULL {condition}
  ) AS numbered WHERE place = 1)"""


IN_RANGE = "AND rating BETWEEN 0.5 AND 5.0"
CLEAN = _newest("ratings", IN_RANGE)
AVERAGES = f"""averages AS (
  SELECT userId, {_round("avg(rating)", 3)} AS avg_rating, count(rating) AS num_ratings
  FROM ratings GROUP BY userId)"""
ITEMS = """items AS (
  SELECT CAST(p_partkey AS BIGINT) AS movieId, p_name AS title,
         concat_ws('|', p_type, p_brand) AS genres FROM part)"""
MOST_ACTIVE = """most_active AS (
  SELECT userId FROM averages ORDER BY num_ratings DESC, userId LIMIT 1)"""
TARGETS = """targets AS (
  SELECT userId AS targetId, avg_rating AS target_mean FROM averages
  WHERE userId = 10 OR userId IN (SELECT userId FROM most_active))"""
PROFILES = """profiles AS (
  SELECT t.targetId, r.movieId, r.rating AS target_rating, t.target_mean
  FROM targets t JOIN ratings r ON r.userId = t.targetId)"""


def _sums(others: str = "ratings", averages: str = "averages") -> str:
    return f"""sums AS (
  SELECT p.targetId, o.userId, count(*) AS n,
         sum((p.target_rating - p.target_mean) * (o.rating - a.avg_rating)) AS dot,
         sum((p.target_rating - p.target_mean) * (p.target_rating - p.target_mean)) AS tsq,
         sum((o.rating - a.avg_rating) * (o.rating - a.avg_rating)) AS osq
  FROM profiles p JOIN {others} o ON o.movieId = p.movieId AND o.userId <> p.targetId
  JOIN {averages} a ON a.userId = o.userId
  GROUP BY p.targetId, o.userId)"""


PEARSON_OR_ZERO = "CASE WHEN sqrt(tsq * osq) = 0 THEN 0 ELSE dot / sqrt(tsq * osq) END"
PEARSON_OR_NULL = "CASE WHEN sqrt(tsq * osq) <> 0 THEN dot / sqrt(tsq * osq) END"
SIMS = f"""sims AS (
  SELECT targetId, userId, {_round(PEARSON_OR_ZERO, 4)} AS similarity, n AS common_movies
  FROM sums WHERE n >= 3)"""
TOP_K = f"""nearest AS (
  SELECT * FROM (
    SELECT *, {_rank("targetId", "similarity DESC, userId")} AS rank FROM sims
  ) AS numbered WHERE rank <= 50)"""


def _clamped(value: str) -> str:
    return f"CASE WHEN {value} > 5.0 THEN 5.0 WHEN {value} < 0.5 THEN 0.5 ELSE {value} END"


def _contributions(others: str = "ratings", averages: str = "averages") -> str:
    return f"""contributions AS (
  SELECT n.targetId, r.movieId, r.userId, n.similarity, r.rating, a.avg_rating,
         n.similarity * (r.rating - a.avg_rating) AS contribution
  FROM nearest n JOIN {others} r ON r.userId = n.userId
  JOIN {averages} a ON a.userId = n.userId
  WHERE NOT EXISTS (SELECT 1 FROM profiles p
                    WHERE p.targetId = n.targetId AND p.movieId = r.movieId))"""


WEIGHTED = """weighted AS (
  SELECT c.targetId, c.movieId, count(*) AS num_raters, avg(c.similarity) AS mean_similarity,
         min(m.target_mean) AS target_mean,
         min(m.target_mean) + sum(c.contribution) / nullif(sum(abs(c.similarity)), 0) AS value
  FROM contributions c JOIN means m ON m.targetId = c.targetId
  GROUP BY c.targetId, c.movieId)"""
MEANS = "means AS (SELECT DISTINCT targetId, target_mean FROM profiles)"
PREDICTED = f"""predicted AS (
  SELECT targetId, movieId, {_round(_clamped("value"), 2)} AS predicted_rating, num_raters,
         {_round("mean_similarity", 4)} AS avg_similarity FROM weighted)"""

# The new user -1 has the most active user's ratings; that user is no neighbour.
NEW_USER = f"""others AS (
  SELECT * FROM ratings WHERE userId NOT IN (SELECT userId FROM most_active)),
other_averages AS (
  SELECT * FROM averages WHERE userId NOT IN (SELECT userId FROM most_active)),
profiles AS (
  SELECT CAST(-1 AS BIGINT) AS targetId, movieId, rating AS target_rating,
         avg(rating) OVER () AS target_mean
  FROM ratings WHERE userId IN (SELECT userId FROM most_active))"""
NEW_SIMS = f"""sims AS (
  SELECT * FROM (
    SELECT s.targetId, s.userId, {_round(PEARSON_OR_NULL, 10)} AS similarity,
           n AS common_movies, a.avg_rating, a.num_ratings
    FROM sums s JOIN other_averages a ON a.userId = s.userId
    WHERE n >= 3 AND a.num_ratings >= 10
  ) AS scored WHERE similarity > 0)"""
RATING_TYPE = (
    "CASE WHEN {0} >= 4.0 THEN 'Generous' WHEN {0} <= 2.5 THEN 'Critical' ELSE 'Balanced' END"
)
NEW_NEAREST = f"""nearest AS (
  SELECT *, {RATING_TYPE.format("avg_rating")} AS rating_type FROM (
    SELECT *, {_rank("targetId", "similarity DESC, userId")} AS rank FROM sims
  ) AS numbered WHERE rank <= 10)"""
NEW_PREDICTED = f"""predicted AS (
  SELECT targetId, movieId, {_round(_clamped("value"), 2)} AS predicted_rating,
         num_raters AS num_contributors, target_mean FROM weighted WHERE value IS NOT NULL)"""
NEW_RANKED = f"""ranked AS (
  SELECT * FROM (
    SELECT *, {_rank("targetId", "predicted_rating DESC, movieId")} AS rank FROM predicted
  ) AS numbered WHERE rank <= 10)"""
COMMON = """common AS (
  SELECT p.targetId, o.userId, p.movieId, p.target_rating AS rating1, o.rating AS rating2
  FROM profiles p JOIN others o ON o.movieId = p.movieId)"""

# Ratings to which every user adds one for each of four items.
SKEWED = f"""clean AS (SELECT * FROM ratings),
skewed AS (
  SELECT * FROM clean UNION ALL
  SELECT userId, item, ((((userId * 7 - item * 3) % 10) + 10) % 10 + 1) / 2.0e0
  FROM (SELECT DISTINCT userId FROM clean) AS users,
       (VALUES (-1::BIGINT), (-2), (-3), (-4)) AS added(item)),
skewed_averages AS (
  SELECT userId, {_round("avg(rating)", 3)} AS avg_rating, count(rating) AS num_ratings
  FROM skewed GROUP BY userId)"""


def _skewed_profiles(chosen: str) -> str:
    return f"""profiles AS (
  SELECT r.userId AS targetId, r.movieId, r.rating AS target_rating, a.avg_rating AS target_mean
  FROM skewed r JOIN skewed_averages a ON a.userId = r.userId
  WHERE r.userId IN ({chosen}))"""


BASE = (RAW, CLEAN)
WITH_MEANS = (*BASE, AVERAGES)
WITH_TARGETS = (*WITH_MEANS, MOST_ACTIVE, TARGETS, PROFILES)
WITH_SIMS = (*WITH_TARGETS, _sums(), SIMS)
WITH_PREDICTIONS = (*WITH_SIMS, TOP_K, _contributions(), MEANS, WEIGHTED, PREDICTED)
WITH_NEW_USER = (*WITH_MEANS, MOST_ACTIVE, NEW_USER)
WITH_NEW_SIMS = (*WITH_NEW_USER, _sums("others", "other_averages"), NEW_SIMS, NEW_NEAREST)
WITH_NEW_PREDICTIONS = (
    *WITH_NEW_SIMS,
    _contributions("others", "other_averages"),
    MEANS,
    WEIGHTED,
    NEW_PREDICTED,
)


def _sql(tables, select: str) -> str:
    return "WITH " + ",\n".join(tables) + "\n" + select


def _top(select: str, partition: str, order: str, n: int, rank: str = "rank") -> str:
    return (
        f"SELECT * FROM (SELECT *, {_rank(partition, order)} AS {rank} FROM ({select}) AS rows_in)"
        f" AS numbered WHERE {rank} <= {n}"
    )


def _summary(column: str, table: str, by: str = "") -> str:
    keys, group = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    measures = ", ".join(
        f"{_round(f'coalesce({f}({column}), 0)', 6)} AS {name}"
        for name, f in (("mean", "avg"), ("std_dev", "stddev_samp"), ("min", "min"), ("max", "max"))
    )
    return f"SELECT {keys}{measures} FROM {table}{group}"


def _percent(part: str, whole: str) -> str:
    return _round(f"{part} * 100.0e0 / nullif({whole}, 0)", 2)


SIZES = (
    "count(DISTINCT userId) AS num_users, count(DISTINCT movieId) AS num_movies, "
    "count(*) AS total_ratings, avg(rating) AS mean"
)
SPARSITY = _round("100.0e0 - total_ratings * 100.0e0 / (num_users * num_movies)", 2)
SIMILARITY_BAND = (
    "CASE WHEN {0} >= 0.8 THEN 'Very Similar' WHEN {0} >= 0.6 THEN 'Similar' "
    "WHEN {0} >= 0.4 THEN 'Somewhat Similar' WHEN {0} IS NOT NULL THEN 'Different Taste' END"
)
CONFIDENCE = (
    "CASE WHEN {0} >= 20 THEN 'High Confidence' WHEN {0} >= 10 THEN 'Medium Confidence' "
    "ELSE 'Low Confidence' END"
)
WITH_ITEM = "SELECT x.*, i.title, i.genres FROM ({0}) AS x LEFT JOIN items i ON i.movieId = x.movieId"
RECOMMENDED = "predicted_rating DESC NULLS LAST, num_raters DESC, movieId"
TOP_FIVE = WITH_ITEM.format(_top("SELECT * FROM predicted", "targetId", RECOMMENDED, 5))
CLEAN_QUERY = "SELECT userId, movieId, rating FROM ratings"
EXPLAINED = f"""SELECT p.targetId, p.movieId, p.predicted_rating, p.num_contributors,
       {_round("p.predicted_rating - p.target_mean", 4)} AS adjustment, c.position, c.userId,
       {_round("c.similarity", 4)} AS similarity, c.rating, c.avg_rating,
       {_round("c.contribution", 4)} AS contribution
FROM {{0}} p JOIN (
  SELECT *, {_rank("targetId, movieId", f"abs({_round('contribution', 10)}) DESC, userId")} AS position
  FROM contributions
) AS c ON c.targetId = p.targetId AND c.movieId = p.movieId WHERE c.position <= 5"""
TITLED = (
    "SELECT x.*, coalesce(i.title, concat('Movie ', x.movieId)) AS title FROM ({0}) AS x"
    " LEFT JOIN items i ON i.movieId = x.movieId"
)


def _explored(order: str) -> str:
    gap = _round("abs(avg_rating - (SELECT min(target_mean) FROM profiles))", 6)
    return f"""SELECT targetId, userId, {_round("similarity", 6)} AS similarity, common_movies,
       avg_rating, num_ratings, rating_type, mean_gap, place AS rank
FROM (
  SELECT *, {_rank("targetId", f"{order}, userId")} AS place FROM (
    SELECT *, {gap} AS mean_gap FROM nearest
    WHERE similarity >= 0.5 AND common_movies >= 3) AS passed) AS placed"""


LOVED = f"""theirs AS (
  SELECT n.targetId, n.userId, o.movieId, o.rating
  FROM nearest n JOIN others o ON o.userId = n.userId),
mine AS (
  SELECT n.targetId, n.userId, p.movieId, p.target_rating AS rating
  FROM nearest n JOIN profiles p ON p.targetId = n.targetId),
loved AS (
  SELECT t.*, 'theirs' AS loved_by FROM theirs t
  WHERE rating >= 4.0 AND movieId NOT IN (SELECT movieId FROM profiles)
  UNION ALL
  SELECT m.*, 'mine' AS loved_by FROM mine m
  WHERE rating >= 4.0 AND NOT EXISTS (
    SELECT 1 FROM theirs t WHERE t.userId = m.userId AND t.movieId = m.movieId))"""
POOLED = f"""SELECT targetId, userId, {_round(PEARSON_OR_ZERO, 4)} AS similarity,
       n AS common_movies
FROM (
  SELECT t.targetId, o.userId, count(*) AS n,
         sum((w.rating - t.target_mean) * (o.rating - a.avg_rating)) AS dot,
         sum((w.rating - t.target_mean) * (w.rating - t.target_mean)) AS tsq,
         sum((o.rating - a.avg_rating) * (o.rating - a.avg_rating)) AS osq
  FROM targets t JOIN ratings o ON o.userId <> t.targetId
  JOIN ratings w ON w.movieId = o.movieId
  JOIN averages a ON a.userId = o.userId
  GROUP BY t.targetId, o.userId
) AS pooled WHERE n >= 3"""
ALL_PAIRS = f"""SELECT userA, userB, {_round(PEARSON_OR_ZERO, 4)} AS similarity, n AS common_movies
FROM (
  SELECT u.userId AS userA, v.userId AS userB, count(*) AS n,
         sum((u.rating - a.avg_rating) * (v.rating - b.avg_rating)) AS dot,
         sum((u.rating - a.avg_rating) * (u.rating - a.avg_rating)) AS tsq,
         sum((v.rating - b.avg_rating) * (v.rating - b.avg_rating)) AS osq
  FROM ratings u JOIN ratings v ON u.movieId = v.movieId AND u.userId < v.userId
  JOIN averages a ON a.userId = u.userId JOIN averages b ON b.userId = v.userId
  GROUP BY u.userId, v.userId
) AS pairs WHERE n >= 3"""
EVERYBODY = """targets AS (
  SELECT userId AS targetId, avg_rating AS target_mean FROM averages)"""
COLD = f"""cold AS (
  SELECT t.targetId, t.num_ratings FROM (
    SELECT userId AS targetId, num_ratings FROM averages
  ) AS t WHERE NOT EXISTS (
    SELECT 1 FROM ratings o JOIN ratings p ON p.movieId = o.movieId
    WHERE p.userId = t.targetId AND o.userId <> t.targetId
    GROUP BY o.userId HAVING count(*) >= 3)),
popular AS (
  SELECT movieId, {_rank("", "count(rating) DESC, movieId")} AS place
  FROM ratings GROUP BY movieId),
unseen AS (
  SELECT c.targetId, p.movieId, p.place FROM cold c JOIN popular p
    ON p.place <= c.num_ratings + 5
  WHERE NOT EXISTS (SELECT 1 FROM ratings r
                    WHERE r.userId = c.targetId AND r.movieId = p.movieId))"""
AUDIT = f"""counts AS (
  SELECT (SELECT count(*) FROM raw) AS initial_rows,
         (SELECT count(*) FROM raw WHERE userId IS NOT NULL AND movieId IS NOT NULL
            AND rating IS NOT NULL) AS after_nulls,
         (SELECT count(*) FROM ratings) AS after_duplicates,
         (SELECT count(*) FROM ratings WHERE rating BETWEEN 0.5 AND 5.0) AS final_rows)"""
STARS = (
    "concat(repeat('⭐', CAST(floor({0}) AS INTEGER)), "
    "repeat('½⭐', CASE WHEN {0} - floor({0}) >= 0.5 THEN 1 ELSE 0 END), "
    "repeat('☆', 5 - CAST(floor({0}) AS INTEGER) "
    "- CASE WHEN {0} - floor({0}) >= 0.5 THEN 1 ELSE 0 END))"
)
SAMPLE = ", ".join(
    f"max(CASE WHEN movieId = {i} THEN rating END) AS movie_{i}" for i in range(10)
)
STORED_AVERAGES = _sql(WITH_MEANS, "SELECT userId, avg_rating, num_ratings FROM averages")
TOP_BOTTOM = " UNION ALL ".join(
    f"SELECT '{side}' AS side, * FROM ("
    + _top("SELECT * FROM averages", "", f"avg_rating {order}, num_ratings DESC, userId", 5)
    + f") AS {side}"
    for side, order in (("highest", "DESC"), ("lowest", "ASC"))
)
EXTREMES = " UNION ALL ".join(
    f"SELECT *, '{side}' AS side FROM ("
    + _top("SELECT * FROM sims", "targetId", f"similarity {order}, userId", n)
    + f") AS {side}"
    for side, order, n in (("most", "DESC", 20), ("least", "ASC", 10))
)

ORACLE: dict[str, str] = {
    "ratings_load": _sql(
        (RAW,),
        "SELECT userId, movieId, rating, CAST(epoch(l_shipdate) AS BIGINT) AS timestamp FROM raw",
    ),
    "items_load": _sql((ITEMS,), "SELECT movieId, title, genres FROM items"),
    "stage_csv": STORED_AVERAGES,
    "stage_parquet": STORED_AVERAGES,
    "stage_json": STORED_AVERAGES,
    "clean_ratings": _sql((DIRTY, CLEAN), CLEAN_QUERY),
    "clean_ratings_any_range": _sql((DIRTY, _newest("ratings", "")), CLEAN_QUERY),
    "cleaning_audit": _sql(
        (DIRTY, _newest("ratings", ""), AUDIT),
        f"""SELECT initial_rows, after_nulls, initial_rows - after_nulls AS removed_nulls,
       after_duplicates, after_nulls - after_duplicates AS removed_duplicates, final_rows,
       after_duplicates - final_rows AS removed_out_of_range,
       initial_rows - final_rows AS removed_total,
       {_percent("(initial_rows - final_rows)", "initial_rows")} AS removed_pct
FROM counts""",
    ),
    "dataset_stats": _sql(
        (RAW,),
        f"""SELECT num_users, num_movies, total_ratings, {_round("mean", 3)} AS avg_rating,
       {SPARSITY} AS sparsity_pct FROM (SELECT {SIZES} FROM raw) AS sizes""",
    ),
    "rating_distribution": _sql(
        (RAW,),
        f"""SELECT rating, count(*) AS count,
       {_percent("count(*)", "(SELECT count(*) FROM raw)")} AS percentage
FROM raw GROUP BY rating""",
    ),
    "matrix_info": _sql(
        BASE,
        f"""SELECT num_users, num_movies, total_ratings, num_users * num_movies AS total_cells,
       num_users * num_movies - total_ratings AS null_cells, {SPARSITY} AS sparsity_pct,
       {_percent("total_ratings", "num_users * num_movies")} AS density_pct
FROM (SELECT {SIZES} FROM ratings) AS sizes""",
    ),
    "matrix_sample": _sql(
        BASE,
        f"""SELECT userId, {SAMPLE} FROM ratings
WHERE movieId BETWEEN 0 AND 9
  AND userId IN (SELECT DISTINCT userId FROM ratings ORDER BY userId LIMIT 5)
GROUP BY userId""",
    ),
    "user_averages": STORED_AVERAGES,
    "maintained_averages": _sql(
        (RAW, _newest("ratings", "AND rating BETWEEN 1.0 AND 5.0"), AVERAGES),
        "SELECT userId, avg_rating, num_ratings FROM averages",
    ),
    "user_average_stats": _sql(WITH_MEANS, _summary("avg_rating", "averages")),
    "top_bottom_users": _sql(WITH_MEANS, TOP_BOTTOM),
    "eligible_users": _sql(
        WITH_MEANS, "SELECT userId, avg_rating, num_ratings FROM averages WHERE num_ratings >= 10"
    ),
    "rating_type_distribution": _sql(
        WITH_MEANS,
        f"SELECT {RATING_TYPE.format('avg_rating')} AS rating_type, count(*) AS count"
        " FROM averages GROUP BY 1",
    ),
    "star_ratings": _sql(
        WITH_MEANS, f"SELECT userId, {STARS.format('avg_rating')} AS stars FROM averages"
    ),
    "target_ratings": _sql(
        WITH_TARGETS, "SELECT targetId, movieId, target_rating AS rating FROM profiles"
    ),
    "co_rated_counts": _sql(
        (*WITH_TARGETS, _sums()),
        "SELECT targetId, userId, n AS common_movies FROM sums WHERE n >= 3",
    ),
    "top_overlap_users": _sql(
        (*WITH_TARGETS, _sums()),
        _top(
            "SELECT targetId, userId, n AS common_movies FROM sums WHERE n >= 3",
            "targetId",
            "common_movies DESC, userId",
            10,
        ),
    ),
    "pearson_neighbors": _sql(WITH_SIMS, "SELECT * FROM sims"),
    "pearson_pooled": _sql(WITH_TARGETS, POOLED),
    "all_pairs_similarity": _sql(WITH_MEANS, ALL_PAIRS),
    "co_rated_counts_skewed": _sql(
        (
            *BASE,
            SKEWED,
            _skewed_profiles(
                "SELECT userId FROM skewed_averages ORDER BY num_ratings DESC, userId LIMIT 20"
            ),
            _sums("skewed", "skewed_averages"),
        ),
        "SELECT targetId, userId, n AS common_movies FROM sums WHERE n >= 5",
    ),
    "all_pairs_skewed": _sql(
        (
            *BASE,
            SKEWED,
            _skewed_profiles("SELECT userId FROM skewed_averages"),
            _sums("skewed", "skewed_averages"),
        ),
        _top(
            f"SELECT targetId, userId, {_round(PEARSON_OR_ZERO, 4)} AS similarity,"
            " n AS common_movies FROM sums WHERE n >= 5",
            "targetId",
            "similarity DESC, userId",
            10,
        ),
    ),
    "similarity_stats": _sql(WITH_SIMS, _summary("similarity", "sims", "targetId")),
    "similarity_extremes": _sql(WITH_SIMS, EXTREMES),
    "similarity_band_distribution": _sql(
        WITH_SIMS,
        f"SELECT targetId, {SIMILARITY_BAND.format('similarity')} AS band, count(*) AS count"
        " FROM sims GROUP BY 1, 2",
    ),
    "top_k_neighbors": _sql((*WITH_SIMS, TOP_K), "SELECT * FROM nearest"),
    "top_k_neighbors_above": _sql(
        WITH_SIMS,
        _top(
            "SELECT * FROM sims WHERE similarity > 0", "targetId", "similarity DESC, userId", 50
        ),
    ),
    "unseen_items": _sql(WITH_PREDICTIONS, "SELECT DISTINCT targetId, movieId FROM contributions"),
    "predicted_ratings": _sql(WITH_PREDICTIONS, "SELECT * FROM predicted"),
    "prediction_stats": _sql(
        WITH_PREDICTIONS, _summary("predicted_rating", "predicted", "targetId")
    ),
    "prediction_distribution": _sql(
        WITH_PREDICTIONS,
        _top(
            "SELECT targetId, predicted_rating, count(*) AS count FROM predicted GROUP BY 1, 2",
            "targetId",
            "predicted_rating DESC NULLS LAST",
            20,
        ),
    ),
    "top_predictions": _sql(
        WITH_PREDICTIONS,
        _top(
            "SELECT * FROM predicted", "targetId", "predicted_rating DESC NULLS LAST, movieId", 20
        ),
    ),
    "confidence_distribution": _sql(
        WITH_PREDICTIONS,
        f"SELECT targetId, {CONFIDENCE.format('num_raters')} AS confidence, count(*) AS count"
        " FROM predicted GROUP BY 1, 2",
    ),
    "top_n_recommendations": _sql((*WITH_PREDICTIONS, ITEMS), TOP_FIVE),
    "top_n_recommendations_above": _sql(
        (*WITH_PREDICTIONS, ITEMS),
        WITH_ITEM.format(
            _top(
                "SELECT * FROM predicted WHERE predicted_rating >= 3.5", "targetId", RECOMMENDED, 10
            )
        ),
    ),
    "staged_recommendations": _sql((*WITH_PREDICTIONS, ITEMS), TOP_FIVE),
    "user_favorites": _sql(
        (*WITH_TARGETS, ITEMS),
        WITH_ITEM.format(
            _top(
                "SELECT targetId, movieId, target_rating AS rating FROM profiles",
                "targetId",
                "rating DESC, movieId",
                10,
            )
        ),
    ),
    "popular_items": _sql(
        (*BASE, ITEMS),
        WITH_ITEM.format(
            _top(
                "SELECT movieId, count(rating) AS num_ratings, "
                f"{_round('avg(rating)', 6)} AS avg_rating FROM ratings GROUP BY movieId",
                "",
                "num_ratings DESC, movieId",
                30,
            )
        ),
    ),
    "cold_start_fallback": _sql(
        (*WITH_MEANS, ITEMS, COLD),
        "SELECT targetId, movieId, title, genres, rank FROM ("
        + WITH_ITEM.format(_top("SELECT * FROM unseen", "targetId", "place", 5))
        + ") AS named",
    ),
    "recommendations_for_everybody": _sql(
        (
            *WITH_MEANS,
            EVERYBODY,
            PROFILES,
            _sums(),
            SIMS,
            TOP_K,
            _contributions(),
            MEANS,
            WEIGHTED,
            PREDICTED,
            ITEMS,
            COLD,
        ),
        "SELECT targetId, movieId, predicted_rating, num_raters, avg_similarity, rank, title, genres"
        f" FROM ({TOP_FIVE}) AS best UNION ALL "
        "SELECT targetId, movieId, CAST(NULL AS DOUBLE), CAST(0 AS BIGINT), CAST(NULL AS DOUBLE),"
        " rank, title, genres FROM ("
        + WITH_ITEM.format(_top("SELECT * FROM unseen", "targetId", "place", 5))
        + ") AS named",
    ),
    "profile_summary": _sql(
        WITH_NEW_USER,
        f"""SELECT CAST(-1 AS BIGINT) AS profileId, {_round("avg(target_rating)", 6)} AS avg_rating,
       count(*) AS num_ratings, {RATING_TYPE.format("avg(target_rating)")} AS rating_type
FROM profiles""",
    ),
    "profile_favorites": _sql(
        (*WITH_NEW_USER, ITEMS),
        "SELECT f.*, coalesce(i.title, concat('Movie ', f.movieId)) AS title, i.genres FROM ("
        + _top(
            "SELECT targetId, movieId, target_rating AS rating FROM profiles",
            "targetId",
            "rating DESC, movieId",
            5,
        )
        + ") AS f LEFT JOIN items i ON i.movieId = f.movieId",
    ),
    "profile_neighbors": _sql(
        WITH_NEW_SIMS,
        f"""SELECT targetId, userId, {_round("similarity", 6)} AS similarity, common_movies,
       avg_rating, num_ratings, rating_type FROM nearest""",
    ),
    "profile_predictions": _sql(
        WITH_NEW_PREDICTIONS,
        "SELECT targetId, movieId, predicted_rating, num_contributors FROM predicted",
    ),
    "explain_predictions": _sql(WITH_NEW_PREDICTIONS, EXPLAINED.format("predicted")),
    "explain_recommendations": _sql(
        (*WITH_NEW_PREDICTIONS, NEW_RANKED), EXPLAINED.format("ranked")
    ),
    "profile_recommendations": _sql(
        (*WITH_NEW_PREDICTIONS, NEW_RANKED, ITEMS),
        """SELECT r.targetId, r.rank, r.movieId,
       coalesce(i.title, concat('Movie ', r.movieId)) AS title, r.predicted_rating,
       r.num_contributors
FROM ranked r LEFT JOIN items i ON i.movieId = r.movieId""",
    ),
    "profile_confidence": _sql(
        WITH_NEW_PREDICTIONS,
        f"SELECT targetId, {CONFIDENCE.format('num_contributors')} AS confidence,"
        " count(*) AS count FROM predicted GROUP BY 1, 2",
    ),
    "user_profile": _sql(
        (*WITH_MEANS, ITEMS),
        f"""SELECT a.userId, a.avg_rating, a.num_ratings,
       {RATING_TYPE.format("a.avg_rating")} AS rating_type, b.movieId, b.rating, b.rank,
       coalesce(i.title, concat('Movie ', b.movieId)) AS title, i.genres
FROM averages a JOIN ({_top("SELECT * FROM ratings", "userId", "rating DESC, movieId", 5)}) AS b
  ON b.userId = a.userId
LEFT JOIN items i ON i.movieId = b.movieId""",
    ),
    "compare_common_items": _sql((*WITH_NEW_USER, COMMON), "SELECT * FROM common"),
    "compare_users": _sql(
        (*WITH_NEW_USER, COMMON, _sums("others", "other_averages")),
        f"""SELECT s.targetId, s.userId, {_round("s.pearson", 4)} AS similarity,
       {SIMILARITY_BAND.format("s.pearson")} AS interpretation, s.n AS common_movies,
       {_percent("g.agreements", "s.n")} AS agreement_pct
FROM (SELECT *, CASE WHEN n >= 3 THEN {PEARSON_OR_NULL} END AS pearson FROM sums) AS s
JOIN (SELECT targetId, userId, count(*) FILTER (WHERE abs(rating1 - rating2) <= 1) AS agreements
      FROM common GROUP BY targetId, userId) AS g
  ON g.targetId = s.targetId AND g.userId = s.userId""",
    ),
    "compare_chosen_users": _sql(
        (*WITH_TARGETS, _sums()),
        f"""SELECT s.targetId, s.userId, {_round("s.pearson", 4)} AS similarity,
       {SIMILARITY_BAND.format("s.pearson")} AS interpretation, s.n AS common_movies,
       {_percent("g.agreements", "s.n")} AS agreement_pct
FROM (SELECT *, {PEARSON_OR_NULL} AS pearson FROM sums) AS s
JOIN (SELECT p.targetId, o.userId,
             count(*) FILTER (WHERE abs(p.target_rating - o.rating) <= 1) AS agreements
      FROM profiles p JOIN ratings o ON o.movieId = p.movieId GROUP BY p.targetId, o.userId) AS g
  ON g.targetId = s.targetId AND g.userId = s.userId
WHERE s.targetId = 10 AND s.userId IN (
  SELECT userId FROM averages ORDER BY num_ratings DESC, userId LIMIT 20)""",
    ),
    "compare_agreement_lists": _sql(
        (*WITH_NEW_USER, COMMON, ITEMS),
        TITLED.format("""SELECT *, CASE WHEN rating1 >= 4 AND rating2 >= 4 THEN 'both_loved'
                       ELSE 'both_disliked' END AS verdict
FROM common WHERE (rating1 >= 4 AND rating2 >= 4) OR (rating1 <= 2.5 AND rating2 <= 2.5)"""),
    ),
    "compare_disagreements": _sql(
        (*WITH_NEW_USER, COMMON, ITEMS),
        TITLED.format(
            _top(
                "SELECT *, abs(rating1 - rating2) AS difference FROM common",
                "targetId, userId",
                "difference DESC, movieId",
                10,
            )
        ),
    ),
    "rating_regression": _sql(
        (*WITH_NEW_USER, COMMON),
        f"""SELECT targetId, userId, count(*) AS points,
       CASE WHEN min(rating1) < max(rating1)
            THEN {_round("regr_slope(rating2, rating1)", 6)} END AS slope,
       CASE WHEN min(rating1) < max(rating1)
            THEN {_round("regr_intercept(rating2, rating1)", 6)} END AS intercept,
       CASE WHEN min(rating1) = max(rating1) THEN NULL
            WHEN min(rating2) = max(rating2) THEN 1.0
            ELSE {_round("regr_r2(rating2, rating1)", 6)} END AS r2
FROM common GROUP BY targetId, userId""",
    ),
    "loved_unseen": _sql(
        (*WITH_NEW_SIMS, LOVED, ITEMS),
        TITLED.format(
            _top("SELECT * FROM loved", "targetId, userId, loved_by", "rating DESC, movieId", 10)
        ),
    ),
    "explore_neighbors": _sql(WITH_NEW_SIMS, _explored("similarity DESC")),
    "explore_neighbors_by_common": _sql(WITH_NEW_SIMS, _explored("common_movies DESC")),
    "explore_neighbors_by_mean_gap": _sql(WITH_NEW_SIMS, _explored("mean_gap")),
    "similarity_histogram": _sql(
        WITH_NEW_SIMS,
        f"""SELECT bin, {_round("bin * 0.05e0", 4)} AS bin_start,
       {_round("(bin + 1) * 0.05e0", 4)} AS bin_end, count(*) AS count
FROM (SELECT CAST(least(19, floor(similarity * 20.0e0)) AS INTEGER) AS bin FROM sims) AS b
GROUP BY bin""",
    ),
}
