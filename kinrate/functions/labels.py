"""Verbal labels for means, similarities and contributor counts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Label texts, thresholds and star glyphs.
GENEROUS, CRITICAL, BALANCED = "Generous", "Critical", "Balanced"
RATING_TYPES = (GENEROUS, CRITICAL, BALANCED)
GENEROUS_FROM, CRITICAL_TO = 4.0, 2.5
SIMILARITY_BANDS = ((0.8, "Very Similar"), (0.6, "Similar"), (0.4, "Somewhat Similar"))
SIMILARITY_REST = "Different Taste"
CONFIDENCE_BANDS = ((20, "High Confidence"), (10, "Medium Confidence"))
CONFIDENCE_REST = "Low Confidence"
FULL_STAR, HALF_STAR, EMPTY_STAR = "⭐", "½⭐", "☆"
STARS = 5


def _band(value: Column, bands, rest: str) -> Column:
    floor, text = bands[0]
    chosen = F.when(value >= floor, text)
    for floor, text in bands[1:]:
        chosen = chosen.when(value >= floor, text)
    return chosen.when(value.isNotNull(), rest)


def rating_type(mean: Column) -> Column:
    """How a user tends to rate, from the mean rating."""
    return (
        F.when(mean >= GENEROUS_FROM, GENEROUS)
        .when(mean <= CRITICAL_TO, CRITICAL)
        .when(mean.isNotNull(), BALANCED)
    )


def similarity_band(similarity: Column, bands=SIMILARITY_BANDS) -> Column:
    return _band(similarity, bands, SIMILARITY_REST)


def confidence_band(contributors: Column, bands=CONFIDENCE_BANDS) -> Column:
    return _band(contributors, bands, CONFIDENCE_REST)


def stars(rating: Column) -> Column:
    """Five-place star text: whole stars, one half star from .5 up, empty rest."""
    whole = F.floor(rating).cast("int")
    half = (rating - whole >= 0.5).cast("int")
    return F.concat(
        F.repeat(F.lit(FULL_STAR), whole),
        F.repeat(F.lit(HALF_STAR), half),
        F.repeat(F.lit(EMPTY_STAR), F.lit(STARS) - whole - half),
    )


def title_or_default(title: Column, item: Column) -> Column:
    """The title, or ``Movie <id>`` for an item without one."""
    return F.coalesce(title, F.concat(F.lit("Movie "), item.cast("string")))
