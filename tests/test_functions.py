import pytest
from pyspark.sql import functions as F

from kinrate.functions.labels import (
    confidence_band,
    rating_type,
    similarity_band,
    stars,
    title_or_default,
)
from kinrate.functions.scores import clamp, pearson, percent, round_half_up


def values(spark, column, inputs, kind="double"):
    df = spark.createDataFrame([(v,) for v in inputs], f"x {kind}")
    return [row[0] for row in df.select(column(F.col("x"))).collect()]


def test_rounding_is_half_up_in_decimal(spark):
    got = values(spark, lambda x: round_half_up(x, 2), [1.005, -1.005, 2.675, 4.968, None])
    assert got == [1.01, -1.01, 2.68, 4.97, None]


def test_no_digits_keeps_the_value(spark):
    assert values(spark, lambda x: round_half_up(x, None), [1 / 3]) == [1 / 3]


def test_clamp_limits_and_keeps_null(spark):
    got = values(spark, lambda x: clamp(x, 0.5, 5.0), [7.0, -2.0, 3.3, None])
    assert got == [5.0, 0.5, 3.3, None]


def test_percent_of_nothing_is_null(spark):
    assert values(spark, lambda x: percent(x, F.lit(3.0)), [1.0]) == [33.33]
    assert values(spark, lambda x: percent(x, F.lit(0)), [1.0]) == [None]


def test_pearson_without_variance_is_null(spark):
    assert values(spark, lambda x: pearson(x, F.lit(4.0), F.lit(9.0)), [6.0, -6.0]) == [1.0, -1.0]
    assert values(spark, lambda x: pearson(x, F.lit(0.0), F.lit(9.0)), [0.0]) == [None]


@pytest.mark.parametrize(
    "label, inputs, expected",
    [
        (
            rating_type,
            [4.0, 3.999, 2.501, 2.5, None],
            ["Generous", "Balanced", "Balanced", "Critical", None],
        ),
        (
            similarity_band,
            [0.8, 0.79, 0.6, 0.4, 0.39, -1.0, None],
            [
                "Very Similar",
                "Similar",
                "Similar",
                "Somewhat Similar",
                "Different Taste",
                "Different Taste",
                None,
            ],
        ),
        (
            confidence_band,
            [20.0, 19.0, 10.0, 9.0],
            ["High Confidence", "Medium Confidence", "Medium Confidence", "Low Confidence"],
        ),
        (
            stars,
            [5.0, 4.5, 3.49, 0.5, 0.0, None],
            ["⭐⭐⭐⭐⭐", "⭐⭐⭐⭐½⭐", "⭐⭐⭐☆☆", "½⭐☆☆☆☆", "☆☆☆☆☆", None],
        ),
    ],
)
def test_labels(spark, label, inputs, expected):
    assert values(spark, label, inputs) == expected


def test_title_falls_back_to_the_id(spark):
    df = spark.createDataFrame([(7, None), (8, "Up")], "movieId int, title string")
    got = df.select(title_or_default(F.col("title"), F.col("movieId"))).collect()
    assert [r[0] for r in got] == ["Movie 7", "Up"]


def test_rounding_of_very_large_values(spark):
    df = spark.createDataFrame([(2e10,), (1e30,), (None,)], "x double")
    got = [r.y for r in df.select(round_half_up(F.col("x"), 6).alias("y")).collect()]
    assert got == [2e10, 1e30, None]
