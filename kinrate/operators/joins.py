"""Joining a large table with a small or unevenly used one."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from kinrate.config import SHARE_ROWS, SIDE_ROWS, SPLIT_KEYS


def heavy_keys(df: DataFrame, key: str, rows: int, name: str) -> DataFrame:
    """The most frequent keys and in how many parts of ``rows`` each should be dealt.

    There are at most ``SPLIT_KEYS`` of them per shuffle partition, a list that may always
    be broadcast. A key that is not among them has less than one part in ``SPLIT_KEYS`` of
    a mean partition's rows, however large the table. No key is dealt to more parts than
    there are partitions.
    """
    conf = df.sparkSession.conf
    partitions = int(conf.get("spark.sql.shuffle.partitions"))
    initial = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    partitions = max(partitions, int(initial or 0))
    parts = F.least(F.ceil(F.col("_rows") / float(rows)), F.lit(partitions))
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > rows)
        .orderBy(F.col("_rows").desc(), key)
        .limit(SPLIT_KEYS * partitions)
        .select(key, parts.cast("int").alias(name))
    )


def _cells(df: DataFrame, on: str, counts, deal_by: str, deal: str, copy: str) -> DataFrame:
    """Deal rows to parts ``_deal`` by a hash, and copy them to all parts ``_copy``."""
    for count in counts:
        df = df.join(F.broadcast(count), on, "left")
    parts = {c: F.coalesce(F.col(f"{c}_parts"), F.lit(1)) for c in (deal, copy)}
    return (
        df.withColumn(deal, F.pmod(F.xxhash64(deal_by), parts[deal]).cast("int"))
        .withColumn(copy, F.explode(F.sequence(F.lit(0), parts[copy] - 1)))
        .drop(f"{deal}_parts", f"{copy}_parts")
    )


def join_side(
    large: DataFrame,
    side: DataFrame,
    on: str,
    share_by: str,
    side_by: str,
    broadcast_side: bool = False,
    share_rows: int = SHARE_ROWS,
    side_rows: int = SIDE_ROWS,
) -> DataFrame:
    """Inner join on one key that a third of the rows may have in common.

    With ``broadcast_side`` the caller states that it has checked the size of
    ``side``, and ``large`` stays where it is. Otherwise the rows of a heavy key
    are dealt to parts on both sides, by hashes of ``share_by`` and ``side_by``, and
    every pair of parts meets in a join key of its own. Only rows of heavy keys are
    copied for this, and both ways give the same rows.
    """
    if broadcast_side:
        return large.join(F.broadcast(side), on)
    counts = (
        heavy_keys(large, on, share_rows, "_share_parts"),
        heavy_keys(side, on, side_rows, "_side_parts"),
    )
    left = _cells(large, on, counts, share_by, "_share", "_side")
    right = _cells(side, on, counts, side_by, "_side", "_share")
    return left.join(right, [on, "_share", "_side"]).drop("_share", "_side")


def join_lists(
    large: DataFrame,
    side: DataFrame,
    on: str,
    share_by: str,
    side_by: str,
    name: str,
    share_rows: int = SHARE_ROWS,
    side_rows: int = SIDE_ROWS,
    tasks: int | None = None,
) -> DataFrame:
    """The rows of :func:`join_side`, those of the side that a row of ``large`` meets in a list.

    The list ``name`` holds structs of the side's other columns, ``side_by`` first and in order
    of it. A heavy key's parts make a list each, of about ``side_rows``, so what follows
    the join is one row for a row and part instead of one for each pair. ``tasks`` fixes in how
    many tasks it takes place, whose output may be many times their input.
    """
    counts = (
        heavy_keys(large, on, share_rows, "_share_parts"),
        heavy_keys(side, on, side_rows, "_side_parts"),
    )
    left = _cells(large, on, counts, share_by, "_share", "_side")
    right = _cells(side, on, counts, side_by, "_side", "_share")
    keys = [on, "_share", "_side"]
    if tasks is not None:
        left, right = left.repartition(tasks, *keys), right.repartition(tasks, *keys)
    carried = [c for c in side.columns if c not in (on, side_by)]
    lists = right.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(side_by, *carried))).alias(name)
    )
    return left.join(lists, keys).drop("_share", "_side")


def sorted_by(df: DataFrame, *columns: str) -> DataFrame:
    """Rows dealt to tasks by ranges of the columns and sorted in each.

    Stored so, files and row groups cover narrow ranges, which scans skip by their
    statistics, and rows of one value come in a row, which partial sums reduce to one. Give
    more than one column, so that a value that a third of the rows have is spread.
    """
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)


def one_of(column: str, values: Sequence[int], at_once: int = 10) -> Column:
    """Whether the column has one of the values, in a form that reaches row group statistics.

    Longer lists than ``at_once`` would reach the scan as their least and greatest
    value only (``spark.sql.parquet.pushdown.inFilterThreshold``).
    """
    ordered = sorted(values)
    parts = [ordered[i : i + at_once] for i in range(0, len(ordered), at_once)]
    return reduce(Column.__or__, [F.col(column).isin(part) for part in parts], F.lit(False))


def top_per(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of each group, numbered from 1.

    ``order`` must end in a key that makes it total. Spark keeps ``n`` rows per
    group and task before the shuffle, so a hot group costs no more than others.
    Without keys it is a global top-n, and only its ``n`` rows are numbered.
    """
    if not keys:
        return (
            df.orderBy(*order)
            .limit(n)
            .withColumn(rank, F.row_number().over(Window.orderBy(*order)))
        )
    numbered = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(rank, numbered).filter(F.col(rank) <= n)
