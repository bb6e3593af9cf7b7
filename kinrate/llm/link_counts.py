"""Exact numbers of links within classes of near copies, few of them found pair by pair.

Each class has a centre: the shingles that more than half of its sets have. A set A is described by
where it departs from the centre C: d shingles of C that it lacks, and e others. With o departures
in common, two sets have |C| - d - d' + o shingles in common, so that the rule
``100 * common >= percent * union`` is exactly

    weight + weight' <= room + (100 + percent) * o
    weight = 100 * d + percent * e,   room = (100 - percent) * |C|

* Pairs with ``weight + weight' <= room`` are linked whatever o is. They are counted, not listed: by
  running sums over the distinct weights of a class, at most some three for each shingle of the centre.
* Other pairs need common departures. Departures of a single set are of no account, and sets with
  the same weight and the same others are one kind, compared once. Two kinds meet at the departures
  they share, never as texts; those whose weights no overlap could make up for do not meet at all.

No choice of the centre changes a result; it only settles how many pairs are left to meet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from kinrate.plans.storage import stage

# Kinds that meet in one part of a departure's list; longer lists are dealt to several.
LIST_PART = 4096


def departures(members: DataFrame, percent: int) -> DataFrame:
    """root, set_id, rows, room, weight and the departures from the centre of each set of a class."""
    times = (
        members.select("root", F.explode("shingles").alias("shingle"))
        .groupBy("root", "shingle")
        .agg(F.count("*").alias("times"))
        .where("times > 1")  # a class has three sets at least
    )
    sizes = members.groupBy("root").agg(F.count("*").alias("n_sets"))
    # stored, so that all shingles of a large class need not meet in one task, only those of its centre
    central = stage(times.join(sizes, "root").where("2 * times > n_sets").select("root", "shingle"), "central")
    centres = central.groupBy("root").agg(F.collect_list("shingle").alias("centre"))
    apart = members.join(centres, "root", "left").select(
        "root",
        "set_id",
        "rows",
        F.coalesce("centre", F.array().cast("array<bigint>")).alias("centre"),
        "shingles",
    )
    lost, added = F.array_except("centre", "shingles"), F.array_except("shingles", "centre")
    apart = apart.select(
        "root", "set_id", "rows", F.size("centre").alias("size"), lost.alias("lost"), added.alias("added")
    )
    return apart.select(
        "root",
        "set_id",
        "rows",
        ((100 - percent) * F.col("size").cast("bigint")).alias("room"),
        (100 * F.size("lost").cast("bigint") + percent * F.size("added").cast("bigint")).alias("weight"),
        F.concat("lost", "added").alias("departures"),
    )


def _sure(kinds: DataFrame) -> DataFrame:
    """root, weight and near: the rows of sets of a class whose weights leave no doubt about a link."""
    light = kinds.where("weight <= room")
    points = light.groupBy("root", F.col("weight").alias("at")).agg(F.sum("rows").alias("rows"))
    asked = light.select("root", (F.col("room") - F.col("weight")).alias("at"), "weight").distinct()
    line = points.withColumn("weight", F.lit(None).cast("bigint")).unionByName(asked.withColumn("rows", F.lit(0).cast("bigint")))
    # at the same place, weights come before what asks for them
    upto = Window.partitionBy("root").orderBy("at", F.col("weight").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    return line.withColumn("near", F.sum("rows").over(upto)).where("weight IS NOT NULL").select("root", "weight", "near")


def _by_overlap(kinds: DataFrame, percent: int) -> DataFrame:
    """kind and far: the rows of other kinds that only common departures link it with."""
    spread = kinds.where("n_shared > 0 AND weight - room <= 100 * n_shared").select(
        "root", "kind", "rows", "room", "weight", "n_shared", F.explode("shared").alias("shingle")
    )
    long = spread.groupBy("root", "shingle").agg(F.count("*").alias("length")).where("length > 1")
    dealt = stage(
        spread.join(long, ["root", "shingle"]).withColumn("parts", F.ceil(F.col("length") / LIST_PART).cast("int")).drop("length"),
        "departed",
    )
    fields = ["kind", "rows", "weight", "n_shared"]
    a = dealt.select(
        "root", "shingle", "room", F.pmod(F.hash("kind"), "parts").alias("part"), *[F.col(c).alias(f"a_{c}") for c in fields]
    )
    b = dealt.select(
        "root",
        "shingle",
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        *[F.col(c).alias(f"b_{c}") for c in fields],
    )
    excess = F.col("a_weight") + F.col("b_weight") - F.col("room")
    links = (
        a.join(b, ["root", "shingle", "part"])
        .where("a_kind < b_kind")
        .where((excess > 0) & (excess <= (100 + percent) * F.least("a_n_shared", "b_n_shared")))
        .groupBy("a_kind", "b_kind", "a_rows", "b_rows", excess.alias("excess"))
        .agg(F.count("*").alias("common"))
        .where(F.col("excess") <= (100 + percent) * F.col("common"))
    )
    links = stage(links.select("a_kind", "b_kind", "a_rows", "b_rows"), "overlaps")
    both = links.select(F.col("a_kind").alias("kind"), F.col("b_rows").alias("rows")).unionByName(
        links.select(F.col("b_kind").alias("kind"), F.col("a_rows").alias("rows"))
    )
    return both.groupBy("kind").agg(F.sum("rows").alias("far"))


def links_in_classes(members: DataFrame, percent: int) -> DataFrame:
    """set_id and others: the rows of other sets of its class that each set is linked with.

    members: root, set_id, rows and shingles of every set of classes of three sets or more, each set once.
    """
    apart = stage(departures(members, percent), "apart")
    spread = apart.select("root", "set_id", F.explode("departures").alias("shingle"))
    times = spread.groupBy("root", "shingle").agg(F.count("*").alias("times")).where("times > 1").drop("times")
    shared = (
        spread.join(stage(times, "shared"), ["root", "shingle"])
        .groupBy("set_id")
        .agg(F.sort_array(F.collect_list("shingle")).alias("shared"))
    )
    sets = stage(
        apart.drop("departures")
        .join(shared, "set_id", "left")
        .withColumn("shared", F.coalesce("shared", F.array().cast("array<bigint>"))),
        "departing",
    )
    same = ["root", "room", "weight", "shared"]
    kinds = stage(
        sets.groupBy(*same)
        .agg(F.min("set_id").alias("kind"), F.sum("rows").alias("rows"))
        .withColumn("n_shared", F.size("shared").cast("bigint")),
        "kinds",
    )
    found = (
        kinds.join(_sure(kinds), ["root", "weight"], "left")
        .join(_by_overlap(kinds, percent), "kind", "left")
        .select(
            *same,
            # the rows of the set's own kind, which near holds if it is twice light enough
            F.when(2 * F.col("weight") <= F.col("room"), 0)
            .when(2 * F.col("weight") <= F.col("room") + (100 + percent) * F.col("n_shared"), F.col("rows"))
            .alias("own"),
            (F.coalesce("near", F.lit(0)) + F.coalesce("far", F.lit(0))).alias("others"),
        )
    )
    linked_alike = F.col("own").isNotNull()
    return sets.join(found, same).select(
        "set_id",
        (F.col("others") + F.when(linked_alike, F.col("own") - F.col("rows")).otherwise(0)).cast("bigint").alias("others"),
    )
