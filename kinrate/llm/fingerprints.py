"""Fingerprints of documents from closed syncmers, in DataFrame expressions only.

Words are runs of characters other than ASCII white space. Of every group of six words in a
row, the inner substrings are its five pairs of neighbouring words. The group is an anchor
if the pair with the least hash stands at its beginning or its end: this depends on the
group's own words only, so that text inserted or replaced elsewhere moves no anchor. The
fingerprint is the hashes of all distinct anchors in order, in hexadecimal. The likeness of two
fingerprints is the Jaccard similarity of their anchors. ``anchor_rows`` gives each distinct anchor of a
document with the word at which it first stands, and ``matches_with_next`` the places at which a document and
the next one have the same anchors.

A text of fewer than six words has one anchor, all its words. A null text counts as
empty; a text without words has an empty fingerprint, and two of those are alike (1).
Equal texts have equal fingerprints. Rows are taken one by one, repeated ones too. A null doc_id
has no place in the order of documents, so its row has no neighbour and is left out there.
Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

GROUP_WORDS = 6
SKETCH = None  # hashes kept of a text's distinct anchors: all of them
SPACES = " \t\n\x0b\x0c\r"  # fixed value: ASCII white space
LEAST_BUCKETS = 8


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, even if a function over elements uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _pairs(words: Column) -> Column:
    """A hash of each word and the next."""
    hashed = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1)))
    return F.slice(hashed, F.lit(1), F.size(words) - 1)


def _syncmers(pairs: Column) -> Column:
    """Places of the groups of which an outer pair is the least."""
    last = GROUP_WORDS - 2
    pair = lambda i, step: F.get(pairs, i + step)
    groups = F.sequence(F.lit(0), F.size(pairs) - 1 - last)
    return F.filter(
        groups,
        lambda i: F.least(pair(i, 0), pair(i, last)) <= F.least(*[pair(i, s) for s in range(1, last)]),
    )


def _anchors(text: Column, value: Callable[[Column, Column], Column], kind: str) -> Column:
    """``value`` of hash and place of each anchor, as a word number from 0, in order of places."""
    trimmed = F.btrim(text, F.lit(SPACES))
    last = GROUP_WORDS - 2
    # every other pair covers all words of the group
    group = lambda pairs, i: F.xxhash64(*[F.get(pairs, i + s) for s in range(0, last + 1, 2)])

    def of_words(words: Column) -> Column:
        return (
            F.when(
                F.size(words) >= GROUP_WORDS,
                _let(_pairs(words), lambda p: F.transform(_syncmers(p), lambda i: value(group(p, i), i))),
            )
            .when(F.get(words, F.lit(0)) == "", F.array().cast(f"array<{kind}>"))
            .otherwise(F.array(value(F.xxhash64(words), F.lit(0))))
        )

    return _let(F.split(trimmed, r"[\x20\x09-\x0D]+"), of_words)


def sketch(text: Column) -> Column:
    """The hashes of all distinct anchors, in order."""
    return F.sort_array(F.array_distinct(_anchors(text, lambda h, i: h, "bigint")))


def anchors(text: Column) -> Column:
    """Hash and place of all anchors, in order of places."""
    kind = "struct<anchor: bigint, position: int>"
    return _anchors(text, lambda h, i: F.struct(h.alias("anchor"), i.alias("position")).cast(kind), kind)


def fingerprint(hashes: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits for each hash."""
    digits = F.transform(hashes, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0"))
    return F.array_join(digits, "")


def likeness(a: Column, b: Column) -> Column:
    """From 0 to 1, of two sketches."""

    def share(common: Column) -> Column:
        union = F.size(a) + F.size(b) - common
        return F.when(union == 0, F.lit(1.0)).otherwise(common / union)

    return _let(F.size(F.array_intersect(a, b)), share)


def _range_bucket(value: Column, splits: list[int]) -> Column:
    """How many of the ascending splits are not above a value, in two short searches."""
    if not splits:
        return F.lit(0)
    step = max(1, round(len(splits) ** 0.5))
    array = lambda values: F.array(*[F.lit(v) for v in values]).cast("array<bigint>")
    below = lambda values: F.size(F.filter(values, lambda s: s <= value))
    blocks = below(array(splits[step - 1 :: step]))
    return blocks * step + below(F.slice(array(splits), blocks * step + 1, F.lit(step)))


def with_next(docs: DataFrame) -> tuple[DataFrame, Window]:
    """Rows by ranges of doc_id, each range followed by the first row of the next one
    (``guest``), and the window in which the next document is the next row.

    Order: descending doc_id, then text; after the last document comes the first again.
    """
    docs = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text")
    )
    buckets = max(LEAST_BUCKETS, 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / buckets for i in range(1, buckets)]
    splits = docs.agg(F.percentile_approx("doc_id", shares, 20 * buckets)).first()[0] or []
    dealt = docs.withColumn("bucket", _range_bucket(F.col("doc_id"), sorted(set(splits))))
    # the largest doc_id of each range: as many rows as there are ranges
    tops = [(r.bucket, r.top) for r in dealt.groupBy("bucket").agg(F.max("doc_id").alias("top")).collect()]
    tops.sort()
    # the range above each, and for the topmost the lowest one, after whose end it starts again
    hosts = [(top, tops[(i + 1) % len(tops)][0]) for i, (_, top) in enumerate(tops)]
    hosts = docs.sparkSession.createDataFrame(hosts, "doc_id bigint, bucket int")
    guests = docs.join(F.broadcast(hosts), "doc_id").withColumn("guest", F.lit(True))
    rows = dealt.withColumn("guest", F.lit(False)).unionByName(guests.select(*dealt.columns, "guest"))
    order = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").desc(), F.col("text").desc())
    return rows, order


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its text with the second half replaced by the
    beginning of the next document, and how like they and the next document's are."""
    rows, order = with_next(docs)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.col("n_chars") - half), F.substring("next_text", F.lit(1), half)
    )
    edits = (
        rows.withColumn("next_text", F.lead("text").over(order))
        .withColumn("n_chars", F.length("text"))
        .withColumn("edited", edited)
        .select(
            "bucket",
            "guest",
            "doc_id",
            F.col("n_chars").cast("bigint").alias("n_chars"),
            "text",
            F.sha2("edited", 256).alias("edited_sha256"),
            sketch(F.col("text")).alias("own"),
            F.when(~F.col("guest"), sketch(F.col("edited"))).alias("changed"),
        )
    )
    return (
        edits.withColumn("next", F.lead("own").over(order))
        .where(~F.col("guest"))
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            fingerprint(F.col("own")).alias("fingerprint"),
            fingerprint(F.col("changed")).alias("edited_fingerprint"),
            likeness(F.col("own"), F.col("changed")).alias("near_edited"),
            likeness(F.col("own"), F.col("next")).alias("near_next"),
        )
    )


def _first_places(rows: DataFrame, keys: list[str], text: str, position: str) -> DataFrame:
    places = rows.select(*keys, F.inline(anchors(F.col(text))))
    return places.groupBy(*keys, "anchor").agg(F.min("position").alias(position))


def anchor_rows(docs: DataFrame) -> DataFrame:
    """doc_id, anchor, and the word (from 0) at which the document first has it.

    Rows that share a doc_id are one document here; those with a null doc_id are another.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    return _first_places(rows, ["doc_id"], "text", "position")


def matches_with_next(docs: DataFrame) -> DataFrame:
    """doc_id, anchor, position and next_position of each anchor that a document shares with the next."""
    rows, order = with_next(docs)
    placed = (
        rows.withColumn("row", F.row_number().over(order))
        .withColumn("next_text", F.lead("text").over(order))
        .where(~F.col("guest"))
    )
    keys = ["bucket", "row", "doc_id"]
    own = _first_places(placed, keys, "text", "position")
    after = _first_places(placed.where("next_text IS NOT NULL"), keys, "next_text", "next_position")
    return own.join(after, [*keys, "anchor"]).select("doc_id", "anchor", "position", "next_position")
