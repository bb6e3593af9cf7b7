"""Stage tables in the shared folder of the cluster: published by manifest, freed by scope.

A stage is written to a folder of its own, an attempt, and exists from the moment its
manifest does: one small file, renamed into place, that names the attempt, its files with
their sizes, and the rows. A write that was cut off has no manifest, and readers see no table;
a table that lost a file, or has one that the manifest does not name, is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from kinrate.config import BROADCAST_ROWS

CHECKPOINT_DIR = "spark.checkpoint.dir"
# Whether Spark deletes the shuffle files of a query at its end, and not when the driver collects its garbage.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
MANIFEST = "manifest.json"
_removed_at_end: set[str] = set()


class IncompleteStage(RuntimeError):
    """A stored table whose files are not those of its manifest."""


# --- where --------------------------------------------------------------------


def _path(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def shared_dir(spark: SparkSession) -> str:
    """The folder the session names for intermediate tables.

    Where ``spark.checkpoint.dir`` is unset it is a folder in the session's warehouse that
    goes when the application ends. That is refused if executors are on other machines
    and the warehouse is a local folder, which they would not share.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    application = spark.sparkContext.applicationId
    path = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/kinrate-stages/{application}"
    place, files = _path(spark, path)
    master = spark.sparkContext.master
    one_machine = master == "local" or master.startswith("local[")
    if files.getUri().getScheme() == "file" and not one_machine:
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    if application not in _removed_at_end:
        files.mkdirs(place)
        files.deleteOnExit(place)
        _removed_at_end.add(application)
    return path


def new_path(spark: SparkSession, name: str) -> str:
    """A place for a new table or folder, which the scope around it, if any, frees."""
    parent = f"{shared_dir(spark)}/kinrate-{uuid.uuid4().hex}"
    scope = _scope.get()
    if scope is not None:
        scope.made.append((spark, parent))
    return f"{parent}/{name}"


# --- scopes -------------------------------------------------------------------


class Scope:
    """Tables that go together."""

    def __init__(self, outer: Scope | None):
        self.outer = outer
        self.made: list[tuple[SparkSession, str]] = []

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """A stage that outlives this scope and belongs to the one around it."""
        token = _scope.set(self.outer)
        try:
            return stage(df, name)
        finally:
            _scope.reset(token)

    def free(self) -> None:
        for spark, path in self.made:
            place, files = _path(spark, path)
            files.delete(place, True)
        self.made.clear()


_scope: ContextVar[Scope | None] = ContextVar("kinrate_scope", default=None)


@contextmanager
def scratch() -> Iterator[Scope]:
    """Stage tables made inside are deleted at the end, also after an error.

    What is lazy must not read them after that: store a result with ``keep``, or write it,
    inside. Scopes nest; without any, tables stay until the caller deletes them.
    """
    scope = Scope(_scope.get())
    token = _scope.set(scope)
    try:
        yield scope
    finally:
        _scope.reset(token)
        scope.free()


# --- stages -------------------------------------------------------------------


def _listing(spark: SparkSession, folder: str) -> dict[str, int]:
    """Names and sizes of the part files of a folder, by one listing on the driver."""
    place, files = _path(spark, folder)
    if not files.exists(place):
        return {}
    found = {s.getPath().getName(): s.getLen() for s in files.listStatus(place)}
    return {name: size for name, size in sorted(found.items()) if name[0] not in "_."}


def _publish(spark: SparkSession, path: str, manifest: dict) -> None:
    """Put the manifest into place in one step."""
    draft, files = _path(spark, f"{path}/_{uuid.uuid4().hex}")
    out = files.create(draft, True)
    try:
        out.write(bytearray(json.dumps(manifest).encode()))
    finally:
        out.close()
    final, _ = _path(spark, f"{path}/{MANIFEST}")
    files.delete(final, False)
    if not files.rename(draft, final):
        raise IncompleteStage(f"could not publish {path}")


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go at its end: nothing reads them after that."""
    before = spark.conf.get(FILE_CLEANUP)
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(FILE_CLEANUP, before)


def write_stage(df: DataFrame, path: str, notes: dict | None = None, **options) -> dict:
    """Write an attempt below ``path`` and publish it; the manifest.

    ``notes`` are published with it; ``options`` are Parquet's.

    Rows are counted while they are written. An attempt published before is replaced, and only then deleted.
    """
    spark = df.sparkSession
    before = read_manifest(spark, path)
    attempt = f"attempt-{uuid.uuid4().hex}"
    counted = Observation(attempt)
    rows = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    with _shuffles_freed(spark):
        rows.write.options(**options).mode("errorifexists").parquet(f"{path}/{attempt}")
    manifest = {
        "attempt": attempt,
        "rows": counted.get["rows"],
        "schema": df.schema.jsonValue(),
        "files": _listing(spark, f"{path}/{attempt}"),
        "notes": notes or {},
    }
    _publish(spark, path, manifest)
    if before is not None:
        old, files = _path(spark, f"{path}/{before['attempt']}")
        files.delete(old, True)
    return manifest


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    """What was published at ``path``; None if nothing was."""
    place, files = _path(spark, f"{path}/{MANIFEST}")
    if not files.exists(place):
        return None
    opened = files.open(place)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
    finally:
        opened.close()
    return json.loads(text)


def read_stage(spark: SparkSession, path: str) -> DataFrame | None:
    """The table published at ``path``; None where none was.

    Raises IncompleteStage if its files are not those of the manifest, by name and size.
    """
    manifest = read_manifest(spark, path)
    if manifest is None:
        return None
    if _listing(spark, f"{path}/{manifest['attempt']}") != manifest["files"]:
        raise IncompleteStage(f"{path} is not what its manifest says")
    return _stored(spark, path, manifest)


def published(spark: SparkSession, folder: str) -> list[str]:
    """Names of the tables published directly below a folder."""
    place, files = _path(spark, folder)
    if not files.exists(place):
        return []
    names = [s.getPath().getName() for s in files.listStatus(place) if s.isDirectory()]
    return sorted(name for name in names if read_manifest(spark, f"{folder}/{name}"))


def delete(spark: SparkSession, path: str) -> None:
    """Delete what is stored at ``path``, its manifest first."""
    for part in (f"{path}/{MANIFEST}", path):
        place, files = _path(spark, part)
        files.delete(place, True)


def committed(spark: SparkSession, path: str) -> bool:
    """Whether Spark has finished writing a plain table there."""
    place, files = _path(spark, f"{path}/_SUCCESS")
    return files.exists(place)


def _stored(spark: SparkSession, path: str, manifest: dict) -> DataFrame:
    schema = T.StructType.fromJson(manifest["schema"])
    df = spark.read.schema(schema).parquet(f"{path}/{manifest['attempt']}")
    df._kinrate_rows, df._kinrate_path = manifest["rows"], path
    return df


def discard(df: DataFrame) -> None:
    """Delete the stage behind ``df``, as :func:`stage` returned it, before its scope ends."""
    place, files = _path(df.sparkSession, df._kinrate_path)
    files.delete(place, True)


def stage(df: DataFrame, name: str, folder: str | None = None, **options) -> DataFrame:
    """Write a table to the shared folder and go on from there.

    What follows reads files instead of repeating the work, survives the loss of
    executors, and lets Spark plan with the measured size.
    """
    spark = df.sparkSession
    path = new_path(spark, name) if folder is None else f"{folder}/{name}"
    return _stored(spark, path, write_stage(df, path, **options))


def stage_parts(parts: Iterable[DataFrame], name: str) -> DataFrame:
    """One stage of tables of the same columns, each worked out when the one before is written."""
    path, manifests = None, []
    for part in parts:
        spark = part.sparkSession
        path = path or new_path(spark, name)
        manifests.append(write_stage(part, f"{path}/{len(manifests)}"))
    schema = T.StructType.fromJson(manifests[0]["schema"])
    files = [f"{path}/{i}/{m['attempt']}" for i, m in enumerate(manifests)]
    df = spark.read.schema(schema).parquet(*files)
    df._kinrate_rows, df._kinrate_path = sum(m["rows"] for m in manifests), path
    return df


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` itself if it is a stage as read back, else a stage of it."""
    return df if hasattr(df, "_kinrate_rows") else stage(df, name)


def rows_of(df: DataFrame) -> int:
    """The number of rows: a stage's from its manifest, any other's by counting."""
    known = getattr(df, "_kinrate_rows", None)
    return df.count() if known is None else known


def few_rows(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether a table is small enough to be broadcast, by its rows."""
    return rows_of(df) <= limit
