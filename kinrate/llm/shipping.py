"""Arrow functions of this package on the executors."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import kinrate

_shipped: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Give the executors this package through Spark's own file service, once a session.

    The archive on the driver is only what Spark uploads; no task reads that path.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(kinrate.__file__))
    if os.path.isdir(package):
        name = os.path.join(tempfile.mkdtemp(prefix="kinrate-code-"), "kinrate_code")
        context.addPyFile(
            shutil.make_archive(name, "zip", os.path.dirname(package), os.path.basename(package))
        )
    _shipped.add(context.applicationId)


def arrow_rows(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow`` with a function of this package."""
    _ship(df.sparkSession)
    return df.mapInArrow(function, schema)
