"""The package on the workers, wherever the driver was started from."""

from __future__ import annotations

import functools
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="carelens-code-"), "carelens.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted(package.rglob("*.py")):
            out.write(module, module.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def shipped(function: Callable) -> Callable:
    """The function, after sending the package to the workers of the session it gets first."""

    @functools.wraps(function)
    def run(spark: SparkSession, *rest):
        ship(spark)
        return function(spark, *rest)

    return run
