"""The packages, sent to the executors, which need not have them installed."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import SparkSession

PACKAGES = ("llm", "panelsight")
_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once for each application: the driver serves a zip of the packages to every Python worker."""
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    with tempfile.NamedTemporaryFile(prefix="packages-", suffix=".zip", delete=False) as f:  # read by the driver only
        with zipfile.ZipFile(f, "w") as z:
            for package in PACKAGES:
                for folder, _, names in os.walk(os.path.join(root, package)):
                    for name in names:
                        if name.endswith(".py"):
                            path = os.path.join(folder, name)
                            z.write(path, os.path.relpath(path, root))
    spark.sparkContext.addPyFile(f.name)
    _sent.add(app)


def shipped(query: Callable) -> Callable:
    @functools.wraps(query)
    def run(spark, sf_dir):
        ship(spark)
        return query(spark, sf_dir)
    return run
