"""Brings this package to the Python workers of a cluster."""

from __future__ import annotations

import os
import zipfile

import reviewmill
from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Adds the package to the running application, once.

    Spark hands the archive from the driver to every executor, so that task
    functions can import it there, wherever it is installed on the driver.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(reviewmill.__file__))
    # In the context's own folder on the driver, which goes when the context stops.
    archive = os.path.join(spark.sparkContext._temp_dir, "reviewmill_package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for top, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(top, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
