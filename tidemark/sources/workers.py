"""This package on the Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def shipped(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per application (Spark's file server delivers it)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import tidemark

    root = os.path.dirname(os.path.abspath(tidemark.__file__))
    name = os.path.join(tempfile.mkdtemp(prefix="tidemark-code-"), "tidemark_workers.zip")
    with zipfile.ZipFile(name, "w") as bundle:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    bundle.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(name)
    _SHIPPED.add(sc.applicationId)
