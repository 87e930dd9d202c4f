"""Make this package importable in the Python workers of any cluster."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ensure_importable(spark: SparkSession) -> None:
    """Send the package to the executors once per Spark application.

    Workers started from another folder than the repository could not unpickle
    functions of this package otherwise.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, dirs, files in sorted(os.walk(root)):
            dirs[:] = sorted(d for d in dirs if d != "__pycache__")
            for name in sorted(files):
                if name.endswith((".py", ".json")):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("docloom", os.path.relpath(full, root)))
    folder = tempfile.mkdtemp(prefix="docloom-")
    target = os.path.join(folder, "docloom_pkg.zip")
    with open(target, "wb") as f:
        f.write(data.getvalue())
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)
