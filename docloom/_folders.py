"""Folders that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_OWN: dict[str, str] = {}


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below spark.checkpoint.dir that nothing has used yet; where that is unset, a temporary folder in local mode and an error on a cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        base = _OWN[app] = _OWN.get(app) or tempfile.mkdtemp(prefix="docloom-shared-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
