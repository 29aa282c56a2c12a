"""The folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_own: dict[str, str] = {}


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder all executors share (spark.checkpoint.dir); one of its own only where that is unset on a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = "file://" + tempfile.mkdtemp(prefix="tessella-")
        root = _own[app]
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
