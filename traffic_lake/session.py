"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for checkpoints and tables of one run.

    It lies under ``spark.checkpoint.dir``, the folder all nodes share. Only
    where that is unset, as in local tests, a temporary folder is used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
        base = tempfile.mkdtemp(prefix="traffic-lake-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
