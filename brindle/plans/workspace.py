"""Where queries write."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def workspace(spark: SparkSession) -> str:
    """A new path in a folder of this application's: in spark.checkpoint.dir if set, else (local masters) in a temporary folder."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/brindle-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
