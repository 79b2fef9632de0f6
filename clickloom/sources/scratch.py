"""Folders for tables written half-way through a job.

They lie in the shared folder named by ``spark.checkpoint.dir``, which every
executor can reach.  Only a local session without that setting gets a folder of
this machine.  Each call gives a new, unused path.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def scratch_path(spark: SparkSession, name: str) -> str:
    base = spark.conf.get(SETTING, None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError(f"set {SETTING} to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="clickloom-")
    return f"{base.rstrip('/')}/clickloom/{uuid.uuid4().hex}/{name}"
