"""The folder that driver and executors share, for tables that a run writes itself."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name under spark.checkpoint.dir; a temporary one only where none is set
    and driver and executors are one process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if (spark.conf.get("spark.master", None) or "").split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="changeloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
