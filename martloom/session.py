"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "martloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for.

    ``conf`` overrides any of them; keys are Spark setting names (pass with ``**{...}``).
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # chained joins share one partitioning, which splitting a hot key gives up
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.compression.codec": "zstd",
        # the JVM does not compile methods above 8000 bytes; cleaning a wide table makes such ones
        "spark.sql.codegen.hugeMethodLimit": "8000",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the shared folder named by ``spark.checkpoint.dir``.

    Every executor has to see it, so a machine-local folder is only used where the setting
    is absent and the whole session runs in one process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="martloom-")
    return f"{root.rstrip('/')}/martloom/{label}-{uuid.uuid4().hex}"


def shuffle_width(spark: SparkSession) -> int:
    """Number of shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
