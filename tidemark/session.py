"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution; cluster settings win over these."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        # Secrets stay out of plans, the UI and progress events.
        "spark.sql.redaction.options.regex": "(?i)secret|password|token|jaas",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def workspace(spark: SparkSession, label: str) -> str:
    """A fresh directory for tables, checkpoints and stream state of one run.

    It lies under ``spark.checkpoint.dir``, the folder all executors share. A
    machine-local folder is used only where that is unset and there is no other machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/tidemark-{label}-{uuid.uuid4().hex}"
    if not one_machine(spark):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"tidemark-{label}-")


def one_machine(spark: SparkSession) -> bool:
    """Whether driver and executors share a disk."""
    return spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
