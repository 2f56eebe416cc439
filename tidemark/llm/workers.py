"""Python workers that can import this package."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Let workers look for the package where the driver has it.

    On a cluster the package is installed or sent with ``--py-files``; this serves sessions that were
    started from another folder, and does nothing where the folder does not exist.
    """
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, ROOT]))
