"""Spark-native preparation and annotation of episodic, frame-indexed data."""

from __future__ import annotations

import os
from pathlib import Path


def ship_to_workers(spark) -> None:
    """Let Python workers that share this file system import the package; on a
    cluster without one, submit it with --py-files."""
    root = str(Path(__file__).resolve().parent.parent)
    have = spark.sparkContext.environment.get("PYTHONPATH") or os.environ.get("PYTHONPATH", "")
    if root not in have.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, have) if x)
