"""Data for quality checks: frames to show, with their masks and depth."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def qc_rows(frames: DataFrame, masks: DataFrame, depth: DataFrame, n: int) -> DataFrame:
    """The first n sampled frames of each episode, with the number of masks
    and whether there is a depth map; either may be missing."""
    keys = ["episode_idx", "frame_idx"]
    order = Window.partitionBy("episode_idx").orderBy("frame_idx")
    shown = frames.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= n).drop("__n")
    counts = masks.groupBy(*keys).agg(F.count("*").alias("n_masks"))
    there = depth.select(*keys).distinct().withColumn("has_depth", F.lit(True))
    out = shown.join(counts, keys, "left").join(there, keys, "left")
    return out.withColumns({"n_masks": F.coalesce("n_masks", F.lit(0)), "has_depth": F.coalesce("has_depth", F.lit(False))})


def random_frames(lengths: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """Without sampled frames: n of each episode's at random, sorted."""

    def pick(batches):
        for pdf in batches:
            rows = [(e, int(f)) for e, size in zip(pdf.episode_idx, pdf.length, strict=True) for f in sorted(np.random.RandomState(seed).choice(int(size), min(n, int(size)), replace=False))]
            yield pd.DataFrame(rows, columns=["episode_idx", "frame_idx"])

    return lengths.select("episode_idx", "length").mapInPandas(pick, "episode_idx long, frame_idx long")


def overlay_colors(masks: DataFrame) -> DataFrame:
    """Color number of each mask: its position in the frame."""
    return masks.withColumn("color", F.col("instance_id") % 10)
