"""A mock dataset: episodes of seeded noise frames and three instructions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The mock dataset's instructions.
INSTRUCTIONS = (
    "pick up the red cup and place it on the table",
    "grasp the blue block and stack it on the green block",
    "open the drawer and retrieve the spoon",
)


def mock_episodes(spark: SparkSession, episodes: int = 3, frames_per_episode: int = 10) -> DataFrame:
    text = F.element_at(F.array(*map(F.lit, INSTRUCTIONS)), (F.col("id") % 3 + 1).cast("int"))
    return spark.range(episodes).select(F.col("id").alias("episode_idx"), F.lit(frames_per_episode).cast("long").alias("length"), text.alias("instruction"))


def mock_frames(spark: SparkSession, episodes: int = 3, frames_per_episode: int = 10, height: int = 480, width: int = 640) -> DataFrame:
    """(episode_idx, frame_idx, h, w, data): RGB noise, seeded by episode and frame."""
    frames = mock_episodes(spark, episodes, frames_per_episode).select("episode_idx", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1)).alias("frame_idx"))

    def draw(batches):
        for pdf in batches:
            for e, f in zip(pdf.episode_idx, pdf.frame_idx, strict=True):
                data = np.random.RandomState(1000 * e + f).randint(0, 256, (height, width, 3)).astype(np.uint8).tobytes()
                yield pd.DataFrame({"episode_idx": [e], "frame_idx": [f], "h": [height], "w": [width], "data": [data]})

    return frames.mapInPandas(draw, "episode_idx long, frame_idx long, h int, w int, data binary")
