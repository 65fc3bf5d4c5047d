"""Readers of an episode dataset: meta/episodes, data, meta/subtask, info."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

FRAME_COLUMNS = {"episode_index": "long", "frame_index": "long", "timestamp": "double", "subtask_index": "long"}
SUBTASKS = "subtask_index long, atomic_skill string, subtask string, has_regrasp boolean"


def is_dataset(spark: SparkSession, root: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/meta/episodes")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def read_episodes(spark: SparkSession, root: str) -> DataFrame:
    """All chunks, columns united by name; none is an error."""
    return spark.read.option("mergeSchema", True).parquet(f"{root}/meta/episodes/chunk-*/file-*.parquet")


def _or_empty(read, schema: str, spark: SparkSession) -> DataFrame:
    try:
        return read()
    except AnalysisException:
        return spark.createDataFrame([], schema)


def _typed(rows: DataFrame, columns: dict[str, str]) -> list[Column]:
    have = set(rows.columns)
    return [(F.col(c) if c in have else F.lit(None)).cast(k).alias(c) for c, k in columns.items()]


def read_frames(spark: SparkSession, root: str) -> DataFrame:
    """Frame metadata, the known columns only, with the chunk and file each row
    comes from."""
    schema = ", ".join(f"{c} {k}" for c, k in FRAME_COLUMNS.items()) + ", chunk_index long, file_index long"

    def read() -> DataFrame:
        rows = spark.read.option("mergeSchema", True).parquet(f"{root}/data/chunk-*/file-*.parquet")
        if "frame_index" not in rows.columns:
            return spark.createDataFrame([], schema)
        place = lambda part: F.regexp_extract(F.col("_metadata.file_path"), rf"{part}-(\d+)", 1).cast("long")
        return rows.select(*_typed(rows, FRAME_COLUMNS), place("chunk").alias("chunk_index"), place("/file").alias("file_index"))

    return _or_empty(read, schema, spark)


def frames_of(episodes: DataFrame, frames: DataFrame) -> DataFrame:
    """Metadata of each episode's frames, looked up in the file that its row
    names only; a file without episode_index serves every episode in it."""
    if not {"data/chunk_index", "data/file_index"} <= set(episodes.columns):
        return frames.limit(0).drop("chunk_index", "file_index").withColumnRenamed("frame_index", "frame_idx")
    owners = episodes.select(F.col("episode_index").alias("__e"), F.col("`data/chunk_index`").cast("long").alias("chunk_index"), F.col("`data/file_index`").cast("long").alias("file_index"))
    joined = frames.join(owners, ["chunk_index", "file_index"]).where("episode_index is null or episode_index = __e")
    return joined.select(F.col("__e").alias("episode_index"), F.col("frame_index").alias("frame_idx"), F.nanvl("timestamp", F.lit(None).cast("double")).alias("timestamp"), "subtask_index")


def read_subtasks(spark: SparkSession, root: str) -> DataFrame:
    """The subtask table; missing or unreadable: empty."""
    kinds = dict(x.split() for x in SUBTASKS.split(", "))

    def read() -> DataFrame:
        rows = spark.read.parquet(f"{root}/meta/subtask.parquet")
        return rows.select(*_typed(rows, kinds))

    return _or_empty(read, SUBTASKS, spark)


def read_fps(spark: SparkSession, root: str) -> float | None:
    """fps of info.json; missing, zero or unreadable: None."""
    rows = _or_empty(lambda: spark.read.schema("fps double").option("multiLine", True).json(f"{root}/meta/info.json"), "fps double", spark)
    first = rows.first()
    return (first["fps"] or None) if first else None


def text_of(episodes: DataFrame, name: str) -> Column:
    """A text column, or null if it is missing or holds something else."""
    kind = dict(zip(episodes.schema.names, (f.dataType for f in episodes.schema.fields), strict=True)).get(name)
    return F.col(f"`{name}`") if isinstance(kind, T.StringType) else F.lit(None).cast("string")
