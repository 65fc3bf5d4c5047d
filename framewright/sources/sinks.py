"""Writers.  Products are partitioned by episode; a run's rows are an attempt,
of which a frame's last one counts, and progress is read from what is there."""

from __future__ import annotations

import os
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from framewright.functions import arrays, codecs


def write_product(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("episode_idx").parquet(path)


def read_product(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What is there, or nothing."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def append_attempt(spark: SparkSession, rows: DataFrame, path: str, overwrite: bool = False) -> None:
    """Add a run's rows to a product as its next attempt; ``overwrite`` puts
    them in the place of the episodes' earlier attempts."""
    last = read_product(spark, path, "attempt long").agg(F.max("attempt")).first()[0]
    rows = rows.withColumn("attempt", F.lit((last or 0) + 1).cast("long"))
    if overwrite:
        write_product(rows, path)
    else:
        rows.write.mode("append").partitionBy("episode_idx").parquet(path)


def latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of each frame the rows of its last attempt: a frame that failed and was
    run again counts by the later run alone."""
    last = rows.groupBy(*keys).agg(F.max("attempt").alias("attempt"))
    return rows.join(last, [*keys, "attempt"])


def done_frames(spark: SparkSession, path: str, keys: tuple[str, ...] = ("episode_idx", "frame_idx")) -> DataFrame:
    """Frames with a result, empty ones too, but not those that failed last."""
    kinds = {"episode_idx": "long", "frame_idx": "long", "camera": "string"}
    schema = ", ".join([*(f"{k} {kinds[k]}" for k in keys), "status string", "attempt long"])
    rows = read_product(spark, path, schema).withColumn("episode_idx", F.col("episode_idx").cast("long"))
    return latest(rows, list(keys)).where(F.col("status") != "failed").select(*keys).distinct()


def depth_names(folder: str, camera: Column, episode: Column, frame: Column) -> tuple[Column, Column]:
    """Paths of a depth map's image and of its sidecar."""
    stem = F.format_string("%s/depth/%s/episode_%06d/frame_%06d", F.lit(folder.rstrip("/")), camera, episode, frame)
    return F.concat(stem, F.lit(".png")), F.concat(stem, F.lit(".json"))


def depth_files(depths: DataFrame, folder: str) -> DataFrame:
    """(episode_idx, frame_idx, camera, png_path, json_path, pixels, h, w,
    sidecar): what ``write_depth_files`` writes for the maps that didn't fail."""
    png, side = depth_names(folder, F.col("camera"), F.col("episode_idx"), F.col("frame_idx"))
    metric = F.col("depth_type") == "metric"
    pixels = F.when(metric, arrays.metric_steps(F.col("depth"))).otherwise(arrays.relative_steps(F.col("depth")))
    figures = [F.col(c) for c in ("scale", "original_min", "original_max")]
    sidecar = F.when(metric, arrays.depth_sidecar("metric", *figures)).otherwise(arrays.depth_sidecar("relative", *figures))
    rows = depths.where("status = 'ok'")
    return rows.select("episode_idx", "frame_idx", "camera", png.alias("png_path"), side.alias("json_path"), pixels.alias("pixels"), "h", "w", sidecar.alias("sidecar"))


def write_depth_files(depths: DataFrame, folder: str) -> int:
    """Write 16-bit images and JSON sidecars; returns their number.  The image
    goes first and both appear whole, so a frame that has its sidecar is done."""

    def write(batches):
        from pyarrow import fs

        for batch in batches:
            for row in batch.to_pylist():
                for path, data in ((row["png_path"], codecs.png16(row["pixels"], row["w"], row["h"])), (row["json_path"], row["sidecar"].encode())):
                    system, at = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), os.path.abspath(path))
                    system.create_dir(os.path.dirname(at), recursive=True)
                    part = f"{at}.{uuid.uuid4().hex}"
                    with system.open_output_stream(part) as out:
                        out.write(data)
                    system.move(part, at)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    return depth_files(depths, folder).mapInArrow(write, "n long").agg(F.sum("n")).first()[0] or 0


def valid_depth_files(spark: SparkSession, folder: str) -> DataFrame:
    """(camera, episode_idx, frame_idx) of the depth maps that are there whole:
    an image that begins as one, and a sidecar with its keys."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{folder.rstrip('/')}/depth")
    except AnalysisException:
        return spark.createDataFrame([], "camera string, episode_idx long, frame_idx long")
    pattern = r"/depth/(.+)/episode_(\d+)/frame_(\d+)\.(png|json)$"
    part = lambda i: F.regexp_extract("path", pattern, i)
    sidecar = F.from_json(F.decode("content", "UTF-8"), "depth_type string, scale double, encoding string")
    whole = F.when(part(4) == "png", F.hex(F.substring("content", 1, 8)) == "89504E470D0A1A0A").otherwise(sidecar["depth_type"].isNotNull() & sidecar["scale"].isNotNull() & sidecar["encoding"].isNotNull())
    rows = files.where(part(4) != "").select(part(1).alias("camera"), part(2).cast("long").alias("episode_idx"), part(3).cast("long").alias("frame_idx"), part(4).alias("kind"), whole.alias("whole"))
    both = rows.where("whole").groupBy("camera", "episode_idx", "frame_idx").agg(F.count_distinct("kind").alias("n"))
    return both.where("n = 2").drop("n")


def write_manifest(rows: DataFrame, path: str) -> None:
    """The frames of this run alone."""
    rows.write.mode("overwrite").partitionBy("episode_idx").parquet(path)


def write_jsonl(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)
