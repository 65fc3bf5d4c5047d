"""The annotation run: select, sample, discover, then masks and depth for the
frames that lack them.  One declarative job per product.

    python -m framewright.plans.annotate config.yaml [--stage S] [--dry-run]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright import ship_to_workers
from framewright.config import PipelineConfig, load_config
from framewright.functions import discovery
from framewright.operators import frames as ops
from framewright.operators import models, qc, sampling
from framewright.sources import dataset, mock, sinks


def instructed(spark: SparkSession, episodes: DataFrame, config: PipelineConfig) -> DataFrame:
    d = config.discovery
    if d.instruction_source == "join_file":
        if not d.instruction_join_path:
            raise ValueError("discovery.instruction_join_path is missing")
        path = str(d.instruction_join_path)
        side = spark.read.parquet(path if path.startswith("/") or "://" in path else f"{config.dataset_path}/{path}")
        side = side.select(d.instruction_join_file_key, d.instruction_join_text_field, F.struct("_metadata.file_path", "_metadata.row_index").alias("__place"))
        return ops.with_instruction(episodes, side, d.instruction_join_episode_key, d.instruction_join_file_key, d.instruction_join_text_field, d.default_instruction, place="__place")
    own = dataset.text_of(episodes, d.instruction_field) if d.instruction_source == "episode_field" else F.lit(None).cast("string")
    return episodes.withColumn("instruction", ops.resolved_text(own, d.default_instruction))


def chat_client(config: PipelineConfig) -> models.ChatClient:
    d = config.discovery
    return models.ChatClient(d.qwen_endpoint, d.qwen_model, PROMPT, timeout=d.qwen_timeout, token=d.qwen_api_key, max_tokens=d.qwen_max_tokens, temperature=d.qwen_temperature)


PROMPT = "Name the physical objects in this instruction for a robot as a JSON array of short noun phrases, and nothing else."


def discovered(episodes: DataFrame, config: PipelineConfig, client=None, key: str = "episode_idx") -> DataFrame:
    """queries, status and error of each episode."""
    d = config.discovery
    if d.extractor == "manual":
        found = ops.manual_queries(F.col(key), d.manual_queries)
        out = episodes.withColumn("queries", discovery.finished(found, d.always_include))
        return out.withColumn("status", F.when(F.col("queries").isNull(), "failed").otherwise("ok")).withColumn("error", F.when(F.col("queries").isNull(), "no manual queries"))
    if d.extractor == "qwen":
        said = models.answers(episodes, client or chat_client(config))
        joined = episodes.withColumn("key", F.trim(F.regexp_replace("instruction", r"(?U)\s+", " "))).join(said, "key", "left")
        labels = F.coalesce(discovery.response_labels(F.col("answer")), F.array().cast("array<string>"))
        return joined.withColumn("queries", discovery.finished(labels, d.always_include)).withColumn("status", F.lit("ok")).drop("key", "answer")
    found = discovery.extractor(d.extractor)(F.col("instruction"), d.always_include)
    return episodes.withColumn("queries", found).withColumn("status", F.lit("ok")).withColumn("error", F.lit(None).cast("string"))


def is_mock(spark: SparkSession, config: PipelineConfig) -> bool:
    """Whether the run is about the mock dataset: asked for, or no dataset
    named.  A path without a dataset is an error, not a reason to make one up."""
    if config.dataset_type == "mock" or not config.dataset_path:
        return True
    if not dataset.is_dataset(spark, config.dataset_path):
        raise ValueError(f"no dataset at {config.dataset_path}; dataset_type: mock runs without one")
    return False


def planned(spark: SparkSession, config: PipelineConfig, client=None) -> tuple[DataFrame, DataFrame]:
    """(episodes with queries, sampled frames with metadata).  An episode that
    can't be sampled has its reason as status."""
    if is_mock(spark, config):
        episodes = ops.select_episodes(mock.mock_episodes(spark), config.episode_indices, config.max_episodes, "episode_idx")
        frames = episodes.select("episode_idx", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1)).alias("frame_idx"))
        if config.sampling.mode == "uniform":
            frames = sampling.sample(frames, config.sampling)
        return discovered(episodes, config, client), frames
    root = config.dataset_path
    episodes = ops.select_episodes(dataset.read_episodes(spark, root), config.episode_indices, config.max_episodes)
    known = dataset.frames_of(episodes, dataset.read_frames(spark, root))
    frames = ops.dense_spine(episodes.select("episode_index", "length"), known, ["episode_index"], tiebreak=["frame_idx", "timestamp"])
    frames = ops.with_subtasks(frames.withColumnRenamed("episode_index", "episode_idx"), dataset.read_subtasks(spark, root))
    config.sampling.fps = config.sampling.fps or dataset.read_fps(spark, root)
    found = discovered(instructed(spark, episodes, config).withColumnRenamed("episode_index", "episode_idx"), config, client)
    if config.sampling.mode == "subtask_aware" and config.sampling.frame_indices is None:
        bad = sampling.with_status(frames, config.sampling, label="subtask_index").where("status <> 'ok'").select("episode_idx", F.col("status").alias("__bad")).distinct()
        found = found.join(bad, "episode_idx", "left").withColumn("status", F.coalesce("__bad", "status")).drop("__bad")
    return found, sampling.sample(frames, config.sampling, label="subtask_index")


def run(spark: SparkSession, config: PipelineConfig, pixels=None, segmenter=None, depth=None, client=None, use_mock: bool = False) -> DataFrame:
    """Write the products; returns the summary per episode, failed episodes
    with their status and without frames.  ``pixels`` maps (episode_idx,
    frame_idx, camera) rows to frames with h, w and data.  A real dataset needs
    it, and the models of the stages that run; ``use_mock`` lets mock models
    stand in for those."""
    ship_to_workers(spark)
    made_up = is_mock(spark, config)
    wanted = {"segmentation": ["masks"], "depth": ["depth"], "both": ["masks", "depth"]}[config.stage]
    if not config.dry_run and not made_up:
        if pixels is None:
            raise ValueError("a real dataset needs a reader of its pixels")
        if not use_mock and (("masks" in wanted and segmenter is None) or ("depth" in wanted and depth is None)):
            raise ValueError("a real dataset needs models; use_mock lets mocks stand in")
    episodes, frames = planned(spark, config, client)
    sinks.write_manifest(ops.manifest(frames), f"{config.storage.output_dir}/manifest")
    if config.dry_run:
        out = episodes.select("episode_idx", "instruction", "queries", "status")
        sinks.write_jsonl(out, f"{config.storage.output_dir}/dry_run")
        return out
    good = episodes.where("status = 'ok'").select("episode_idx", "queries")
    source = pixels or (lambda w: w.join(mock.mock_frames(spark), ["episode_idx", "frame_idx"]))
    cameras = F.explode(F.array(*map(F.lit, config.camera_names or [""]))).alias("camera")
    work = frames.select("episode_idx", "frame_idx").join(good.select("episode_idx"), "episode_idx", "left_semi")
    overwrite, status = config.storage.overwrite, None
    for product in wanted:
        path = table_path(config, product)
        keys = ["episode_idx", "frame_idx"] + ["camera"] * (product == "depth")
        todo = work if product == "masks" else work.select("episode_idx", "frame_idx", cameras)
        if not overwrite:
            todo = todo.join(sinks.done_frames(spark, path, tuple(keys)), keys, "left_anti")
        if product == "masks":
            first = F.lit((config.camera_names or [""])[0]).alias("camera")
            limits = config.segmentation.confidence_threshold, config.segmentation.max_instances_per_query
            rows = models.masks(source(todo.select("*", first)).join(good, "episode_idx"), segmenter or models.MockSegmenter(), *limits)
        else:
            rows = models.depths(source(todo), depth or models.MockDepth(config.depth.output_metric))
        sinks.append_attempt(spark, rows, path, overwrite)
        schema = f"{models.MASKS if product == 'masks' else models.DEPTHS}, attempt long"
        now = sinks.latest(sinks.read_product(spark, path, schema).withColumn("episode_idx", F.col("episode_idx").cast("long")), keys)
        if product == "depth":
            sinks.write_depth_files(now.join(todo, keys, "left_semi"), config.folder("depth"))
        part = now.select("episode_idx", "frame_idx", F.when(F.col("status") == "failed", 1).otherwise(0).alias("bad"))
        status = part if status is None else status.union(part)
    frame = status.groupBy("episode_idx", "frame_idx").agg(F.when(F.max("bad") == 1, "failed").otherwise("ok").alias("status"))
    failed = episodes.where("status <> 'ok'").select("episode_idx", F.col("status").alias("episode_status"))
    counted = ops.summary(frame).join(failed, "episode_idx", "full")
    return counted.fillna(0, ["processed", "skipped", "failed"]).withColumn("episode_status", F.coalesce("episode_status", F.lit("ok")))


def table_path(config: PipelineConfig, product: str) -> str:
    return f"{config.folder(product)}/{'masks' if product == 'masks' else 'depth_maps'}"


def quality_frames(spark: SparkSession, config: PipelineConfig, n: int = 5) -> DataFrame:
    keys = "episode_idx long, frame_idx long"
    frames = sinks.read_product(spark, f"{config.storage.output_dir}/manifest", keys)
    return qc.qc_rows(frames, *(sinks.read_product(spark, table_path(config, p), keys) for p in ("masks", "depth")), n)


def main() -> int:
    args = argparse.ArgumentParser()
    args.add_argument("config")
    args.add_argument("--stage", choices=["segmentation", "depth", "both"])
    args.add_argument("--dry-run", action="store_true")
    args.add_argument("--use-mock", action="store_true", help="run on the mock dataset with mock models")
    given = args.parse_args()
    config = load_config(given.config)
    config.stage, config.dry_run = given.stage or config.stage, given.dry_run or config.dry_run
    if given.use_mock:
        config.dataset_type, config.discovery.extractor = "mock", "mock"
    result = run(SparkSession.builder.appName("annotate").getOrCreate(), config)
    result.show(50, truncate=False)
    failed = "status <> 'ok'" if "status" in result.columns else "failed > 0 or episode_status <> 'ok'"
    return int(not result.where(failed).isEmpty())


if __name__ == "__main__":
    raise SystemExit(main())
