"""Frame selection: runs of a subtask, strides, uniform spacing, explicit lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_runs(frames: DataFrame, episode: str = "episode_idx", frame: str = "frame_idx", label: str = "subtask") -> DataFrame:
    """Add segment (from 0), start_frame and end_frame of each run of equal
    labels; a label that comes back begins another run.  One shuffle by
    episode serves all windows."""
    order = Window.partitionBy(episode).orderBy(frame)
    change = F.coalesce((~F.col(label).eqNullSafe(F.lag(label).over(order))) & (F.row_number().over(order) > 1), F.lit(False))
    run = Window.partitionBy(episode, "segment")
    return (
        frames.withColumn("__change", change.cast("long"))
        .withColumn("segment", F.sum("__change").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .drop("__change")
        .withColumn("start_frame", F.min(frame).over(run))
        .withColumn("end_frame", F.max(frame).over(run))
    )


def segments(frames: DataFrame, episode: str = "episode_idx", frame: str = "frame_idx", label: str = "subtask") -> DataFrame:
    runs = with_runs(frames, episode, frame, label)
    return runs.groupBy(episode, "segment").agg(F.first(label).alias(label), F.min(frame).alias("start_frame"), F.max(frame).alias("end_frame"), F.count("*").alias("n_frames"))


def on_stride(frame: Column, start: Column, end: Column, stride: int | Column, keep_boundaries: bool = True) -> Column:
    hit = (frame - start) % stride == 0
    return hit | (frame == end) if keep_boundaries else hit


def subtask_aware(frames: DataFrame, stride: int | Column, keep_boundaries: bool = True, episode: str = "episode_idx", frame: str = "frame_idx", label: str = "subtask") -> DataFrame:
    """Frames at multiples of the stride from their run's start and, if asked,
    each run's last.  An episode with an unlabelled frame has none: its frames
    come out with status ``missing_subtask`` and selected false."""
    if isinstance(stride, int) and stride < 1:
        raise ValueError("the stride must be 1 or more")
    runs = with_runs(frames, episode, frame, label)
    bad = F.max(F.col(label).isNull().cast("int")).over(Window.partitionBy(episode)) == 1
    picked = on_stride(F.col(frame), F.col("start_frame"), F.col("end_frame"), stride, keep_boundaries)
    return runs.withColumn("status", F.when(bad, "missing_subtask").otherwise("ok")).withColumn("selected", ~bad & picked)


def uniform_indices(length: Column, n: int) -> Column:
    """Distinct floors of n evenly spaced numbers from 0 to length - 1; null if
    either is 0."""
    if n < 0:
        raise ValueError("the number of frames must not be negative")
    count = F.least(F.lit(n), length).cast("int")
    step = (length - 1) / F.greatest(count - 1, F.lit(1)).cast("double")
    spaced = F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda i: F.when((i == count - 1) & (count > 1), length - 1).otherwise(F.floor(i * step)).cast("long"))
    return F.when((length > 0) & F.lit(n > 0), F.array_distinct(spaced))


def uniform(frames: DataFrame, n: int, episode: str = "episode_idx", frame: str = "frame_idx") -> DataFrame:
    lengths = frames.groupBy(episode).agg((F.max(frame) + 1).alias("length"))
    return lengths.select(episode, F.explode(uniform_indices(F.col("length"), n)).alias(frame))


def explicit(lengths: DataFrame, wanted: list[int], episode: str = "episode_idx", length: str = "length", frame: str = "frame_idx") -> DataFrame:
    """The wanted frames that each episode has, sorted and distinct."""
    every = F.lit(sorted(set(wanted))).cast("array<long>") if wanted else F.array().cast("array<long>")
    return lengths.select(episode, F.explode(F.filter(every, lambda i: (i >= 0) & (i < F.col(length)))).alias(frame))


def first_n(frames: DataFrame, n: int, frame: str = "frame_idx") -> DataFrame:
    return frames.where((F.col(frame) >= 0) & (F.col(frame) < n))


def frame_rate(frames: DataFrame, episode: str = "episode_idx", frame: str = "frame_idx", timestamp: str = "timestamp") -> DataFrame:
    """1 / median of the positive steps between timestamps; null without any."""
    step = F.col(timestamp) - F.lag(timestamp).over(Window.partitionBy(episode).orderBy(frame))
    steps = frames.select(episode, step.alias("__step"))
    return steps.groupBy(episode).agg((F.lit(1.0) / F.percentile(F.when(F.col("__step") > 0, F.col("__step")), F.lit(0.5))).alias("fps"))


def stride_of(seconds: float, fps: Column) -> Column:
    """Frames in so many seconds, rounded half to even; null below 1."""
    frames = F.rint(F.lit(float(seconds)) * fps).cast("long")
    return F.when(frames >= 1, frames)


def sample(frames: DataFrame, sampling, episode: str = "episode_idx", frame: str = "frame_idx", label: str = "subtask") -> DataFrame:
    """By precedence: explicit list, subtask-aware, uniform, first n, all."""
    lengths = frames.groupBy(episode).agg((F.max(frame) + 1).alias("length"))
    keys = [episode, frame]
    if sampling.frame_indices is not None:
        return frames.join(explicit(lengths, sampling.frame_indices, episode, "length", frame), keys, "left_semi")
    if sampling.mode == "subtask_aware":
        return with_status(frames, sampling, episode, frame, label).where("selected").select(*frames.columns)
    if (n := sampling.uniform_count()) is not None:
        return frames.join(uniform(frames, n, episode, frame), keys, "left_semi")
    if sampling.max_frames_per_episode is not None:
        return first_n(frames, sampling.max_frames_per_episode, frame)
    return frames


def with_status(frames: DataFrame, sampling, episode: str = "episode_idx", frame: str = "frame_idx", label: str = "subtask") -> DataFrame:
    """The frames with selected and status for subtask-aware sampling.  Without
    a frame rate for a stride in seconds each episode's own is taken from its
    timestamps; an episode without one has status ``missing_fps``, and none
    of its frames is selected."""
    stride, kept = sampling.stride(), frames.columns
    if stride is None:
        rates = frame_rate(frames, episode, frame).select(episode, stride_of(sampling.stride_seconds, F.col("fps")).alias("__stride"))
        frames = frames.join(rates, episode, "left")
        stride = F.coalesce("__stride", F.lit(1))
    out = subtask_aware(frames, stride, sampling.keep_subtask_boundaries, episode, frame, label)
    if "__stride" in frames.columns:
        lost = F.col("__stride").isNull() & (F.col("status") == "ok")
        out = out.withColumn("selected", F.col("selected") & ~lost).withColumn("status", F.when(lost, "missing_fps").otherwise(F.col("status")))
    return out.select(*kept, "status", "selected")
