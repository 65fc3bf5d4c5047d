"""The dense frame spine and the joins on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000  # dimensions up to so many rows are broadcast


def checked_broadcast(dimension: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a dimension of at most ``most`` rows; a larger one is joined
    by shuffle."""
    return F.broadcast(dimension) if dimension.limit(most + 1).count() <= most else dimension


def last_of(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The last row of each key in the order given."""
    ranked = Window.partitionBy(*keys).orderBy(*[F.desc(c) if isinstance(c, str) else c.desc() for c in order])
    return rows.withColumn("__rank", F.row_number().over(ranked)).where("__rank = 1").drop("__rank")


def dense_spine(episodes: DataFrame, metadata: DataFrame, keys: list[str], length: str = "length", frame: str = "frame_idx", tiebreak: list | None = None) -> DataFrame:
    """Frames 0 to length - 1 of every episode with their metadata, nulls where
    there are none.  Metadata outside that range is left out; of duplicates the
    last by ``tiebreak`` counts.  Episodes of length 0 have no frames."""
    spine = episodes.where(F.col(length) > 0).withColumn(frame, F.explode(F.sequence(F.lit(0).cast("long"), F.col(length).cast("long") - 1)))
    known = last_of(metadata.where(F.col(frame) >= 0), [*keys, frame], tiebreak or [frame])
    return spine.join(known, [*keys, frame], "left")


def with_dimension(frames: DataFrame, dimension: DataFrame, key: str, tiebreak: list | None = None) -> DataFrame:
    """Left join a dimension; of duplicate keys the last counts."""
    return frames.join(checked_broadcast(last_of(dimension, [key], tiebreak or [key])), key, "left")


def with_subtasks(frames: DataFrame, subtasks: DataFrame) -> DataFrame:
    """Labels of subtask_index; an index without a row keeps its number and has
    empty labels."""
    out = with_dimension(frames, subtasks, "subtask_index")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in ("atomic_skill", "subtask")})


def select_episodes(episodes: DataFrame, wanted: list[int] | None = None, limit: int | None = None, key: str = "episode_index") -> DataFrame:
    """Those wanted, in order, at most ``limit``; none at all is an error."""
    out = episodes if wanted is None else episodes.where(F.col(key).isin(sorted(set(wanted))))
    out = out.orderBy(key)
    out = out if limit is None else out.limit(limit)
    if out.isEmpty():
        raise ValueError("no episodes selected")
    return out


def resolved_text(own: Column, default: str) -> Column:
    """Trimmed text, or the default if null or blank."""
    return F.coalesce(F.nullif(F.trim(F.regexp_replace(own, r"\A[\s ]+|[\s ]+\z", "")), F.lit("")), F.lit(default))


def with_instruction(episodes: DataFrame, side: DataFrame, key: str, side_key: str, side_text: str, default: str, place: str | None = None) -> DataFrame:
    """instruction from a side table; blank texts there don't count, of
    duplicates the last by ``place`` does, or the greatest text without one."""
    usable = side.select(F.col(side_key).alias(key), F.col(side_text).alias("__text"), *([place] if place else [])).where(resolved_text(F.col("__text"), "") != "")
    last = last_of(usable, [key], [place or "__text"]).select(key, "__text")
    joined = episodes.join(checked_broadcast(last), key, "left")
    return joined.withColumn("instruction", resolved_text(F.col("__text"), default)).drop("__text")


def manual_queries(key: Column, table: dict[str, list[str]]) -> Column:
    """The key's list, else the list under "default", else null."""
    pairs = [x for k, v in table.items() for x in (F.lit(str(k)), F.array(*map(F.lit, v)).cast("array<string>"))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key.cast("string")), F.try_element_at(F.create_map(*pairs), F.lit("default")))


def manifest(frames: DataFrame) -> DataFrame:
    """The sampling manifest's columns, missing ones as null or ""."""
    have = set(frames.columns)
    pick = lambda c, kind, default=None: (F.col(c) if c in have else F.lit(None)).cast(kind) if default is None else F.coalesce((F.col(c) if c in have else F.lit(None)).cast(kind), F.lit(default))
    return frames.select("episode_idx", "frame_idx", pick("subtask_index", "long").alias("subtask_index"), pick("atomic_skill", "string", "").alias("atomic_skill"), pick("subtask", "string", "").alias("subtask"), pick("timestamp", "double").alias("timestamp"))


def pending(work: DataFrame, done: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """Rows for which a product is missing, with need_<product> flags: one left
    join per product, before anything is decoded."""
    for product, rows in done.items():
        marks = rows.select(*keys).distinct().withColumn(f"__{product}", F.lit(True))
        work = work.join(marks, keys, "left").withColumn(f"need_{product}", F.col(f"__{product}").isNull()).drop(f"__{product}")
    need = F.lit(False)
    for product in done:
        need = need | F.col(f"need_{product}")
    return work.where(need)


def summary(status: DataFrame) -> DataFrame:
    """Counts of a status table (episode_idx, frame_idx, status)."""
    count = lambda s: F.count(F.when(F.col("status") == s, 1))
    return status.groupBy("episode_idx").agg(count("ok").alias("processed"), count("skipped").alias("skipped"), count("failed").alias("failed"), F.array_sort(F.collect_list(F.when(F.col("status") == "failed", F.col("frame_idx")))).alias("failed_frames"))
