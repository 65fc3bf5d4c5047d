"""Model operators.  A backend is loaded once per task; a frame that fails
comes out with a status and an error, never as an exception."""

from __future__ import annotations

import hashlib
import json
import re
import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.functions.codecs import pack_runs


class Segmenter(Protocol):
    def segment(self, frame: np.ndarray, queries: list[str]) -> Iterator[tuple[str, np.ndarray, float]]:
        """(category, mask, score) of each instance, best first per query."""


class DepthEstimator(Protocol):
    metric: bool

    def estimate(self, frame: np.ndarray) -> np.ndarray:
        """Depth map of the frame's size."""


class MockSegmenter:
    """Bars and squares on a grid of GRID x GRID cells, their number, place and
    score read from a digest of the query."""

    GRID = 8

    def segment(self, frame, queries):
        h, w = frame.shape[:2]
        rows, columns = np.arange(h) * self.GRID // h, np.arange(w) * self.GRID // w
        for query in queries:
            digest = hashlib.sha256(query.encode()).digest()
            scores = sorted((0.5 + b / 512 for b in digest[: 1 + digest[31] % 3]), reverse=True)
            for i, score in enumerate(scores):
                top, left, tall, wide = (b % self.GRID for b in digest[4 + 4 * i : 8 + 4 * i])
                mask = ((rows >= top) & (rows <= top + tall % 3))[:, None] & ((columns >= left) & (columns <= left + wide % 3))[None, :]
                yield query, mask, score


class MockDepth:
    """A floor that comes nearer from top to bottom (4 m to 1 m), with the
    frame's brightness as relief of up to 0.1 m."""

    def __init__(self, metric: bool = True):
        self.metric = metric

    def estimate(self, frame):
        floor = np.linspace(4.0, 1.0, frame.shape[0])[:, None]
        depth = (floor - frame.mean(2) / 2550).astype(np.float32)
        return depth if self.metric else (depth - depth.min()) / max(float(np.ptp(depth)), 1e-8)


MASKS = "episode_idx long, frame_idx long, instance_id int, category string, rle_counts string, rle_size array<long>, area long, bbox array<long>, score double, status string, error string"


def encoded_mask(mask: np.ndarray) -> tuple[str, list[int], int, list[int]]:
    """Run-length string, size, area and box."""
    flat = mask.ravel(order="F")
    edges = np.flatnonzero(flat[1:] != flat[:-1]) + 1
    runs = np.diff(np.concatenate([[0], edges, [flat.size]]))
    counts = [0, *runs] if flat.size and flat[0] else list(runs)
    ys, xs = np.flatnonzero(mask.any(1)), np.flatnonzero(mask.any(0))
    box = [int(xs[0]), int(ys[0]), int(xs[-1] - xs[0] + 1), int(ys[-1] - ys[0] + 1)] if len(ys) else [0, 0, 0, 0]
    return pack_runs(counts), list(mask.shape), int(mask.sum()), box


def _each_query(backend: Segmenter, image: np.ndarray, queries: list[str], wrong: list[str]) -> list:
    try:
        return list(backend.segment(image, queries))
    except Exception:  # noqa: BLE001  which query it was shows below
        found = []
        for query in queries:
            try:
                found += backend.segment(image, [query])
            except Exception as error:  # noqa: BLE001
                wrong.append(f"{query}: {error!r}")
        return found


def masks(frames: DataFrame, backend: Segmenter, min_score: float = 0.0, max_instances: int | None = None) -> DataFrame:
    """One row per instance of frames (h, w, data, queries): a frame's queries
    go to the backend together, and one by one if that fails, so that a query's
    failure, named in ``error``, costs that query alone.  A frame without
    instances gives one row of status ``empty``, one of whose queries all fail
    one of status ``failed``."""

    def run(batches):
        for pdf in batches:
            out = []
            for row in pdf.itertuples():
                keys = (row.episode_idx, row.frame_idx)
                try:
                    image, kept = np.frombuffer(row.data, np.uint8).reshape(row.h, row.w, 3), {}
                    found = []
                    wrong = []
                    for category, mask, score in _each_query(backend, image, list(row.queries), wrong):
                        kept[category] = kept.get(category, 0) + (score >= min_score)
                        if score >= min_score and (max_instances is None or kept[category] <= max_instances):
                            found.append((category, *encoded_mask(mask), score, "ok", None))
                    if wrong and len(wrong) == len(row.queries):
                        raise RuntimeError("; ".join(wrong))
                    said = "; ".join(wrong) or None
                    out += [(*keys, i, *x[:-1], said) for i, x in enumerate(found)] or [(*keys, None, None, None, None, None, None, None, "empty", said)]
                except Exception as error:  # noqa: BLE001  a frame's failure is data
                    out.append((*keys, None, None, None, None, None, None, None, "failed", repr(error)))
            table = pd.DataFrame(out, columns=[c.split()[0] for c in MASKS.split(", ")])
            yield table.astype({"instance_id": "Int32", "area": "Int64"})

    return frames.select("episode_idx", "frame_idx", "h", "w", "data", "queries").mapInPandas(run, MASKS)


DEPTHS = "episode_idx long, frame_idx long, camera string, h int, w int, depth array<float>, depth_type string, scale double, original_min double, original_max double, status string, error string"


def depths(frames: DataFrame, backend: DepthEstimator) -> DataFrame:
    """One row per frame and camera ("" where frames have none).  A map of
    zeros alone means that weights are missing and counts as failed."""
    if "camera" not in frames.columns:
        frames = frames.withColumn("camera", F.lit(""))

    def run(batches):
        for pdf in batches:
            out = []
            for row in pdf.itertuples():
                keys = (row.episode_idx, row.frame_idx, row.camera, row.h, row.w)
                try:
                    depth = backend.estimate(np.frombuffer(row.data, np.uint8).reshape(row.h, row.w, 3))
                    if not depth.any():
                        raise ValueError("the depth map is all zeros")
                    out.append((*keys, depth.ravel(), "metric" if backend.metric else "relative", 1.0, float(depth.min()), float(depth.max()), "ok", None))
                except Exception as error:  # noqa: BLE001
                    out.append((*keys, None, None, None, None, None, "failed", repr(error)))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in DEPTHS.split(", ")])

    return frames.select("episode_idx", "frame_idx", "camera", "h", "w", "data").mapInPandas(run, DEPTHS)


class ChatClient:
    """Chat-completion calls; only connection errors and timeouts are retried."""

    def __init__(self, url: str, model: str, prompt: str, timeout: float = 30, attempts: int = 2, wait: float = 1, token: str | None = None, max_tokens: int = 256, temperature: float = 0):
        self.url, self.model, self.prompt, self.timeout, self.attempts, self.wait, self.token, self.max_tokens, self.temperature = url, model, prompt, timeout, attempts, wait, token, max_tokens, temperature

    def ask(self, text: str) -> str:
        body = {"model": self.model, "messages": [{"role": "system", "content": self.prompt}, {"role": "user", "content": text}], "temperature": self.temperature, "max_tokens": self.max_tokens}
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.token}"} if self.token else {})
        for attempt in range(self.attempts):
            try:
                request = urllib.request.Request(self.url, json.dumps(body).encode(), headers)
                with urllib.request.urlopen(request, timeout=self.timeout) as reply:
                    choice = json.load(reply)["choices"][0]
                answer = choice.get("message", {}).get("content") or choice.get("text")
                if not (answer or "").strip():
                    raise ValueError("empty answer")
                return answer
            except urllib.error.HTTPError:
                raise
            except (urllib.error.URLError, TimeoutError, ConnectionError):
                if attempt + 1 == self.attempts:
                    raise
                time.sleep(self.wait)
        raise RuntimeError("no attempt was made")


def answers(instructions: DataFrame, client, text: str = "instruction") -> DataFrame:
    """(key, answer, error): one request per distinct text, white space
    collapsed; join it back on key = collapsed text."""

    def run(batches):
        for pdf in batches:
            out = []
            for key in pdf.key:
                try:
                    out.append((key, client.ask(key), None))
                except Exception as error:  # noqa: BLE001
                    out.append((key, None, repr(error)))
            yield pd.DataFrame(out, columns=["key", "answer", "error"])

    key = F.trim(F.regexp_replace(text, r"(?U)\s+", " "))
    return instructions.select(key.alias("key")).where("key is not null").distinct().mapInPandas(run, "key string, answer string, error string")
