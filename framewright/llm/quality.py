"""Quality classifier by co-training two views of a document.

The text view sees hashed words, word beginnings and trailing marks, and some
shares of characters; the metadata view sees language, source and length.  Per
target (low quality, toxic) each view is a logistic regression.  In every round
each view labels the unlabelled documents it is most sure of, for the other
view to train on.  Then each view is calibrated on labelled documents that it
wasn't trained on, and a logistic combination of the two, fitted on others
again, scores all documents.

What is trained on is bounded: LABELLED labelled documents, and MOST_NEW more
pseudo-labelled ones of a class and view in every round.  These are the surest
of a pool that grows with the input, one document in POOL_PART, and that each
round scores in full.  Scoring reads every document once, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewright.llm._shared import forget, stored, tidy
from framewright.llm._text import LOWER as _LOWER
from framewright.llm._text import mix, words_of

LABELLED = 8_000
POOL = 4_000  # unlabelled documents, at least
POOL_PART = 8  # one in so many of a larger input
BITS = 18
ROUNDS = 3
CONFIDENT = 0.98
MOST_NEW = 500  # pseudo-labels of a class, view and round
FEATURES = 4000  # of the text view, per target
Z = 4.0  # least z-score of a feature's difference between the classes
META = 256

_MARK = np.ones(256, bool)
_MARK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def text_view(words, only: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket) of the distinct hashed features of some documents, and
    their dense features (rows, 6).  ``only`` marks the buckets wanted."""
    raw, rows = words.data, words.high - words.low
    end = words.end.copy()
    for _ in range(3):
        cut = (end - 1 > words.start) & _MARK[raw[np.maximum(end - 1, 0)]]
        end[cut] -= 1
    lead, tail = np.zeros(len(end), np.uint64), np.zeros(len(end), np.uint64)
    last = max(len(raw) - 1, 0)
    for i in range(5 if len(raw) else 0):
        c = np.where(words.start + i < end, _LOWER[raw[np.minimum(words.start + i, last)]], 0)
        lead = lead * np.uint64(257) + c.astype(np.uint64) + np.uint64(1)
    for i in range(3 if len(raw) else 0):
        c = np.where(end + i < words.end, raw[np.minimum(end + i, last)], 0)
        tail = tail * np.uint64(257) + c.astype(np.uint64)
    whole = words.span_hash(words.start, end)
    mask, shift = np.uint64((1 << BITS) - 1), np.uint64(BITS)
    row, parts = words.row.astype(np.uint64), []
    for k, x in ((1, whole), (2, lead), (3, tail)):
        bucket = mix(x, np.full(len(x), k, np.uint64)) & mask
        some = slice(None) if only is None else np.flatnonzero(only[bucket])
        parts.append((row[some] << shift) | bucket[some])
    found = np.unique(np.concatenate(parts))
    dense = np.zeros((rows, 6))
    n = np.diff(words.first)
    if len(raw):
        at = np.append(words.start, len(raw))[words.first[:-1]]
        mass = lambda flags: np.add.reduceat(np.append(flags, False).astype(np.float64), at) * (n > 0)
        solid = np.maximum(mass(~_SPACE[raw]), 1)
        dense[:, 0] = mass(_UPPER[raw]) / solid
        dense[:, 1] = mass(_MARK[raw] & ~_SPACE[raw]) / solid
        dense[:, 2] = mass((raw >= 48) & (raw < 58)) / solid
        dense[:, 3] = solid / np.maximum(n, 1) / 10
    dense[:, 4] = np.log1p(n) / 10
    dense[:, 5] = n == 0
    return (found >> shift).astype(np.int64), (found & mask).astype(np.int64), dense


def meta_view(batch: dict[str, list]) -> np.ndarray:
    """Buckets (rows, 3) of a page's metadata: language, source, length."""
    import zlib

    out = []
    for lang, source, size in zip(batch["lang"], batch["source"], batch["n_chars"], strict=True):
        names = f"l{lang}", f"s{source}", f"n{int(np.log2(max(size or 0, 0) + 1))}"
        out.append([zlib.crc32(x.encode()) % META for x in names])
    return np.array(out, np.int64).reshape(-1, 3)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Linear:
    """Weights over hashed buckets, dense features and a bias."""

    buckets: np.ndarray
    dense: np.ndarray
    bias: float

    def score(self, row: np.ndarray, bucket: np.ndarray, dense: np.ndarray) -> np.ndarray:
        return np.bincount(row, self.buckets[bucket], len(dense)) + dense @ self.dense + self.bias


def fit(row: np.ndarray, bucket: np.ndarray, dense: np.ndarray, y: np.ndarray, size: int, z: float = Z, most: int = FEATURES, steps: int = 150) -> Linear:
    """Logistic regression on the buckets whose rates differ between classes."""
    n1, n0 = max(y.sum(), 1), max((1 - y).sum(), 1)
    c1, c0 = np.bincount(bucket, y[row], size), np.bincount(bucket, 1 - y[row], size)
    p = (c1 + c0) / len(y)
    gap = np.abs(c1 / n1 - c0 / n0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0) + 1e-9)
    chosen = np.flatnonzero((gap >= z) & (c1 + c0 >= 5))
    chosen = chosen[np.argsort(-gap[chosen], kind="stable")[:most]]
    place = np.full(size, -1)
    place[chosen] = np.arange(len(chosen))
    at = place.astype(np.int32)[bucket]
    on = at >= 0
    row, at = row[on], at[on]
    w, d, b = np.zeros(len(chosen)), np.zeros(dense.shape[1]), np.log(n1 / n0)
    square = [np.zeros_like(w), np.zeros_like(d), 0.0]
    for _ in range(steps):
        e = sigmoid(np.bincount(row, w[at], len(y)) + dense @ d + b) - y
        g = [np.bincount(at, e[row], len(w)) + 0.05 * w, dense.T @ e + 0.05 * d, e.sum()]
        square = [s + x * x for s, x in zip(square, g, strict=True)]
        w, d, b = (x - 0.3 * v / np.sqrt(s + 1e-8) for x, v, s in zip((w, d, b), g, square, strict=True))
    weights = np.zeros(size)
    weights[chosen] = w
    return Linear(weights, d, float(b))


def calibrated(logits: np.ndarray, y: np.ndarray, steps: int = 400) -> np.ndarray:
    """Coefficients (columns + 1) of a logistic map from some logits."""
    x = np.column_stack([np.clip(logits, -12, 12) / 4, np.ones(len(y))])
    w, square = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for _ in range(steps):
        g = x.T @ (sigmoid(x @ w) - y) + 0.01 * w
        square += g * g
        w -= 0.5 * g / np.sqrt(square + 1e-8)
    return w / np.append(np.full(len(w) - 1, 4.0), 1.0)


def _mapped(logits: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.clip(logits, -12, 12) @ w[:-1] + w[-1]


@dataclass
class Judge:
    """The two views of a target, the calibration of each, and their mix."""

    text: Linear
    page: Linear
    own: tuple[np.ndarray, np.ndarray]
    mix: np.ndarray

    def views(self, row, bucket, dense, meta) -> np.ndarray:
        m_row = np.repeat(np.arange(len(meta)), meta.shape[1])
        raw = self.text.score(row, bucket, dense), self.page.score(m_row, meta.ravel(), np.zeros((len(meta), 0)))
        return np.column_stack([_mapped(x[:, None], w) for x, w in zip(raw, self.own, strict=True)])


@dataclass
class Model:
    judges: dict[str, Judge]

    def probabilities(self, row, bucket, dense, meta) -> dict[str, np.ndarray]:
        return {target: sigmoid(_mapped(j.views(row, bucket, dense, meta), j.mix)) for target, j in self.judges.items()}


class _Rows:
    """Features of sampled documents (columns f, d, m of an Arrow table)."""

    def __init__(self, table: pa.Table):
        self.n = table.num_rows
        blobs = table.column("f").to_pylist()
        self.row = np.repeat(np.arange(self.n, dtype=np.int32), [len(b) // 4 for b in blobs])
        self.bucket = np.frombuffer(b"".join(blobs), "<i4")
        self.dense = np.array(table.column("d").to_pylist(), float).reshape(-1, 6)
        self.meta = np.array(table.column("m").to_pylist(), np.int64).reshape(-1, 3)

    def view(self, v: int):
        if v == 0:
            return self.row, self.bucket, self.dense
        return np.repeat(np.arange(self.n), 3), self.meta.ravel(), np.zeros((self.n, 0))


def _both(y: np.ndarray) -> bool:
    """Whether there are documents of either class to calibrate on."""
    return 0 < y.sum() < len(y)


def _in_ratio(y: np.ndarray, share: float) -> np.ndarray:
    """As many of either class, the surest first, as keeps their ratio."""
    ones, rest = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    n = min(len(ones) / max(share, 1e-9), len(rest) / max(1 - share, 1e-9))
    return np.concatenate([ones[: int(n * share)], rest[: int(n * (1 - share))]])


def _trained(v: int, known: pa.Table, y: np.ndarray) -> Linear:
    return fit(*_Rows(known).view(v), y, (1 << BITS, META)[v], 0.0 if v else Z)


def cotrained(labelled: pa.Table, surest: Callable, targets: tuple[str, ...]) -> Model:
    """labelled: f, d, m and the targets.  ``surest`` gives, for models of
    (target, view), their calibrations and a number, of the pool the documents
    that each is surest of, the surest first, as f, d, m, target, view and y.
    A view is sure of what is CONFIDENT after calibration, so one that can't
    tell the classes apart teaches nothing."""
    i = np.arange(labelled.num_rows)
    train, first, second = (labelled.filter(pa.array(x)) for x in (i % 5 < 3, i % 5 == 3, i % 5 == 4))
    truth = {t: [x.column(t).to_numpy().astype(float) for x in (train, first, second)] for t in targets}
    features = train.select(["f", "d", "m"])
    a, b = _Rows(first), _Rows(second)
    models = {(t, v): _trained(v, features, truth[t][0]) for t in targets for v in (0, 1)}
    own = {(t, v): calibrated(models[t, v].score(*a.view(v))[:, None], truth[t][1]) if _both(truth[t][1]) else np.array([1.0, 0.0]) for t, v in models}
    for k in range(ROUNDS):
        found = surest(models, own, MOST_NEW * (k + 1))
        for t in targets:
            for v in (0, 1):  # learns from what the other view is sure of
                new = found.filter(pa.compute.and_(pa.compute.equal(found.column("target"), t), pa.compute.equal(found.column("view"), 1 - v)))
                y = new.column("y").to_numpy().astype(float)
                some = _in_ratio(y, truth[t][0].mean())
                if len(some):
                    new = new.take(pa.array(some)).select(["f", "d", "m"]).cast(features.schema)
                    models[t, v] = _trained(v, pa.concat_tables([features, new]), np.concatenate([truth[t][0], y[some]]))
        own = {(t, v): calibrated(models[t, v].score(*a.view(v))[:, None], truth[t][1]) if _both(truth[t][1]) else np.array([1.0, 0.0]) for t, v in models}
        del found
    judges = {}
    for t in targets:
        judge = Judge(models[t, 0], models[t, 1], (own[t, 0], own[t, 1]), np.zeros(3))
        whole = np.concatenate(truth[t])
        if 0 < whole.sum() < len(whole):
            judge.mix = calibrated(judge.views(*b.view(0), b.meta), truth[t][2]) if _both(truth[t][2]) else np.array([0.5, 0.5, 0.0])
        else:  # nothing to tell apart
            judge.mix = np.array([0.0, 0.0, np.log((whole.sum() + 0.5) / (len(whole) - whole.sum() + 0.5))])
        judges[t] = judge
    return Model(judges)


def _columns(docs: DataFrame, text_col: str) -> list:
    have = dict(docs.dtypes)
    size = F.col("n_chars").cast("long") if "n_chars" in have else F.length(text_col)
    return [F.col(text_col).alias("t"), *((F.col(c).cast("string") if c in have else F.lit(None).cast("string")).alias(c) for c in ("lang", "source")), size.cast("long").alias("n_chars")]


def _features(rows: DataFrame, extra: list[str]) -> DataFrame:
    """extra columns, then f (buckets), d (dense), m (metadata) of each row."""

    def run(batches):
        for batch in batches:
            meta = meta_view({c: batch.column(c).to_pylist() for c in ("lang", "source", "n_chars")})
            for words in words_of(batch.column("t")):
                row, bucket, dense = text_view(words)
                cuts = np.searchsorted(row, np.arange(words.high - words.low + 1))
                blobs = [bucket[a:b].astype("<i4").tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                columns = [batch.column(c).slice(words.low, words.high - words.low) for c in extra]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(blobs, pa.binary()), pa.array(dense.tolist(), pa.list_(pa.float64())), pa.array(meta[words.low : words.high].tolist(), pa.list_(pa.int64()))], names=[*extra, "f", "d", "m"])

    schema = T.StructType([rows.schema[c] for c in extra] + [T.StructField("f", T.BinaryType()), T.StructField("d", T.ArrayType(T.DoubleType())), T.StructField("m", T.ArrayType(T.LongType()))])
    return rows.mapInArrow(tidy(run), schema)


def trained(docs: DataFrame, labels: DataFrame, n_labelled: int = LABELLED, n_pool: int = POOL, id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    """Co-train on a sample.  Labels of null ids or with a null target are left
    out; of several for one id the worse counts; rows that share a labelled id
    are all labelled.  None if no document is labelled.  A target of which the
    sample has one class alone has that class's share as its score; one whose
    held-out documents are of one class goes uncalibrated."""
    order = F.xxhash64(F.lit(7), "i")
    marks = labels.select(F.col(id_col).cast("long").alias("i"), (F.col("quality") == 0).cast("int").alias("low"), F.col("toxic").cast("int").alias("toxic")).dropna()
    marks = marks.groupBy("i").agg(F.max("low").alias("low"), F.max("toxic").alias("toxic")).orderBy(order, "i").limit(n_labelled)
    rows = docs.select(F.col(id_col).cast("long").alias("i"), *_columns(docs, text_col))
    chosen = rows.join(F.broadcast(marks), "i")  # at most n_labelled rows of three numbers
    labelled = _features(chosen.select("*", F.xxhash64("t").alias("h")), ["i", "h", "low", "toxic"]).orderBy(order, "i", "h").limit(n_labelled).toArrow()
    if not labelled.num_rows:
        return None
    n = docs.count()
    share = min(1.0, max(n_pool / max(n, 1), 1 / POOL_PART))
    drawn = F.pmod(F.xxhash64(F.lit(8), "i", "t"), F.lit(1_000_003)) < int(1_000_003 * share)
    loose = rows.where(drawn).join(F.broadcast(marks.select("i")), "i", "left_anti")
    pool = stored(_features(loose.select("*", F.xxhash64("i", "t").alias("h")), ["h"]), "pool")
    model = cotrained(labelled, _surest(pool), ("low", "toxic"))
    forget(docs.sparkSession, pool)
    return model


def _surest(pool: DataFrame) -> Callable:
    fields = [T.StructField(n, k) for n, k in (("target", T.StringType()), ("view", T.IntegerType()), ("y", T.IntegerType()), ("p", T.DoubleType()))]
    schema = T.StructType([*fields, *pool.schema.fields])

    def surest(models: dict, own: dict, most: int) -> pa.Table:
        def run(batches):
            for batch in batches:
                rows = _Rows(pa.Table.from_batches([batch]))
                for (target, v), model in models.items():
                    p = sigmoid(_mapped(model.score(*rows.view(v))[:, None], own[target, v]))
                    for y, q in ((1, p), (0, 1 - p)):
                        at = np.flatnonzero(q >= CONFIDENT)
                        at = at[np.argsort(-q[at], kind="stable")[:most]]
                        part = batch.take(pa.array(at))
                        columns = [pa.array([target] * len(at), pa.string()), pa.array(np.full(len(at), v, np.int32)), pa.array(np.full(len(at), y, np.int32)), pa.array(q[at])]
                        yield pa.RecordBatch.from_arrays([*columns, *part.columns], names=[*(f.name for f in fields), *part.schema.names])

        found = stored(pool.mapInArrow(tidy(run), schema), "surest")
        parts = [found.where((F.col("target") == t) & (F.col("view") == v) & (F.col("y") == y)).orderBy(F.desc("p"), "h").limit(most).toArrow() for t, v in models for y in (0, 1)]
        forget(pool.sparkSession, found)
        return pa.concat_tables(parts)

    return surest


SCORES = ("p_low_quality", "p_toxic", "keep")


def scored(docs: DataFrame, model: Model | None, threshold: float = 0.5, columns: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """``columns`` of docs (all, if None; not those named like a score), then
    p_low_quality, p_toxic and keep: neither is at the threshold or above.

    A null or empty text is scored as one without words; null or missing
    metadata are a value of their own.  Without a model, scores are null and
    all documents are kept.  Repeated rows get the same scores.
    """
    kept = [c for c in columns or docs.columns if c not in SCORES]
    if model is None:
        return docs.select(*[F.col(f"`{c}`") for c in kept]).select("*", F.lit(None).cast("double").alias(SCORES[0]), F.lit(None).cast("double").alias(SCORES[1]), F.lit(True).alias("keep"))
    inner = [f"__{k}" for k in ("t", "lang", "source", "n_chars")]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], *[c.alias(n) for c, n in zip(_columns(docs, text_col), inner, strict=True)])

    used = np.any([j.text.buckets != 0 for j in model.judges.values()], axis=0)

    def run(batches):
        for batch in batches:
            meta = meta_view({c: batch.column(f"__{c}").to_pylist() for c in ("lang", "source", "n_chars")})
            for words in words_of(batch.column("__t")):
                row, bucket, dense = text_view(words, used)
                p = model.probabilities(row, bucket, dense, meta[words.low : words.high])
                part = [batch.column(i).slice(words.low, words.high - words.low) for i in range(len(kept))]
                keep = (p["low"] < threshold) & (p["toxic"] < threshold)
                yield pa.RecordBatch.from_arrays([*part, pa.array(p["low"]), pa.array(p["toxic"]), pa.array(keep)], names=[*kept, *SCORES])

    schema = T.StructType([rows.schema[c] for c in kept] + [T.StructField(SCORES[0], T.DoubleType()), T.StructField(SCORES[1], T.DoubleType()), T.StructField("keep", T.BooleanType())])
    return rows.mapInArrow(tidy(run), schema)
