"""Exact top-k by integer inner product, over vectors sorted by length.

Candidates are dealt by descending length into blocks, queries into groups of
bounded size.  All queries first meet the longest block, which gives each a
lower bound, its k-th best score so far.  By Cauchy-Schwarz a query whose
length times the greatest of a block is below its bound needs nothing from that
block; a query group meets only the blocks that one of its queries needs.  There
both are rotated by right singular vectors of the longest block, the first
components' partial sums are taken, and the bound of the rest is added.  Only
where that reaches the query's bound is the exact integer score computed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewright.llm._shared import stored, tidy

GROUP = 4096  # candidates to a block
QUERIES = 1024  # queries to a group
STEP = 256  # candidates between two looks at the bounds
FIRST_BYTES = 64 << 20  # of longest blocks, one for each length of vector, that go to all tasks
HEAD = 0.75  # of the rotated components in the partial sums

SCALE = 1024


def integers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component x as double; null for a null vector
    or one that holds null or non-finite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(vector.isNotNull() & fine, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _blocks(vectors: DataFrame, size: int) -> DataFrame:
    """(g, dim, top, ids, values, bounds): rows (i, v, bound) in the order
    given, in blocks of one length of vector and at most ``size`` rows; values
    are 64-bit integers, top is the greatest Euclidean length."""

    def run(batches):
        number, held = TaskContext.get().partitionId() << 24, {}

        def block(dim: int) -> pa.RecordBatch:
            nonlocal number
            ids, values, bounds = zip(*held.pop(dim), strict=True)
            number += 1
            flat = np.concatenate(values).astype("<i8")
            top = float(np.sqrt((flat.reshape(len(ids), dim).astype(float) ** 2).sum(1)).max()) if dim else 0.0
            return pa.RecordBatch.from_pydict({"g": [number], "dim": [dim], "top": [top], "ids": [np.array(ids, "<i8").tobytes()], "values": [_narrow(flat)], "bounds": [np.array(bounds, "<f8").tobytes()]})

        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum([len(x) for x in lists])
            for i, (vec_id, bound, end) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), ends.tolist(), strict=True)):
                dim = len(lists[i])
                held.setdefault(dim, []).append((vec_id, flat[end - dim : end], bound))
                if len(held[dim]) == size:
                    yield block(dim)
        for dim in list(held):
            yield block(dim)

    return vectors.mapInArrow(tidy(run), "g long, dim long, top double, ids binary, values binary, bounds binary")


def _narrow(values: np.ndarray) -> bytes:
    """Little-endian integers of 2, 4 or 8 bytes, as they need, and that size."""
    for size in (2, 4):
        if not values.size or np.abs(values).max(initial=0) < 1 << (8 * size - 1):
            return values.astype(f"<i{size}").tobytes() + bytes([size])
    return values.tobytes() + bytes([8])


def _wide(data: bytes, rows: int, dim: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{data[-1]}", rows * dim).astype(np.int64).reshape(rows, dim)


def _exact(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products (queries, candidates); float64 while it is exact."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    if top < 2**53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    whole = np.dot(q.astype(object), c.T.astype(object))
    return np.clip(whole, -(2**63), 2**63 - 1).astype(np.int64)


def rotation_of(vectors: np.ndarray) -> np.ndarray:
    """The right singular vectors, of the greatest value first."""
    exact = vectors.astype(np.float64)
    return np.linalg.eigh(exact.T @ exact)[1][:, ::-1] if exact.shape[1] else np.zeros((0, 0))


def top_of(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, rotation: np.ndarray, bounds: np.ndarray) -> tuple[list[tuple[int, int, int]], int]:
    """(query_id, vec_id, score) of each query's k best among the vectors that
    reach the query's bound, and how many pairs were scored exactly."""
    length = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))
    order = np.argsort(-length, kind="stable")
    vectors, ids, length = vectors[order], ids[order], length[order]
    c, q = vectors.astype(np.float64) @ rotation, queries.astype(np.float64) @ rotation
    head = max(1, int(HEAD * c.shape[1]))
    rest = [np.sqrt((x[:, head:] ** 2).sum(1)) for x in (q, c)]
    q_length = np.sqrt((q**2).sum(1))
    slack = 1e-9 * (q_length[:, None] * (length.max(initial=0) + 1)) + 1e-6  # for rounding in the bounds
    best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in query_ids]
    least, scored = bounds.astype(np.float64).copy(), 0
    for low in range(0, len(ids), STEP):
        high = min(low + STEP, len(ids))
        live = np.flatnonzero(q_length * length[low] + slack[:, 0] >= least)
        if not len(live):
            break
        bound = q[live, :head] @ c[low:high, :head].T + rest[0][live, None] * rest[1][None, low:high] + slack[live]
        wanted = bound >= least[live, None]
        live, wanted = live[wanted.any(1)], wanted[wanted.any(1)]
        if not len(live):
            continue
        some = np.flatnonzero(wanted.any(0))
        scores = _exact(queries[live], vectors[low:high][some])
        scored += int(wanted.sum())
        wanted = wanted[:, some] & (ids[low:high][some][None, :] != query_ids[live, None])
        for r, i in enumerate(live.tolist()):
            at = np.flatnonzero(wanted[r] & (scores[r] >= least[i]))
            if len(at):
                s, v = np.concatenate([best[i][0], scores[r, at]]), np.concatenate([best[i][1], ids[low:high][some][at]])
                keep = np.lexsort((v, -s))[:k]
                best[i] = s[keep], v[keep]
                if len(keep) == k:
                    least[i] = max(least[i], float(s[keep[-1]]))
    return [(int(query_ids[i]), int(v), int(s)) for i, (ss, vv) in enumerate(best) for s, v in zip(ss, vv, strict=True)], scored


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row that is_query the
    k rows of other ids with the highest inner products, ties to the smaller
    id; all of them if there are fewer.

    Rows with a null id, a null vector, or null or non-finite components take
    no part.  Vectors of different lengths aren't compared; empty vectors
    score 0 with each other.  Rows of one id are candidates one by one; a
    query id that is repeated is answered once, for its row of least vector.
    Scores beyond 64 bits are cut to them.
    """
    rows = vectors.where(is_query | ~is_query | is_query.isNull()).select(F.col(id_col).cast("long").alias("i"), integers(F.col(vector_col), scale).alias("v"), is_query.alias("q")).where("i is not null and v is not null")
    length = F.aggregate("v", F.lit(0.0), lambda t, x: t + x.cast("double") * x)
    spread, none = F.xxhash64("i"), F.lit(float("-inf")).alias("bound")
    sorted_rows = rows.withColumn("l", length).repartitionByRange(F.desc("l"), spread).sortWithinPartitions(F.desc("l"), spread).select("i", "v", none)
    blocks = stored(_blocks(sorted_rows, GROUP), "blocks")
    tops: dict[int, list[tuple[float, int]]] = {}  # two numbers to a block
    for r in blocks.select("g", "dim", "top").collect():
        tops.setdefault(r["dim"], []).append((-r["top"], r["g"]))
    firsts, room = {}, FIRST_BYTES
    for dim, some in tops.items():
        some.sort()
        if (room := room - 8 * GROUP * max(dim, 1)) >= 0:
            firsts[dim] = some[0][1]
    longest: dict[int, tuple] = {}
    for r in blocks.where(F.col("g").isin(list(firsts.values()))).select("dim", "g", "ids", "values").collect():
        if firsts[r["dim"]] == r["g"]:
            ids = np.frombuffer(bytes(r["ids"]), "<i8")
            values = _wide(bytes(r["values"]), len(ids), r["dim"])
            longest[r["dim"]] = ids, values, rotation_of(values)
    asked = rows.where("q").groupBy("i").agg(F.min("v").alias("v"))

    def answers(query_ids, queries, bounds, ids, values):
        rotation = longest[queries.shape[1]][2] if queries.shape[1] in longest else rotation_of(values)
        found, _ = top_of(queries, query_ids, values, ids, k, rotation, bounds)
        if found:
            a, b, c = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.int64())], names=["query_id", "vec_id", "score"])

    def begin(batches):
        for batch in batches:
            for dim, raw_ids, raw in zip(batch.column("dim").to_pylist(), batch.column("ids").to_pylist(), batch.column("values").to_pylist(), strict=True):
                if dim in longest:
                    query_ids = np.frombuffer(raw_ids, "<i8")
                    yield from answers(query_ids, _wide(raw, len(query_ids), dim), np.full(len(query_ids), -np.inf), *longest[dim][:2])

    groups = _blocks(asked.repartition("i").select("i", "v", none), QUERIES)
    first = stored(groups.mapInArrow(tidy(begin), FOUND), "first")
    sure = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("s")).where(F.col("n") == k).select(F.col("query_id").alias("i"), F.col("s").cast("double").alias("bound"))
    # queries that need like lengths go together
    need = F.coalesce("bound", F.lit(float("-inf"))) / F.sqrt(F.greatest(length, F.lit(1e-9)))
    bounded = asked.join(sure, "i", "left").select("i", "v", F.coalesce("bound", F.lit(float("-inf"))).alias("bound"), need.alias("need"))
    groups = _blocks(bounded.repartitionByRange("need", "i").sortWithinPartitions("need", "i").select("i", "v", "bound"), QUERIES)

    def sent(batches):
        for batch in batches:
            for row in batch.to_pylist():
                query_ids = np.frombuffer(row["ids"], "<i8")
                q = _wide(row["values"], len(query_ids), row["dim"]).astype(float)
                size, bounds = np.sqrt((q**2).sum(1)), np.frombuffer(row["bounds"], "<f8")
                to = []
                for top, g in tops.get(row["dim"], []):
                    if (size * -top * (1 + 1e-9) + 1e-6 < bounds).all():
                        break
                    if not (row["dim"] in longest and firsts[row["dim"]] == g):
                        to.append(g)
                for low in range(0, len(to), 64):
                    part = to[low : low + 64]
                    yield pa.RecordBatch.from_pydict({"g": part, "q_ids": [row["ids"]] * len(part), "q_values": [row["values"]] * len(part), "q_bounds": [row["bounds"]] * len(part)})

    pairs = groups.mapInArrow(tidy(sent), "g long, q_ids binary, q_values binary, q_bounds binary").join(blocks.select("g", "dim", "ids", "values"), "g")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                query_ids, ids = np.frombuffer(row["q_ids"], "<i8"), np.frombuffer(row["ids"], "<i8")
                yield from answers(query_ids, _wide(row["q_values"], len(query_ids), row["dim"]), np.frombuffer(row["q_bounds"], "<f8"), ids, _wide(row["values"], len(ids), row["dim"]))

    found = first.union(pairs.select("dim", "ids", "values", "q_ids", "q_values", "q_bounds").mapInArrow(tidy(run), FOUND))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


FOUND = "query_id long, vec_id long, score long"
