"""Exact substring dedup on word windows by level-wise doubling.

Level one finds runs of a quarter of the window (4 words of 13) that are
repeated across documents.  Of the runs in a window only its minimizer counts,
the one of least hash, which equal windows share: one run a window is looked
up instead of all.  Repeated runs alone are extended to twice their length
within the window (8 words), and what is repeated at that length to the window
itself.  ``doubled`` goes on from there, to 26, 52, ... words, until no
candidates survive.

A level is one pass over the texts and one shuffle.  A task sorts the runs it
has read, FLUSH at most at a time.  What it sees in two documents itself it
need not ask for; of each run it sends one entry, with the least document, to
the run's bucket, so a run that every document has costs an entry for each
flush.  A bucket's task answers the entries whose run it has from elsewhere
too.  Entries travel packed, many to a row.  Windows are compared by 128 bits of
hash, shorter runs, which are mere candidates, by 64.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm._shared import stored, tidy
from framewright.llm._text import Words, grams, mix, sliding_argmin, words_of

WINDOW = 13
FLUSH = 1 << 21  # entries that a task holds
BUCKETS = 2  # to a shuffle partition
_U = np.uint64


def _windows(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, row, hash) of all windows of ``window`` words."""
    hashes = grams(words.hash, window)
    n = len(hashes)
    start = np.flatnonzero(words.row[:n] == words.row[window - 1 : window - 1 + n])
    return start, words.row[start], hashes[start]


def _check(words: Words, window: int, start: np.ndarray) -> np.ndarray:
    """Another hash of the windows."""
    return grams(mix(words.hash, words.hash), window)[start]


def _extended(words: Words, window: int, start: np.ndarray, size: int) -> np.ndarray:
    """For each window the hash of its minimizer, a run of a quarter of the
    window, extended to ``size`` words: forwards while that stays within the
    window, else backwards."""
    k = (window + 3) // 4
    runs = grams(words.hash, k)
    at = sliding_argmin(runs, window - k + 1)[start]
    if size == k:
        return runs[at]
    return grams(words.hash, size)[np.where(at + size <= start + window, at, at + k - size)]


def _whole(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each row's whole sequence of words."""
    at = np.arange(len(words.start)) - words.first[words.row]
    each = mix(words.hash, at.astype(_U))
    none = np.zeros(1, _U)
    n = np.diff(words.first).astype(_U)
    return tuple(mix(np.add.reduceat(np.append(x, none), words.first[:-1]) * (n > 0), n) for x in (each, mix(each, each)))


def levels(window: int) -> list[int]:
    """The lengths below the window: a quarter of it and twice as much."""
    k = (window + 3) // 4
    return [k] + [2 * k] * (k < 2 * k < window)


def _lists(column: pa.Array, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of the entries of a list column's rows [low, high)."""
    part = column.slice(low, high - low)
    return pa.compute.list_parent_indices(part).to_numpy(), part.flatten().to_numpy(zero_copy_only=False).view(_U)


def _among(hashes: np.ndarray, row: np.ndarray, known: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Which hashes are in their row's list."""
    at, values = known
    if not len(values):
        return np.zeros(len(hashes), bool)
    return np.isin(mix(hashes, row.astype(_U)), mix(values, at.astype(_U)))


class Entries:
    """Runs (hash, check, document) of a task, sent on by rows (b, kind, data):
    entries for bucket b, or (kind PAIRS) answers.  ``least``: the question
    is whether a smaller document has the run, not whether another has it."""

    REPEATED, LEAST, PAIRS = range(3)

    def __init__(self, buckets: int, least: bool):
        self.buckets, self.kind, self.held, self.n = buckets, self.LEAST if least else self.REPEATED, [], 0

    def add(self, hashes: np.ndarray, check: np.ndarray | None, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append((hashes, np.zeros(len(hashes), _U) if check is None else check, ids))
        self.n += len(hashes)
        if self.n >= FLUSH:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.n:
            return
        h, v, d = (np.concatenate(x) for x in zip(*self.held, strict=True))
        self.held, self.n = [], 0
        order = np.argsort(h, kind="stable")
        h, v, d = h[order], v[order], d[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (v[1:] != v[:-1])
        cuts = np.flatnonzero(new)
        least, most = np.minimum.reduceat(d, cuts), np.maximum.reduceat(d, cuts)
        group = np.cumsum(new) - 1
        known = d > least[group] if self.kind == self.LEAST else (least < most)[group]
        yield from _pair_rows(h[known], d[known], self.buckets)
        h, v, several = h[cuts], v[cuts], least < most
        bucket = ((h >> _U(32)) * _U(self.buckets)) >> _U(32)
        ends = np.append(np.flatnonzero(np.diff(bucket, append=_U(self.buckets))) + 1, len(h))
        ends = np.unique(ends)
        blobs = [b"".join(((b - a).to_bytes(8, "little"), h[a:b].tobytes(), least[a:b].tobytes(), several[a:b].tobytes(), v[a:b].tobytes() if v[a:b].any() else b"")) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
        yield _rows(bucket[ends - 1].astype(np.int64), self.kind, blobs)


def _rows(buckets: np.ndarray, kind: int, blobs: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(buckets), pa.array(np.full(len(blobs), kind, np.int32)), pa.array(blobs, pa.binary())], names=["b", "kind", "data"])


def _pair_rows(hashes: np.ndarray, ids: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Answers (document, hash), dealt over the buckets."""
    if len(ids):
        cuts = list(range(0, len(ids), 4096))
        blobs = [hashes[a : a + 4096].tobytes() + ids[a : a + 4096].tobytes() for a in cuts]
        yield _rows((ids[cuts].astype(_U) * _U(0x9E3779B97F4A7C15) >> _U(32)).astype(np.int64) % buckets, Entries.PAIRS, blobs)


def _answers(batches) -> Iterator[pa.RecordBatch]:
    """(d, w): of rows sorted by bucket, the documents and runs that have an
    answer."""

    def settled(kind: int, parts: list[bytes]) -> pa.RecordBatch | None:
        h, d, several, v = [], [], [], []
        for x in parts:
            n = int.from_bytes(x[:8], "little")
            h.append(np.frombuffer(x, _U, n, 8))
            d.append(np.frombuffer(x, np.int64, n, 8 + 8 * n))
            several.append(np.frombuffer(x, bool, n, 8 + 16 * n))
            v.append(np.frombuffer(x, _U, n, 8 + 17 * n) if len(x) > 8 + 17 * n else np.zeros(n, _U))
        h, d, several, v = map(np.concatenate, (h, d, several, v))
        order = np.lexsort((v, h))
        h, d, several, v = h[order], d[order], several[order], v[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (v[1:] != v[:-1])
        cuts, group = np.flatnonzero(new), np.cumsum(new) - 1
        least = np.minimum.reduceat(d, cuts)
        if kind == Entries.LEAST:
            good = d > least[group]
        else:
            good = ((least < np.maximum.reduceat(d, cuts)) | np.logical_or.reduceat(several, cuts))[group] & ~several
        return _pairs(h[good], d[good])

    def _pairs(h: np.ndarray, d: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(d), pa.array(h.view(np.int64))], names=["d", "w"])

    held: list[bytes] = []
    now = None
    for batch in batches:
        for bucket, kind, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if kind == Entries.PAIRS:
                n = len(data) // 16
                yield _pairs(np.frombuffer(data, _U, n), np.frombuffer(data, np.int64, n, 8 * n))
                continue
            if (bucket, kind) != now:
                if held:
                    yield settled(now[1], held)
                held, now = [], (bucket, kind)
            held.append(data)
    if held:
        yield settled(now[1], held)


def _level(rows: DataFrame, find: Callable, least: bool) -> DataFrame:
    """(d, known): for each document the hashes of its runs that have an
    answer.  ``rows`` has d, t and, after the first level, known; ``find``
    gives (row, hash, check) of some words' runs.  A copy of a document with
    a smaller id has its whole hash in ``known`` from the first level on, and
    nothing else after it."""
    buckets = BUCKETS * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = "known" not in rows.columns

    def run(batches):
        runs, texts = Entries(buckets, least), Entries(buckets, True)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for words in words_of(batch.column(1)):
                own = ids[words.low : words.high]
                whole, check = _whole(words)
                known = None if first else _lists(batch.column(2), words.low, words.high)
                if first:
                    yield from texts.add(whole, check, own)
                    copy = np.zeros(len(own), bool)
                else:
                    copy = _among(whole, np.arange(len(own)), known)
                    yield from _pair_rows(whole[copy], own[copy], buckets)
                row, h, v = find(words, known)
                on = ~copy[row]
                row, h, v = row[on], h[on], None if v is None else v[on]
                fresh = np.ones(len(h), bool)
                fresh[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                yield from runs.add(h[fresh], None if v is None else v[fresh], own[row[fresh]])
        yield from runs.flush()
        yield from texts.flush()

    sent = rows.mapInArrow(tidy(run), "b long, kind int, data binary").repartition("b").sortWithinPartitions("b", "kind")
    return sent.mapInArrow(tidy(_answers), "d long, w long").groupBy("d").agg(F.collect_list("w").alias("known"))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(d, t) of the rows with an id."""
    return docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).alias("t")).where("d is not null")


def repeated_windows(texts: DataFrame, window: int, least: bool) -> DataFrame:
    """(d, known): hashes of a document's windows that start in another one,
    or, if ``least``, in one with a smaller id."""
    if window < 2:
        raise ValueError("window must be 2 or more")
    rows, below = texts, None

    def finder(size: int, below: int | None):
        def find(words: Words, known):
            start, row, hashes = _windows(words, window)
            if below is not None:
                keep = _among(_extended(words, window, start, below), row, known) if len(start) and len(known[1]) else np.zeros(len(start), bool)
                start, row, hashes = start[keep], row[keep], hashes[keep]
            if size < window:
                return row, _extended(words, window, start, size) if len(start) else hashes, None
            return row, hashes, _check(words, window, start) if len(start) else hashes

        return find

    for size in [*levels(window), window]:
        known = _level(rows, finder(size, below), least and size == window)
        # a left join without a filter on the texts, so that all levels share one shuffle of them
        rows, below = texts.join(known, "d", "left").select("d", "t", "known"), size
    return known


def deduplicated(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """One row per row: doc_id, n_words, n_removed, kept_sha256 and, if
    ``keep_text``, text (the kept words joined by one space).

    A word goes if a window of ``window`` words that covers it also starts in
    a document with a smaller id.  A null or empty text, or one of fewer words
    than the window, loses nothing.  Rows with a null id lose nothing and make
    others lose nothing.  Rows of one id don't remove each other's words.
    """
    texts = _texts(docs, id_col, text_col)
    joined = texts.join(repeated_windows(texts, window, True), "d", "left").select("d", "t", "known")
    apart = docs.where(F.col(id_col).cast("long").isNull()).select(F.lit(None).cast("long").alias("d"), F.col(text_col).alias("t"), F.array().cast("array<long>").alias("known"))
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "text"][: 4 + keep_text]

    def run(batches):
        for batch in batches:
            for words in words_of(batch.column(1)):
                low, rows = words.low, words.high - words.low
                lost = np.zeros(len(words.start) + 1, np.int64)
                known = _lists(batch.column(2), low, words.high)
                n = np.diff(words.first)
                if len(known[1]):
                    start, row, hashes = _windows(words, window)
                    found = start[_among(hashes, row, known)]
                    lost[found] += 1
                    np.subtract.at(lost, np.minimum(found + window, len(lost) - 1), 1)
                kept = np.cumsum(lost)[:-1] == 0
                if len(known[1]):
                    copy = _among(_whole(words)[0], np.arange(rows), known) & (n >= window)
                    kept &= ~copy[words.row]
                left = np.add.reduceat(np.append(kept, False).astype(np.int64), words.first[:-1]) * (n > 0) if rows else n
                lines = words.joined(kept)
                out = [batch.column(0).slice(low, rows), pa.array(n), pa.array(n - left), pa.array([hashlib.sha256(x).hexdigest() for x in lines])]
                if keep_text:
                    out.append(pa.array([bytes(x).decode("utf-8", "replace") for x in lines]))
                yield pa.RecordBatch.from_arrays(out, names=names)

    return joined.union(apart).mapInArrow(tidy(run), "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", text string" * keep_text)


def doubled(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, longest): for each document with a window of ``window`` words
    that occurs in another, the greatest length window * 2**j at which it
    still has one.  Whole copies of a document with a smaller id are left out.
    Level by level: of the windows of twice the length only those are looked
    up whose two halves are repeated, until no candidates survive."""
    texts, size, best = _texts(docs, id_col, text_col), window, None
    known = stored(repeated_windows(texts, window, False), "windows")
    while True:

        def has_run(batches, size=size):
            for batch in batches:
                for words in words_of(batch.column(1)):
                    start, row, hashes = _windows(words, size)
                    some = np.unique(row[_among(hashes, row, _lists(batch.column(2), words.low, words.high))])
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(words.low + some))], names=["d"])

        rows = stored(texts.join(known, "d"), "texts")
        here = stored(rows.mapInArrow(tidy(has_run), "d long").distinct().withColumn("n", F.lit(size)), "lengths")
        if here.isEmpty():
            break
        best = here if best is None else best.union(here)

        def longer(words: Words, known, size=size):
            start, row, hashes = _windows(words, size)
            hit = np.zeros(len(words.start) + size + 1, bool)
            hit[start] = _among(hashes, row, known)
            begin, row, whole = _windows(words, 2 * size)
            both = hit[begin] & hit[begin + size]
            return row[both], whole[both], _check(words, 2 * size, begin[both]) if both.any() else whole[both]

        known = stored(_level(rows, longer, False), "windows")
        size *= 2
    if best is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, longest long")
    return best.groupBy(F.col("d").alias("doc_id")).agg(F.max("n").cast("long").alias("longest"))
