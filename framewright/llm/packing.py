"""Mixture-controlled packing: every window of ``window`` tokens takes its
sources' target shares by deficit round-robin.

Texts are encoded once into a table in the shared folder.  Its rows are dealt
to groups of about ``GROUP`` windows by the running token position within their
sources, in a random order, and read in that order, so that each group holds
every source in its share all along, however the input is clustered.  The token
counts of (group, source) over all documents give the target shares, unless
they are given, and the deficits with which each group begins: what its sources
were owed and did not get in all groups before it; these go with the group's
rows.  Then each group is packed by itself: per source a queue, per window a
credit of share * window tokens for each source on top of its deficit; a source
that has too little carries the rest to the next windows, and what it leaves
goes to those that have more.  Documents are cut where a credit or a window
ends.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewright.llm._shared import stored, tidy
from framewright.llm._tokens import word_encoder

WINDOW = 4096
GROUP = 1024  # windows' worth of tokens packed in one go, on average
SLICES = 16  # of a source's order to a group
CHUNK = 4096  # rows of a running sum in one task
BROADCAST_BYTES = 8 << 20
AHEAD = 64  # windows' worth of tokens that a task holds back to mix from

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"


def encoded(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(part, doc_id, source, n_tokens, ids, row): row counts a part's rows,
    ids as the narrowest unsigned integers that hold the vocabulary."""

    def encode(batches):
        part = TaskContext.get().partitionId()
        encoder = word_encoder(tokenizer)
        wide = max(encoder.dtype.itemsize, 2 if end_id < 1 << 16 else 4)
        row = 0
        for batch in batches:
            for low, offsets, ids in encoder.encode(batch.column(2)):
                n = len(offsets) - 1
                ids = np.insert(ids.astype(f"<u{wide}"), offsets[1:], end_id)
                ends = (offsets + np.arange(n + 1)) * wide
                blob = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends.astype("<i8")), pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, part)), batch.column(0).slice(low, n), batch.column(1).slice(low, n), pa.array(np.diff(ends) // wide), blob.cast(pa.binary()), pa.array(np.arange(row, row + n))],
                    names=["part", "doc_id", "source", "n_tokens", "ids", "row"],
                )
                row += n

    rows = docs.select(F.col(id_col).cast("long"), F.col(source_col).cast("string"), F.col(text_col))
    return stored(rows.mapInArrow(tidy(encode, encodes=True), "part long, doc_id long, source string, n_tokens long, ids binary, row long"), "packing")


class Mixer:
    """Deficit round-robin over source queues."""

    def __init__(self, shares: dict[str, float], owed: dict[str, float], window: int):
        self.window, self.shares = window, shares
        self.owed = {s: owed.get(s, 0.0) for s in shares}
        self.queues: dict[str, deque] = {s: deque() for s in shares}
        self.have = dict.fromkeys(shares, 0)
        self.total = 0

    def add(self, source: str, doc) -> None:
        """doc: (key, ids), with the ids still to be placed from the front."""
        self.queues[source].append([doc, 0])
        self.have[source] += len(doc[1])
        self.total += len(doc[1])

    def fill(self) -> list[tuple]:
        """The pieces (source, doc, start, stop) of the next window."""
        room = min(self.window, self.total)
        due = {}
        for s, share in self.shares.items():
            self.owed[s] += share * room
        take = dict.fromkeys(self.shares, 0)
        left = room
        for s in sorted(self.shares, key=lambda s: -self.owed[s]):
            take[s] = min(self.have[s], max(0, int(round(self.owed[s]))), left)
            left -= take[s]
        while left:  # what dry queues leave goes round by share
            rich = [s for s in self.shares if self.have[s] > take[s]]
            weight = sum(self.shares[s] for s in rich) or 1.0
            due = left
            for s in sorted(rich, key=lambda s: -self.owed[s] + take[s]):
                more = min(self.have[s] - take[s], max(1, int(due * self.shares[s] / weight)), left)
                take[s] += more
                left -= more
        pieces = []
        for s, n in take.items():
            self.owed[s] -= n
            self.have[s] -= n
            queue = self.queues[s]
            while n:
                doc, at = queue[0]
                m = min(n, len(doc[1]) - at)
                pieces.append((s, doc, at, at + m))
                n -= m
                if at + m == len(doc[1]):
                    queue.popleft()
                else:
                    queue[0][1] = at + m
        self.total -= room
        return pieces


def dealt(table: DataFrame, window: int) -> DataFrame:
    """The table with ``s``, its source or "", each row's place ``h``, from 0
    to 1: the share of its source's tokens that go before it in a random order;
    and its group ``g``, a range of places.  A source's order is cut into
    slices by a hash, SLICES to a group; a row's place within its slice is
    another hash."""
    tokens = table.agg(F.sum("n_tokens")).first()[0] or 0
    groups = max(1, round(tokens / (GROUP * window)))
    keyed = table.withColumn("s", F.coalesce("source", F.lit(""))).withColumn("b", F.pmod(F.xxhash64("part", "row"), F.lit(SLICES * groups)))
    keyed = keyed.withColumn("u", F.pmod(F.xxhash64("row", "part"), F.lit(1 << 20)) / (1 << 20))
    sums = stored(keyed.groupBy("s", "b").agg(F.sum("n_tokens").alias("n")).withColumn("c", F.floor(F.col("b") / CHUNK)), "slices")
    places = stored(_running(sums, ["s"], "b").select("s", "b", "n", "before", "whole"), "slices")
    count, wide = places.agg(F.count("*"), F.max(F.octet_length("s"))).first()
    small = count * ((wide or 0) + 64) <= BROADCAST_BYTES
    placed = keyed.join(F.broadcast(places) if small else places, ["s", "b"])
    placed = placed.withColumn("h", (F.col("before") + F.col("u") * F.col("n")) / F.col("whole"))
    return placed.withColumn("g", F.least(F.floor(F.col("h") * groups), F.lit(groups - 1))).drop("b", "c", "u", "n", "before", "whole")


def _running(sums: DataFrame, by: list[str], order: str) -> DataFrame:
    """The rows, with ``before``, the sum of ``n`` over the rows before in
    their order, and ``whole``, over all; in chunks ``c`` of the order, so that
    no task has more than a chunk of rows, or the sums of the chunks."""
    chunks = sums.groupBy(*by, "c").agg(F.sum("n").alias("m"))
    of = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    chunks = chunks.select(*by, "c", (F.sum("m").over(of.orderBy("c")) - F.col("m")).alias("earlier"), F.sum("m").over(of).alias("whole"))
    within = F.sum("n").over(Window.partitionBy(*by, "c").orderBy(order)) - F.col("n")
    return sums.withColumn("before", within).join(chunks, [*by, "c"]).withColumn("before", F.col("before") + F.col("earlier"))


def mixture(table: DataFrame, shares: dict[str, float] | None) -> DataFrame:
    """(g, s, share, owed): for each source of each group its target share, and
    the deficit it begins with, what it was owed and did not get in all groups
    before."""
    sums = stored(table.groupBy("s", "g").agg(F.sum("n_tokens").alias("n")).withColumn("c", F.floor(F.col("g") / CHUNK)), "mixture")
    own = _running(sums, ["s"], "g").select("s", "g", F.col("before").alias("got"), F.col("whole").alias("of_source"))
    groups = sums.groupBy("g", "c").agg(F.sum("n").alias("n"))
    groups = _running(groups, [], "g").select("g", F.col("before").alias("all_before"), "whole")
    rows = own.join(groups, "g")
    if shares is None:
        share = F.col("of_source") / F.col("whole")
    else:
        total = sum(shares.values())
        share = F.lit(0.0)
        for name, x in shares.items():
            share = F.when(F.col("s") == name, x / total).otherwise(share)
    return rows.withColumn("share", share).select("g", "s", "share", (F.col("share") * F.col("all_before") - F.col("got")).alias("owed"))


def packed(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    end_id: int = 2,
    shares: dict[str, float] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Pack all documents into sequences of at most ``window`` tokens; one row
    per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, source.  Each id of each row lies in exactly one piece; offsets
    within a sequence are gapless from 0.

    A document is its text's ids and ``end_id``; a null text is empty, so the
    end id alone.  A null source is the source "".  Null and repeated document
    ids are packed row by row like others.  ``shares`` maps sources to target
    shares of tokens (None: the corpus's own); sources it lacks wait until
    others run dry.  An empty table gives no rows.  Every group ends with at
    most one sequence that is not full.
    """
    if window < 1:
        raise ValueError("window must be positive")
    table = dealt(encoded(docs, tokenizer, end_id, id_col, text_col, source_col), window)
    terms = mixture(table, shares)

    def pack(batches):
        mixer, group, number = None, None, 0
        shares, owed = {}, {}
        out: list[tuple] = []
        for batch in batches:
            place, name, doc_id, source, count, share, debt = (batch.column(i).to_pylist() for i in range(7))
            blobs = batch.column(7)
            for i in range(batch.num_rows):
                if place[i] != group:
                    while mixer is not None and mixer.total:
                        number = _window(mixer, number, out)
                    mixer, group, number = None, place[i], place[i] << 24
                    shares, owed = {}, {}
                if share[i] is not None:  # a group's terms come before its documents
                    shares[name[i]], owed[name[i]] = share[i], debt[i]
                    continue
                if mixer is None:
                    mixer = Mixer(shares, owed, window)
                blob = blobs[i].as_buffer()
                mixer.add(name[i], ((doc_id[i], source[i]), np.frombuffer(blob, f"<u{len(blob) // count[i]}")))
                if mixer.total >= 2 * AHEAD * window:
                    while mixer.total >= AHEAD * window:
                        number = _window(mixer, number, out)
                if len(out) > 20_000:
                    yield _pieces(out)
                    out = []
        while mixer is not None and mixer.total:
            number = _window(mixer, number, out)
            if len(out) > 20_000:
                yield _pieces(out)
                out = []
        if out:
            yield _pieces(out)

    none = F.lit(None)
    rows = table.select("g", "h", "s", "doc_id", "source", "n_tokens", none.cast("double").alias("share"), none.cast("double").alias("owed"), "ids", "part", "row")
    terms = terms.select("g", F.lit(-1.0).alias("h"), "s", none.cast("long").alias("doc_id"), none.cast("string").alias("source"), F.lit(0).cast("long").alias("n_tokens"), "share", "owed", none.cast("binary").alias("ids"), F.lit(-1).cast("long").alias("part"), F.lit(-1).cast("long").alias("row"))
    rows = rows.union(terms).repartition("g").sortWithinPartitions("g", "h", "part", "row")
    return rows.select("g", "s", "doc_id", "source", "n_tokens", "share", "owed", "ids").mapInArrow(tidy(pack), PIECES)


def _window(mixer: Mixer, number: int, out: list[tuple]) -> int:
    offset = 0
    for _, ((doc_id, source), ids), start, stop in mixer.fill():
        out.append((doc_id, start, stop - start, zlib.crc32(ids[start:stop].astype("<u4").tobytes()), len(ids), number, offset, source))
        offset += stop - start
    return number + 1


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in PIECES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x, pa.string() if n == "source" else pa.int64()) for n, x in zip(names, zip(*rows, strict=True), strict=True)], names=names)
