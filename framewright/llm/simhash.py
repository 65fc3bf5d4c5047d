"""SimHash near-duplicates by Golay-code fuzzy hashing.

The 64 bits of a fingerprint are three segments of 23, 23 and 18 bits (the
last filled up with zeros).  The binary Golay code of length 23 is perfect:
every segment value decodes to the one codeword within three errors, a 12-bit
index.  A segment's keys are the indices of the value and of its one-bit
neighbours, 6 at most; a value that differs in one bit has one of them as its
own index.  Of two fingerprints that differ in at most three bits, either all
three segments differ in at most one bit each, or one is equal and another
differs in at most one (pigeonhole).  So the keys are the combinations of all
three segments' keys, and, for each segment and each other, the segment's value
with the other's keys: 36 and 35 bits.  Candidates are joined on these and
verified by counting the differing bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm._components import components
from framewright.llm._shared import stored, tidy

SEGMENTS = ((0, 23), (23, 23), (46, 18))
PAIRS = tuple((i, j) for i in range(3) for j in range(3) if i != j)
GENERATOR = 0xAE3  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
MOST = 3
SEED = 42


def _syndromes() -> np.ndarray:
    """Of each byte at each of three places."""
    bit = np.zeros(24, np.uint16)
    for i in range(23):
        x = 1 << i
        for high in range(i, 10, -1):
            if x >> high & 1:
                x ^= GENERATOR << (high - 11)
        bit[i] = x
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(bool)
    return np.array([np.bitwise_xor.reduce(np.where(bits, bit[8 * k : 8 * k + 8], 0), axis=1) for k in range(3)], np.uint16)


def _errors(of_byte: np.ndarray) -> np.ndarray:
    """The error pattern of at most three bits for each syndrome."""
    ones = np.uint32(1) << np.arange(23, dtype=np.uint32)
    two = ones[:, None] | ones[None, :]
    patterns = np.unique(np.concatenate([[np.uint32(0)], two.ravel(), (two[:, :, None] | ones).ravel()]))
    errors = np.zeros(2048, np.uint32)
    errors[_syndrome(patterns, of_byte)] = patterns
    return errors


def _syndrome(values: np.ndarray, of_byte: np.ndarray) -> np.ndarray:
    return of_byte[0][values & 255] ^ of_byte[1][values >> 8 & 255] ^ of_byte[2][values >> 16]


_OF_BYTE = _syndromes()
_ERRORS = _errors(_OF_BYTE)


def golay_index(values: np.ndarray) -> np.ndarray:
    """The index of each 23-bit value's nearest codeword."""
    return ((values ^ _ERRORS[_syndrome(values, _OF_BYTE)]) >> np.uint32(11)).astype(np.uint16)


def segment_keys(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices (n, bits + 1) of the values (first) and their one-bit
    neighbours, and which of them are a row's first of their kind."""
    flips = np.concatenate([[0], 1 << np.arange(bits)]).astype(np.uint32)
    keys = golay_index(values[:, None] ^ flips[None, :])
    order = np.argsort(keys, axis=1, kind="stable")
    ranked = np.take_along_axis(keys, order, 1)
    fresh = np.ones_like(ranked, bool)
    fresh[:, 1:] = ranked[:, 1:] != ranked[:, :-1]
    new = np.zeros_like(fresh)
    np.put_along_axis(new, order, fresh, 1)
    return keys, new


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of the text's word shingles, A-Z lower-cased; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    line = b" ".join(words)
    if len(words) < shingle:
        found = [digest(line, SEED)]
    else:
        size = np.fromiter(map(len, words), np.int64, len(words))
        end = np.cumsum(size + 1) - 1
        found = [digest(line[i:j], SEED) for i, j in zip((end - size)[: len(words) - shingle + 1].tolist(), end[shingle - 1 :].tolist(), strict=True)]
    h = np.array(found, "<u8")
    counts = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        counts += np.unpackbits(h[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): a row per row, fp as signed 64-bit integer."""

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                fp = np.array([fingerprint(t, shingle) for t in part.column(1).to_pylist()], np.uint64).astype(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp)], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(tidy(run), "doc_id long, fp long")


def _keys(fps: DataFrame, near: bool) -> DataFrame:
    """(k, fp): the keys to look up, or each fingerprint's own."""

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                fp = batch.column(0).slice(low, 512).to_numpy(zero_copy_only=False)
                bits = fp.view(np.uint64)
                parts = [((bits >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.uint32) for at, n in SEGMENTS]
                found = [segment_keys(x, n) for x, (_, n) in zip(parts, SEGMENTS, strict=True)]
                if not near:
                    found = [(keys[:, :1], new[:, :1]) for keys, new in found]
                (ka, na), (kb, nb), (kc, nc) = [(k.astype(np.int64), new) for k, new in found]
                row, i, j = np.nonzero(na[:, :, None] & nb[:, None, :])
                two = ka[row, i] << 12 | kb[row, j]
                at, m = np.nonzero(nc[row])
                rows, keys = [row[at]], [two[at] << 12 | kc[row[at], m]]
                for p, (a, b) in enumerate(PAIRS):
                    row, j = np.nonzero(found[b][1])
                    rows.append(row)
                    keys.append(np.int64(p + 1) << 36 | parts[a][row].astype(np.int64) << 12 | found[b][0][row, j].astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(fp[np.concatenate(rows)])], names=["k", "fp"])

    return fps.mapInArrow(tidy(run), "k long, fp long")


def links(fps: DataFrame, most: int = MOST) -> DataFrame:
    """All pairs (a, b), a < b, of distinct fingerprints (fp) that differ in at
    most ``most`` bits; most is 3 or less."""
    if not 0 <= most <= 3:
        raise ValueError("the code finds up to 3 differing bits")
    # spread over all tasks, as a few bytes grow to some 250 rows
    fps = fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    near = _keys(fps, True).withColumnRenamed("fp", "a")
    own = _keys(fps, False).withColumnRenamed("fp", "b")
    close = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= most)
    return near.join(own, "k").where(close).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, most: int = MOST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits),
    component_id (least document id reachable over links), n_links (other
    fingerprints linked to this one).

    Texts without words, null ones too, have fingerprint zero and are linked
    like others.  Equal fingerprints are one node, so copies cost a row each
    and no pairs.  A null id takes part; a component of null ids alone has a
    null component_id.  Repeated rows give repeated rows.
    """
    marks = stored(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    nodes = marks.groupBy("fp").agg(F.min("doc_id").alias("least"))
    edges = stored(links(nodes.select("fp"), most), "links")
    roots = components(edges)
    degree = edges.select(F.explode(F.array("a", "b")).alias("fp")).groupBy("fp").agg(F.count("*").alias("n_links"))
    placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    by_mark = stored(placed.join(named, "root").join(degree, "fp", "left").select("fp", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links")), "components")
    return marks.join(by_mark, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_links")
