"""Token-id files in bit or byte planes.

A file holds the ids of documents in a row.  Blocks of ``block`` ids are taken
as little-endian 32-bit integers, transposed into byte planes (or bit planes),
and each plane is compressed with zstandard; a plane of zeros takes no bytes.
After the blocks come an index (zstandard-compressed JSON), its length in 8
bytes, and the magic bytes again.  The index names the planes, the end id and
for each block its place, its ids and its planes' lengths, and the documents:
ids, which of them are null, and token counts.  A range of tokens is read by
its blocks alone.
"""

from __future__ import annotations

import base64
import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm._shared import filesystem, task_file, tidy, work_path
from framewright.llm._tokens import word_encoder

MAGIC = b"FWTOKEN1"
BLOCK = 1 << 16


def to_planes(ids: np.ndarray, planes: str) -> list[bytes]:
    """A block's byte planes (4) or bit planes (32), least significant first."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if planes == "byte":
        return [raw[:, i].tobytes() for i in range(4)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(bits[:, i], bitorder="little").tobytes() for i in range(32)]


def from_planes(parts: list[bytes], n: int, planes: str) -> np.ndarray:
    if planes == "byte":
        raw = np.zeros((n, 4), np.uint8)
        for i, part in enumerate(parts):
            if part:
                raw[:, i] = np.frombuffer(part, np.uint8)
    else:
        bits = np.zeros((n, 32), np.uint8)
        for i, part in enumerate(parts):
            if part:
                bits[:, i] = np.unpackbits(np.frombuffer(part, np.uint8), count=n, bitorder="little")
        raw = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view("<u4").reshape(-1)


def _packed(values: np.ndarray) -> str:
    return base64.b64encode(zstandard.compress(values.tobytes())).decode()


def _unpacked(text: str, dtype: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(base64.b64decode(text)), dtype)


class TokenWriter:
    """Writes documents to an open stream; memory: one block, and 17 bytes for
    each document."""

    def __init__(self, out, planes: str = "byte", block: int = BLOCK, level: int = 1, end_id: int | None = None):
        if planes not in ("byte", "bit"):
            raise ValueError(f"planes must be byte or bit, not {planes!r}")
        if block < 1:
            raise ValueError("block must be positive")
        self.out, self.planes, self.block, self.end_id = out, planes, block, end_id
        self.compressor = zstandard.ZstdCompressor(level=level)
        self.at, self.blocks, self.waiting, self.queued = out.write(MAGIC), [], [], 0
        self.at = len(MAGIC)
        self.doc_ids: list[int | None] = []
        self.counts: list[int] = []

    def add(self, doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> None:
        self.doc_ids += doc_ids
        self.counts += counts.tolist()
        self.waiting.append(ids)
        self.queued += len(ids)
        if self.queued >= self.block:
            ids = np.concatenate(self.waiting)
            whole = len(ids) // self.block * self.block
            for i in range(0, whole, self.block):
                self._block(ids[i : i + self.block])
            self.waiting, self.queued = [ids[whole:]], len(ids) - whole

    def _block(self, ids: np.ndarray) -> None:
        lengths = []
        for plane in to_planes(ids, self.planes):
            data = self.compressor.compress(plane) if plane.strip(b"\0") else b""
            self.out.write(data)
            lengths.append(len(data))
        self.blocks.append([self.at, len(ids), lengths])
        self.at += sum(lengths)

    def close(self) -> None:
        if self.queued:
            self._block(np.concatenate(self.waiting))
        null = np.array([x is None for x in self.doc_ids], np.uint8)
        index = {
            "planes": self.planes,
            "block": self.block,
            "end_id": self.end_id,
            "blocks": self.blocks,
            "doc_ids": _packed(np.array([x or 0 for x in self.doc_ids], "<i8")),
            "null_ids": _packed(null),
            "counts": _packed(np.array(self.counts, "<i8")),
        }
        data = self.compressor.compress(json.dumps(index).encode())
        self.out.write(data + struct.pack("<Q", len(data)) + MAGIC)


class TokenReader:
    """Reads a file that TokenWriter wrote, by its index."""

    def __init__(self, source):
        self.source = source
        end = source.size()
        tail = self._bytes(end - 16, 16) if end >= 24 else b""
        if tail[8:] != MAGIC:
            raise ValueError("not a token file, or cut short")
        (n,) = struct.unpack("<Q", tail[:8])
        index = json.loads(zstandard.decompress(self._bytes(end - 16 - n, n)))
        self.planes, self.block, self.blocks = index["planes"], index["block"], index["blocks"]
        self.counts = _unpacked(index["counts"], "<i8")
        null = _unpacked(index["null_ids"], "u1")
        self.doc_ids = [None if z else x for x, z in zip(_unpacked(index["doc_ids"], "<i8").tolist(), null.tolist(), strict=True)]
        self.starts = np.zeros(len(self.counts) + 1, np.int64)
        np.cumsum(self.counts, out=self.starts[1:])

    def _bytes(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def _read_block(self, k: int) -> np.ndarray:
        at, n, lengths = self.blocks[k]
        data = self._bytes(at, sum(lengths))
        size, parts, i = (n if self.planes == "byte" else (n + 7) // 8), [], 0
        for length in lengths:
            parts.append(zstandard.decompress(data[i : i + length], max_output_size=size) if length else b"")
            i += length
        return from_planes(parts, n, self.planes)

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop of the file, from the blocks that hold them."""
        if stop <= start:
            return np.zeros(0, "<u4")
        first, last = start // self.block, (stop - 1) // self.block
        ids = np.concatenate([self._read_block(k) for k in range(first, last + 1)])
        return ids[start - first * self.block : stop - first * self.block]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start in the file, ids), block by block."""
        held, base, k = np.zeros(0, "<u4"), 0, 0
        for doc_id, start, stop in zip(self.doc_ids, self.starts[:-1].tolist(), self.starts[1:].tolist(), strict=True):
            parts = [held]
            have = base + len(held)
            while have < stop:
                parts.append(self._read_block(k))
                have += len(parts[-1])
                k += 1
            if len(parts) > 1:
                held = np.concatenate([parts[0][start - base :], *parts[1:]])
                base = start
            yield doc_id, start, held[start - base : stop - base]


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    folder: str,
    end_id: int = 1,
    planes: str = "byte",
    block: int = BLOCK,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> list[tuple[str, int]]:
    """Encode every text and write the ids to files in ``folder``, ascending in
    id over the files' order.  Returns (file, ids in it) for each file; there
    is one for each partition that has rows.

    A null text is empty: the end id alone.  Null document ids come first.
    Rows of one id follow each other in the order of their texts' hashes.
    """

    def write(batches):
        part = TaskContext.get().partitionId()
        batch = next((b for b in batches if b.num_rows), None)
        if batch is None:
            return
        encoder, total, name = word_encoder(tokenizer), 0, f"ids-{part:06d}.fwt"
        with task_file(folder, name) as out:
            writer = TokenWriter(out, planes, block, end_id=end_id)
            while batch is not None:
                rows = batch.column(0).to_pylist()
                for low, offsets, ids in encoder.encode(batch.column(1)):
                    n = len(offsets) - 1
                    ids = np.insert(ids.astype("<u4"), offsets[1:], end_id)
                    writer.add(rows[low : low + n], np.diff(offsets) + 1, ids)
                    total += len(ids)
                batch = next(batches, None)
            writer.close()
        yield pa.RecordBatch.from_pydict({"part": [part], "file": [f"{folder}/{name}"], "n": [total]})

    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    key = F.xxhash64("t")
    made = rows.repartitionByRange("i", key).sortWithinPartitions("i", key).mapInArrow(tidy(write, encodes=True), "part long, file string, n long").collect()
    return [(x["file"], x["n"]) for x in sorted(made)]


def read_token_files(spark, files: list[tuple[str, int]]) -> DataFrame:
    """One row per document of the files, in turn: doc_id, start (ids in all
    files before it), n_tokens, ids_crc32 (of the ids as little-endian
    unsigned 32-bit integers).  Each file is read by one task, block by block."""
    starts = np.concatenate([[0], np.cumsum([n for _, n in files])]).astype(int).tolist()
    names = [f for f, _ in files]

    def read(batches):
        for batch in batches:
            for k in batch.column(0).to_pylist():
                system, path = filesystem(names[k])
                with system.open_input_file(path) as source:
                    out: list[tuple] = []
                    for doc_id, start, ids in TokenReader(source).documents():
                        out.append((doc_id, starts[k] + start, len(ids), zlib.crc32(ids.tobytes())))
                        if len(out) == 50_000:
                            yield _rows(out)
                            out = []
                    if out:
                        yield _rows(out)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not files:
        return spark.createDataFrame([], schema)
    return spark.range(0, len(files), 1, len(files)).mapInArrow(tidy(read), schema)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ("doc_id", "start", "n_tokens", "ids_crc32")
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names=list(names))


def token_id_files(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write the files to the shared folder and read them back."""
    spark = docs.sparkSession
    return read_token_files(spark, write_token_files(docs, tokenizer, work_path(spark, "tokens"), **options))
