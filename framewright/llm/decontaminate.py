"""Benchmark decontamination by latent semantic retrieval.

Words are hashed into 2**BITS buckets.  Document frequencies come from all
documents.  A distributed randomised SVD of TF-IDF passages (Gaussian sketch,
then one subspace iteration) gives RANK latent directions; it is fitted on all
documents and all items of the benchmark, from a table of the words' buckets.
Passages begin at multiples of 8 words.  An item's passages are compared with
it by cosine, at its own length and at half of it; those of COSINE and more are
candidates.  They are verified on their words and 8 on either side: the longest
common subsequence with the item, and the item's answer, its last words.

Only passages are projected that hold as many of an item's rarest words as the
rules on its words in common order take at least; an index of these words finds
them, and that loses nothing.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm._shared import forget, stored, tidy, trim
from framewright.llm._text import Words, mix, words_of
from framewright.llm._tokens import HashIndex

BITS = 15
SIZE = 1 << BITS
RANK = 64
LEAD = 8  # leading directions left out: they tell languages and common words apart
SKETCH = 80
PASSAGE = 32
FIT_BYTES = 64 << 20  # of the words' buckets, in about one task that fits
UNIT = 4  # words; passages begin and end at its multiples
COSINE = 0.25  # least of a candidate; 0.999 of what the rules below accept has more
SHARE = 0.7  # of an item's words in common order
LOOSE_SHARE = 0.5  # enough if the answer is there
ANSWER = 6  # words
ANSWER_SHARE = 0.8
ITEM_BYTES = 2 << 20  # of benchmark items in memory at once
HITS = 0.45  # of the words that contamination takes, those sought among an item's rarest
MAYBE = 18  # bits of a word's hash that are looked up first
CANDIDATES = 100_000  # verified at once
SLOTS = 16

_MARK = np.ones(256, bool)
_MARK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def stems(words: Words) -> np.ndarray:
    """Hashes of the words, lower-cased (A-Z), without marks at either end."""
    raw, start, end = words.data, words.start.copy(), words.end.copy()
    for _ in range(3):
        cut = (end - start > 1) & _MARK[raw[end - 1]]
        end[cut] -= 1
        cut = (end - start > 1) & _MARK[raw[start]]
        start[cut] += 1
    return words.span_hash(start, end)


def buckets(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes, hashes) >> np.uint64(64 - BITS)).astype(np.int64)


def _summed(parts: DataFrame, dtype: str) -> np.ndarray:
    """Sum of all tasks' arrays, which come as SLOTS pieces (slot, v)."""

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                x = np.frombuffer(v.as_buffer(), dtype)
                total[slot] = total[slot] + x if slot in total else x.copy()
        if total:
            yield pa.RecordBatch.from_pydict({"slot": list(total), "v": [x.tobytes() for x in total.values()]})

    rows = parts.repartition(SLOTS, "slot").mapInArrow(tidy(add), "slot long, v binary").collect()
    pieces = {r["slot"]: np.frombuffer(bytes(r["v"]), dtype) for r in rows}
    return np.concatenate([pieces[k] for k in sorted(pieces)]) if pieces else np.zeros(0, dtype)


def _slots(total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(range(SLOTS), pa.int64()), pa.array([x.tobytes() for x in np.split(total, SLOTS)], pa.binary())], names=["slot", "v"])


def coded(texts: DataFrame, name: str) -> DataFrame:
    """(at, first) of texts (t), a row for some whole texts: their words' buckets
    and where each text's begin, as 16-bit and 32-bit integers."""

    def run(batches):
        for batch in batches:
            for words in words_of(batch.column(0), lower=True):
                if len(words.start):
                    yield pa.RecordBatch.from_pydict({"at": [buckets(stems(words)).astype("<u2").tobytes()], "first": [words.first.astype("<i4").tobytes()]})

    return stored(texts.mapInArrow(tidy(run), "at binary, first binary"), name)


def _arrays(batch: pa.RecordBatch):
    """The arrays (at, first) of each row."""
    for at, first in zip(batch.column(0), batch.column(1), strict=True):
        yield np.frombuffer(at.as_buffer(), "<u2"), np.frombuffer(first.as_buffer(), "<i4")


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """Documents that hold each bucket, over all coded texts."""

    def run(batches):
        total = np.zeros(SIZE, np.int64)
        for batch in batches:
            for at, first in _arrays(batch):
                flat = pd.unique(np.repeat(np.arange(len(first) - 1), np.diff(first)) << BITS | at)
                total += np.bincount(flat & (SIZE - 1), minlength=SIZE)
        yield _slots(total)

    found = _summed(texts.mapInArrow(tidy(run), "slot long, v binary"), "<i8")
    return found if len(found) else np.zeros(SIZE, np.int64)


def _lefts(at: np.ndarray, first: np.ndarray | None, weighed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(left, passage): each passage's sum of the rows ``weighed``, at length 1,
    and the passage of each word: PASSAGE words each, or as ``first`` says."""
    if first is not None:
        cuts = np.unique(first[:-1][np.diff(first) > 0])
        passage = np.repeat(np.arange(len(cuts)), np.diff(np.append(cuts, len(at))))
        left = np.add.reduceat(weighed[at], cuts, axis=0)
    else:
        passage = np.arange(len(at)) // PASSAGE
        left = np.zeros((passage[-1] + 1, weighed.shape[1]), np.float32)
        full, step, one = len(at) // PASSAGE, 32, np.ones((1, PASSAGE), np.float32)
        held = np.empty((step * PASSAGE, weighed.shape[1]), np.float32)
        for low in range(0, full, step):
            some = at[low * PASSAGE : min(low + step, full) * PASSAGE]
            np.take(weighed, some, axis=0, out=held[: len(some)], mode="clip")
            left[low : low + len(some) // PASSAGE] = np.matmul(one, held[: len(some)].reshape(-1, PASSAGE, weighed.shape[1]))[:, 0]
        if full * PASSAGE < len(at):
            left[full] = weighed[at[full * PASSAGE :]].sum(0)
    left /= np.maximum(np.sqrt(np.einsum("ij,ij->i", left, left)), 1e-6)[:, None]
    return left, passage


def _sketch(at: np.ndarray, first: np.ndarray | None, weighed: np.ndarray, total: np.ndarray) -> None:
    """Adds to each bucket of ``total`` its words' passages, from ``_lefts``."""
    left, passage = _lefts(at, first, weighed)
    order = np.argsort(at, kind="stable")
    at, passage = at[order], passage[order]
    new = np.diff(at.astype(np.int32), prepend=-1) != 0
    step = 512
    held = np.empty((step, left.shape[1]), np.float32)
    for low in range(0, len(at), step):
        part = passage[low : low + step]
        np.take(left, part, axis=0, out=held[: len(part)], mode="clip")
        cuts = np.flatnonzero(new[low : low + step])
        if not len(cuts) or cuts[0]:
            cuts = np.append(0, cuts)
        total[at[low + cuts]] += np.add.reduceat(held[: len(part)], cuts, axis=0)


def latent(texts: DataFrame, items: DataFrame, idf: np.ndarray, size: int) -> np.ndarray:
    """(SIZE, RANK): right singular vectors of the TF-IDF passages of the texts
    and of the items, a passage each, both coded; size: bytes of the texts'
    buckets, about."""
    tasks = max(texts.sparkSession.sparkContext.defaultParallelism, size // FIT_BYTES)
    rows = texts.select("at", F.lit(None).cast("binary").alias("first")).coalesce(tasks).union(items)
    right = np.random.default_rng(11).standard_normal((SIZE, SKETCH)).astype(np.float32)
    for _ in range(2):

        def run(batches, weighed=right * idf[:, None]):
            total = np.zeros((SIZE, SKETCH), np.float32)
            for batch in batches:
                for at, first in zip(batch.column(0), batch.column(1), strict=True):
                    _sketch(np.frombuffer(at.as_buffer(), "<u2"), np.frombuffer(first.as_buffer(), "<i4") if first.is_valid else None, weighed, total)
            yield _slots((total * idf[:, None]).ravel())

        total = _summed(rows.mapInArrow(tidy(run), "slot long, v binary"), "<f4").reshape(-1, SKETCH).copy()
        if not len(total):
            total = np.zeros((SIZE, SKETCH), np.float32)
        right = np.linalg.qr(total)[0].astype(np.float32)
    return np.ascontiguousarray(np.linalg.svd(total, full_matrices=False)[0][:, LEAD : LEAD + RANK], np.float32)


def common(a: dict[int, int], n: int, b: list[int]) -> int:
    """Length of the longest common subsequence; a: value -> bits where it is
    among n."""
    v = full = (1 << n) - 1
    for x in b:
        if m := a.get(x):
            u = v & m
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


class Item:
    def __init__(self, item_id: int | None, hashes: np.ndarray):
        self.id, self.n, self.hashes = item_id, len(hashes), hashes
        values = hashes.tolist()
        self.bits = self._bits(values)
        tail = values[-ANSWER:]
        self.answer, self.answer_n = self._bits(tail), len(tail)
        self.set = frozenset(values)
        self.scale = -(-self.n // (2 * UNIT)) * 2 * UNIT

    @staticmethod
    def _bits(values: list[int]) -> dict[int, int]:
        out: dict[int, int] = {}
        for i, x in enumerate(values):
            out[x] = out.get(x, 0) | 1 << i
        return out

    def verdict(self, region: list[int]) -> tuple[float, float] | None:
        """(share of the words, share of the answer) if it is contamination."""
        if sum(x in self.set for x in region) < LOOSE_SHARE * self.n:
            return None
        share = common(self.bits, self.n, region) / self.n
        answer = common(self.answer, self.answer_n, region) / self.answer_n
        if share >= SHARE or share >= LOOSE_SHARE and answer >= ANSWER_SHARE:
            return share, answer
        return None


def _items(benchmark: DataFrame) -> list[Item]:
    """The items of some rows (i, t); equal rows count once."""
    rows = benchmark.where("t is not null").dropDuplicates().orderBy("i", "t").collect()
    out = []
    for row in rows:
        for words in words_of(pa.array([row["t"]]), lower=True):
            if len(words.start):
                out.append(Item(row["i"], stems(words)))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, sample_docs: int | None = None, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, cosine, lcs, answer): the documents that hold a
    benchmark item, each with its best figures for it.

    Null and empty texts and items match nothing.  Rows with a null id are
    found like others, under a null doc_id; repeated rows give one row, with the
    best figures of any of them.  The benchmark is searched in blocks of about
    ITEM_BYTES of text, so what a task holds of it is bounded; each block reads
    the documents once.  All share one set of latent directions, fitted on all
    items, so the blocks don't change what is found.  ``sample_docs``: fit on
    about so many documents, drawn by id and text, instead of all.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"))
    schema = "doc_id long, item_id long, cosine double, lcs double, answer double"
    out = docs.sparkSession.createDataFrame([], schema)
    for find in _searches(rows, benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(item_text_col).alias("t")), cosine, sample_docs):
        out = out.union(rows.mapInArrow(tidy(_hits(find)), schema))
    return out.groupBy("doc_id", "item_id").agg(*[F.max(c).alias(c) for c in ("cosine", "lcs", "answer")])


def decontaminated(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, sample_docs: int | None = None, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows and columns of docs without the rows that hold an item, each
    row by its own text, whatever its id.  No shuffle of the documents."""
    rows = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"))
    place = docs.columns.index(text_col)
    for find in _searches(rows, benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(item_text_col).alias("t")), cosine, sample_docs):

        def clean(batches, find=find):
            for batch in batches:
                hit = {row for row, _ in find(batch.column(place))}
                yield batch.filter(pa.array([i not in hit for i in range(batch.num_rows)], pa.bool_())) if hit else batch

        docs = docs.mapInArrow(tidy(clean), docs.schema)
    return docs


def _searches(rows: DataFrame, benchmark: DataFrame, cosine: float, sample_docs: int | None) -> list:
    """For each block of the benchmark (i, t) a function that searches texts;
    rows: (i, t) of the documents."""
    size = benchmark.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = rows.count()
    if not n or not size:
        return []
    texts, whole = coded(rows.select("t"), "buckets"), coded(benchmark.select("t").where("t is not null").distinct(), "items")
    df = document_frequencies(texts)
    idf = np.log((n + 1) / (df + 0.5)).clip(0.05).astype(np.float32)
    if sample_docs is not None and n > sample_docs:
        forget(rows.sparkSession, texts)
        texts = coded(rows.where(F.pmod(F.xxhash64(F.lit(3), "i", "t"), F.lit(1_000_003)) < int(1_000_003 * sample_docs / n)).select("t"), "buckets")
    vectors = latent(texts, whole, idf, texts.agg(F.sum(F.octet_length("at"))).first()[0] or 0)
    forget(rows.sparkSession, texts, whole)
    vectors = (vectors * idf[:, None]).astype(np.float32)
    blocks = -(-size // ITEM_BYTES)
    part = F.pmod(F.xxhash64("i", "t"), F.lit(blocks))
    trim()
    found = (_items(benchmark.where(part == k) if blocks > 1 else benchmark) for k in range(blocks))
    return [_search(items, vectors, df, cosine) for items in found if items]


class Index:
    """Items whose words are looked up together, in arrays.

    Contamination takes ``least`` of an item's n words in a passage, so it takes
    at least ``hits`` of its n - least + hits rarest words: these are its
    signature, by which passages are found.  ``place`` and ``bits`` give for a
    word and an item where it stands among the item's words; items of more than
    64 words are verified one by one."""

    def __init__(self, items: list[Item], vectors: np.ndarray, df: np.ndarray):
        self.items = items
        self.n = np.array([x.n for x in items])
        self.wide = np.array([x.scale for x in items])
        self.own = -(-self.n // UNIT)
        self.answer_n = np.array([x.answer_n for x in items])
        self.least = np.ceil(LOOSE_SHARE * self.n - 1e-9).astype(np.int64)
        self.strict = np.ceil(SHARE * self.n - 1e-9).astype(np.int64)
        self.answer = np.ceil(ANSWER_SHARE * self.answer_n - 1e-9).astype(np.int64)
        self.hits = np.maximum(1, (self.least * HITS).astype(np.int64))
        words, holders, keys, bits = [], [], [], []
        for k, x in enumerate(items):
            rare = np.argsort(df[buckets(x.hashes)], kind="stable")[: x.n - self.least[k] + self.hits[k]]
            own = np.unique(x.hashes[rare])
            words.append(own)
            holders.append(np.full(len(own), k, np.int32))
            at = x.bits if x.n <= 64 else {}
            keys.append(_item_key(np.array(list(at), np.uint64), np.uint64(k)))
            bits.append(np.array(list(at.values()), np.uint64))
        word, holder = np.concatenate(words), np.concatenate(holders)
        order = np.argsort(word, kind="stable")
        self.word, first = np.unique(word[order], return_index=True)
        self.first, self.holder = np.append(first, len(word)), holder[order]
        self.maybe = np.zeros(1 << MAYBE, bool)
        self.maybe[self.word & np.uint64((1 << MAYBE) - 1)] = True
        keys = np.concatenate(keys)
        self.place = HashIndex()
        self.place.add(keys, np.arange(1, len(keys) + 1, dtype=np.int32))
        self.bits = np.concatenate([np.zeros(1, np.uint64), *bits])
        wanted = np.array([vectors[buckets(x.hashes)].sum(0) for x in items])
        self.wanted = (wanted / np.maximum(np.linalg.norm(wanted, axis=1, keepdims=True), 1e-9)).astype(np.float32)

    def passages(self, hashes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(block, item, row) of all passages that, with 2 blocks on either
        side, hold enough words of the item's signature in the row."""
        at = np.flatnonzero(self.maybe[hashes & np.uint64((1 << MAYBE) - 1)])
        place = np.minimum(np.searchsorted(self.word, hashes[at]), len(self.word) - 1)
        same = self.word[place] == hashes[at]
        at, place = at[same], place[same]
        many = self.first[place + 1] - self.first[place]
        k = self.holder[np.repeat(self.first[place] - np.cumsum(many) + many, many) + np.arange(many.sum())]
        at = np.repeat(at, many)
        order = np.argsort(k, kind="stable")  # by item, then by place
        k, at = k[order].astype(np.int64), at[order]
        last = np.arange(len(k)) + self.hits[k] - 1
        some = np.flatnonzero(last < len(k))
        last = last[some]
        held = (k[last] == k[some]) & (row[at[last]] == row[at[some]]) & (at[last] - at[some] < self.wide[k[some]] + 4 * UNIT)
        some, last = some[held], last[held]
        k, begin, end = k[some], at[some], at[last]
        low = np.maximum(0, -((self.wide[k] + 2 * UNIT - 1 - end) // (2 * UNIT)))
        many = (begin + 2 * UNIT) // (2 * UNIT) - low + 1
        p = 2 * (np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum()))
        k, row = np.repeat(k, many), np.repeat(row[begin], many)
        if not len(p):
            return p, k, row
        flat = np.unique((row.astype(np.int64) * len(self.items) + k) * (p.max() + 1) + p)
        flat, p = np.divmod(flat, p.max() + 1)
        row, k = np.divmod(flat, len(self.items))
        return p, k, row

    def in_order(self, hashes: np.ndarray, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The longest common subsequences of words [low, high) with the items,
        and with their answers, as in ``common``; for items of 64 words at most."""
        n, answer_n = self.n[k].astype(np.uint64), self.answer_n[k].astype(np.uint64)
        none = np.uint64(2**64 - 1)
        full, tail = none >> (np.uint64(64) - n), none >> (np.uint64(64) - answer_n)
        shift = n - answer_n
        v, w = full.copy(), tail.copy()
        names = k.astype(np.uint64)
        for j in range(int((high - low).max(initial=0))):
            on = np.flatnonzero(low + j < high)
            found = self.place.find(_item_key(hashes[low[on] + j], names[on]))
            on, found = on[found > 0], found[found > 0]
            m = self.bits[found]
            u = v[on] & m
            v[on] = ((v[on] + u) | (v[on] - u)) & full[on]
            u = w[on] & (m >> shift[on])
            w[on] = ((w[on] + u) | (w[on] - u)) & tail[on]
        return (n - np.bitwise_count(v)).astype(np.int64), (answer_n - np.bitwise_count(w)).astype(np.int64)


def _item_key(hashes: np.ndarray, items: np.ndarray) -> np.ndarray:
    return mix(hashes, np.broadcast_to(items, hashes.shape) + np.uint64(1))


def _search(items: list[Item], vectors: np.ndarray, df: np.ndarray, least: float):
    """Gives for a column of texts {(row, item id): (cosine, lcs, answer)}."""
    index = Index(items, vectors, df)

    def find(texts: pa.Array) -> dict:
        out: dict = {}
        for words in words_of(texts, lower=True):
            if len(words.start):
                _find(words, index, vectors, least, out)
        return out

    return find


def _hits(find):
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            if out := find(batch.column(1)):
                columns = list(zip(*[(ids[row], item, *figures) for (row, item), figures in out.items()], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if j < 2 else pa.float64()) for j, c in enumerate(columns)], names=["doc_id", "item_id", "cosine", "lcs", "answer"])

    return run


def _cosines(index: Index, vectors: np.ndarray, at: np.ndarray, p: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The greater cosine of an item with the passage of its own length that
    begins at block p, and with that of half its length."""
    n, blocks = len(at), -(-len(at) // UNIT)
    wide = index.own[k]
    edge = np.zeros(blocks + 2, np.int64)  # blocks of any passage
    np.add.at(edge, np.minimum(p, blocks), 1)
    np.subtract.at(edge, np.minimum(p + wide, blocks) + 1, 1)
    some = np.flatnonzero(np.cumsum(edge)[:blocks] > 0)
    slot = np.zeros(blocks + 1, np.int64)
    slot[some + 1] = 1
    slot = np.cumsum(slot)
    word = (some[:, None] * UNIT + np.arange(UNIT)).ravel()
    each = vectors[at[np.minimum(word, n - 1)]]
    each[word >= n] = 0
    total = np.zeros((len(some) + 1, RANK), np.float32)
    np.cumsum(each.reshape(-1, UNIT, RANK).sum(1), axis=0, out=total[1:])
    near = np.full(len(p), -1.0, np.float32)
    begin = total[slot[np.minimum(p, blocks)]]
    wanted = index.wanted[k]
    for w in (wide, -(-wide // 2)):
        sums = total[slot[np.minimum(p + w, blocks)]] - begin
        size = np.sqrt(np.einsum("ij,ij->i", sums, sums))
        near = np.maximum(near, np.einsum("ij,ij->i", sums, wanted) / np.maximum(size, 1e-9))
    return near


def _find(words: Words, index: Index, vectors: np.ndarray, least: float, out: dict) -> None:
    hashes = stems(words)
    at, n = buckets(hashes), len(hashes)
    found = index.passages(hashes, words.row)
    for cut in range(0, len(found[0]), CANDIDATES):
        p, k, row = (x[cut : cut + CANDIDATES] for x in found)
        near = _cosines(index, vectors, at, p, k)
        on = near >= least
        p, k, row, near = p[on], k[on], row[on], near[on]
        low = np.maximum((p - 2) * UNIT, words.first[row])
        high = np.minimum(p * UNIT + index.wide[k] + 2 * UNIT, words.first[row + 1])
        short = index.n[k] <= 64
        lcs, answer = np.zeros(len(p), np.int64), np.zeros(len(p), np.int64)
        lcs[short], answer[short] = index.in_order(hashes, low[short], high[short], k[short])
        good = (lcs >= index.strict[k]) | (lcs >= index.least[k]) & (answer >= index.answer[k])
        for j in np.flatnonzero(good | ~short).tolist():
            item = index.items[k[j]]
            figures = (lcs[j] / item.n, answer[j] / item.answer_n) if short[j] else item.verdict(hashes[low[j] : high[j]].tolist())
            if figures:
                key, figures = (int(words.low + row[j]), item.id), (float(near[j]), *map(float, figures))
                out[key] = max(out.get(key, figures), figures, key=lambda f: (f[1], f[0]))
