import numpy as np
import pyarrow as pa
import pytest

from framewright.llm import decontaminate as dc
from framewright.llm._text import words_of

KINDS = {
    "exact": lambda w, other, rng: w,
    "short": lambda w, other, rng: w,
    "20% substituted": lambda w, other, rng: [other() if rng.random() < 0.2 else x for x in w],
    "30% substituted, answer kept": lambda w, other, rng: [other() if rng.random() < 0.3 else x for x in w[:-6]] + w[-6:],
    "30% deleted, answer kept": lambda w, other, rng: [x for x in w[:-6] if rng.random() >= 0.3] + w[-6:],
    "40% inserted": lambda w, other, rng: [y for x in w for y in ([x, other()] if rng.random() < 0.4 else [x])],
}


def planted(spark, sf):
    """Items at random places of other documents, as (doc id, item id, kind) of
    those that brute force over all places finds."""
    rng = np.random.default_rng(9)
    docs = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect() if r.text]
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").collect() if r.text]
    hosts = [t.split() for t in docs if 40 < len(t.split()) < 400]
    vocabulary = sorted({w for t in hosts for w in t})
    benchmark, texts, wanted = [], [(i, t) for i, t in enumerate(docs)], []
    for kind, change in KINDS.items():
        for text in items:
            words = text.split()[: int(rng.integers(8, 13)) if kind == "short" else None]
            if kind == "exact" or kind == "short":
                benchmark.append((len(benchmark), " ".join(words)))
            item_id = len(benchmark) - 1 if kind == "short" else items.index(text)
            host = hosts[rng.integers(len(hosts))]
            at = int(rng.integers(len(host)))
            changed = change(words, lambda: vocabulary[rng.integers(len(vocabulary))], rng)
            doc = " ".join(host[:at] + changed + host[at:])
            item = dc.Item(item_id, dc.stems(next(words_of(pa.array([" ".join(words)])))))
            hashes = dc.stems(next(words_of(pa.array([doc])))).tolist()
            if any(item.verdict(hashes[a : a + item.scale + 16]) for a in range(max(0, at - item.scale - 16), at + len(changed) + 1)):
                wanted.append((10**6 + len(texts), item_id, kind))
            texts.append((10**6 + len(texts), doc))
    return spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(benchmark, "item_id long, text string"), wanted


@pytest.fixture(scope="module")
def plants(spark, sf):
    return planted(spark, sf)


def recall(found, wanted):
    return {kind: round(float(np.mean([(d, i) in found for d, i, k in wanted if k == kind])), 3) for kind in KINDS}


def test_recall_against_brute_force(plants):
    docs, items, wanted = plants
    found = {(r.doc_id, r.item_id) for r in dc.contaminated(docs, items).collect()}
    got = recall(found, wanted)
    print(got)
    assert min(got.values()) >= 0.97, got


def test_all_items_are_fitted(plants, spark, monkeypatch):
    docs, items, wanted = plants
    rare = [(10**6 + i, " ".join(f"rare{i}x{j}" for j in range(20))) for i in range(30)]
    items = items.union(spark.createDataFrame(rare, "item_id long, text string"))
    search, blocks = dc._search, []

    def seen(block, vectors, df, least):
        blocks.append((block, vectors))
        return search(block, vectors, df, least)

    monkeypatch.setattr(dc, "_search", seen)
    monkeypatch.setattr(dc, "ITEM_BYTES", 4_000)
    # the rare words stand in one document in many, so in no small sample
    more = spark.createDataFrame([(2 * 10**6 + i, t) for i, t in rare], "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in dc.contaminated(docs.union(more), items, sample_docs=50).collect()}
    assert len(blocks) > 2 and sum(len(b) for b, _ in blocks) == items.distinct().count()
    empty = [x.id for b, vectors in blocks for x in b if (np.linalg.norm(vectors[dc.buckets(x.hashes)], axis=1) < 1e-6).mean() > 0.5]
    assert not empty
    got = recall(found, wanted)
    assert min(got.values()) >= 0.97 and {(2 * 10**6 + i, i) for i, _ in rare} <= found, got


def test_all_documents_are_fitted(spark):
    """A direction of many documents' own words is found, whichever they are."""
    texts = [" ".join(f"u{i}x{j}" for j in range(12)) for i in range(6_000)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "an item of other words than these are")], "item_id long, text string")
    seen = {}
    search = dc._search
    try:
        dc._search = lambda block, vectors, df, least: seen.update(v=vectors) or search(block, vectors, df, least)
        dc.contaminated(docs, items)
    finally:
        dc._search = search
    held = np.zeros(dc.SIZE, bool)
    held[dc.buckets(np.concatenate([dc.stems(next(words_of(pa.array([t])))) for t in texts]))] = True
    norm = np.linalg.norm(seen["v"], axis=1)
    assert (norm[held] > 0).all()
    some = dc.coded(docs.select("text"), "buckets")
    assert sum(len(at) // 2 for (at, _) in some.collect()) == 6_000 * 12 and (dc.document_frequencies(some)[held] > 0).all()


def test_sketch_equals_plain_sums():
    rng = np.random.default_rng(3)
    at = rng.integers(0, 900, 3_011).astype(np.uint16)
    first = np.array([0, 0, 700, 700, 2_000, 3_011], np.int32)
    weighed = rng.standard_normal((dc.SIZE, 5)).astype(np.float32)
    for cut in (None, first):
        passage = np.arange(len(at)) // dc.PASSAGE if cut is None else np.repeat(np.arange(5), np.diff(first))
        left = np.zeros((passage.max() + 1, 5))
        np.add.at(left, passage, weighed[at])
        left /= np.maximum(np.linalg.norm(left, axis=1, keepdims=True), 1e-6)
        want, got = np.zeros((dc.SIZE, 5)), np.zeros((dc.SIZE, 5), np.float32)
        np.add.at(want, at, left[passage])
        dc._sketch(at, cut, weighed, got)
        assert np.allclose(want, got, atol=1e-3)
