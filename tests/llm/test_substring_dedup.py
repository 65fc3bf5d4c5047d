import hashlib
import re

from framewright.llm.substring_dedup import deduplicated, doubled

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    least = {}
    for i, w in words:
        for k in range(len(w) - window + 1) if i is not None else ():
            key = tuple(w[k : k + window])
            least[key] = min(least.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - window + 1) if i is not None else ():
            if least[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = sorted(map(tuple, deduplicated(docs).collect()), key=repr)
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], 13)


def test_edge_cases(spark):
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(1, long), (2, "x " + long + "\ty"), (2, "x " + long + "\ty"), (3, None), (4, ""), (None, long), (5, "a b"), (6, "a b"), (7, long), (8, "w1 w2 " * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as d", "2 as t")
    assert sorted(map(tuple, deduplicated(docs, 5).collect()), key=repr) == brute(rows, 5)
    assert deduplicated(docs.limit(0), 5).count() == 0


def test_doubling_ends(spark):
    long = [f"w{i}" for i in range(50)]
    rows = [(1, " ".join(long)), (2, "q " + " ".join(long[5:30])), (3, "nothing else here")]
    assert {r.doc_id: r.longest for r in doubled(spark.createDataFrame(rows, "doc_id long, text string"), 5).collect()} == {1: 20, 2: 20}


def test_one_id_with_a_copied_and_a_unique_text(spark):
    long = " ".join(f"w{i}" for i in range(40))
    own = " ".join(f"v{i}" for i in range(40))
    rows = [(1, long), (2, long), (2, own), (3, own + " z"), (4, "w3 " + own)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, deduplicated(docs, 5).collect()), key=repr) == brute(rows, 5)


def test_doubling_goes_on_until_nothing_survives(spark):
    text = " ".join(f"w{i}" for i in range(1 << 18))
    rows = [(1, text), (2, text + " x")]
    got = doubled(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert {r.doc_id: r.longest for r in got} == {1: 1 << 18, 2: 1 << 18}
