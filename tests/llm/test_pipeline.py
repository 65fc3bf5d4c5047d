import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from framewright.llm import decontaminate, near_copies

LONG = " ".join(f"w{i}" for i in range(60))
ITEM = "what is the least number of eggs that fit into a basket of three litres if each one is as large as the last"
ROWS = [
    (1, LONG, "en", "a", 7),
    (2, LONG, "en", "a", 7),
    (None, LONG, None, None, None),
    (3, None, "en", "a", 0),
    (4, "", "en", None, 0),
    (5, "x " + ITEM + " and more of it", "en", "b", 1),
    (None, "y " + ITEM, "en", "b", 1),
    (5, "something else that stands for itself, and is clean", "en", "b", 1),
    (6, "call +1 (532) 555-7801 now", "en", "b", 1),
    (6, "call +1 (532) 555-7801 now", "en", "b", 1),
    (7, "long " * 30_000, "en", "b", 1),
]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder with documents of odd rows and extra columns with names that
    the operators use themselves, and the two side tables."""
    root = str(tmp_path_factory.mktemp("odd"))
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.selectExpr("*", "'x' as d", "1 as t", "2 as i", "3 as node", "4 as g", "5 as h", "true as keep")
    docs.write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (1, ITEM), (2, None), (None, "")], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0), (1, 1, 0), (None, 1, 0), (4, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_columns_and_odd_rows(spark, tables, name):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    got = dict(corpus_pipeline.STAGES)[name](spark, docs, tables)
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    n = got.count()
    assert n <= len(ROWS) if name != "personal_data" else n == len(ROWS)
    assert dict(corpus_pipeline.STAGES)[name](spark, docs.limit(0), tables).count() == 0


def test_each_row_goes_by_its_own_text(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    clean = decontaminate.decontaminated(docs, spark.read.parquet(f"{tables}/benchmark.parquet"))
    assert clean.where(F.col("text").contains("least number of eggs")).count() == 0 and clean.count() == len(ROWS) - 2
    kept = near_copies.representatives(docs)
    rows = sorted(((r.doc_id is None, r.doc_id or 0, (r.text or "")[:9]) for r in kept.collect()))
    assert [(x[1], x[2]) for x in rows if not x[0]] == [(1, LONG[:9]), (3, ""), (5, "something"), (5, "x what is"), (6, "call +1 ("), (7, "long long")]
    assert {x[2] for x in rows if x[0]} <= {"y what is"}


def test_run(spark, tables, sf):
    rows = corpus_pipeline.run(spark, tables).collect()
    ids = {}
    for r in rows:
        ids.setdefault((r.doc_id, r.doc_tokens), 0)
        ids[r.doc_id, r.doc_tokens] += r.length
    assert rows and all(n % tokens == 0 for (_, tokens), n in ids.items())
    by: dict = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))
