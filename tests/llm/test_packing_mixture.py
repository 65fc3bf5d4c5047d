import pytest
from pyspark.sql import functions as F

from framewright.llm import packing
from framewright.llm.queries import tokenizer_path


@pytest.mark.parametrize("clustering", ["written by source", "one long run"])
def test_windows_of_a_table_clustered_by_source(spark, clustering, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 200, raising=False)  # several groups of this small table
    docs = spark.range(6000).selectExpr("id as doc_id", "case when id < 3000 then 'a' when id < 4500 then 'b' when id < 5400 then 'c' else 'd' end as source")
    docs = docs.withColumn("text", F.expr("repeat('some words of it ', cast(3 + pmod(xxhash64(doc_id), 12) as int))"))
    parts = 1 if clustering == "one long run" else 16
    rows = packing.packed(docs.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id"), tokenizer_path(), window=256).collect()
    total, by = {}, {}
    for r in rows:
        total[r.source] = total.get(r.source, 0) + r.length
        by.setdefault(r.sequence_id, {}).setdefault(r.source, 0)
        by[r.sequence_id][r.source] += r.length
    whole = sum(total.values())
    off = [max(abs(got.get(s, 0) / sum(got.values()) - n / whole) for s, n in total.items()) for got in by.values()]
    met = sum(x < 0.02 for x in off) / len(off)
    print(clustering, len(off), "windows, met in", round(met, 3))
    assert len(rows) >= 6000 and len(off) > 500 and met > 0.9
