"""A corpus pipeline over ``documents``: quality, near-duplicates, benchmark
passages, personal data, packing.  Each stage takes (spark, docs, sf_dir); all
but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm import decontaminate, near_copies, packing, pii, quality
from framewright.llm._shared import forget, prepared, stored
from framewright.llm.queries import tokenizer_path

#: SQL can express neither a trained model nor a tokenizer.
ORACLE_SQL = None


def _begin(spark: SparkSession) -> None:
    """The stage before is written, so what it stored for itself can go."""
    prepared(spark)
    forget(spark)


def _side(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier takes as low quality or toxic
    go; null and empty texts are judged as texts without words."""
    _begin(spark)
    model = quality.trained(docs, _side(spark, sf_dir, "labels"))
    return quality.scored(docs, model).where("keep").select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row stays, of the least document id.
    Candidates are op8's, SimHashes within three bits by Golay keys, and more by
    MinHash; links are those of five-word similarity 0.8 or more.  Texts without words, null ones
    too, are one group; so are rows that repeat an id and a text."""
    _begin(spark)
    return near_copies.representatives(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark item go, each by its own text."""
    _begin(spark)
    return decontaminate.decontaminated(docs, _side(spark, sf_dir, "benchmark"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts give way to their kinds, in brackets; a null
    text stays null."""
    _begin(spark)
    clean = pii.without_personal_data(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences in the corpus's own mixture of sources; a
    null text is its end id alone, a null source a source of its own."""
    _begin(spark)
    return packing.packed(docs, tokenizer_path())


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("benchmark", benchmark_stage),
    ("personal_data", personal_data_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again; what a stage
    has written goes when the next one is."""
    docs, written = _side(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        table = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            table = stored(table, f"stage-{name}", kept=True)
        if written is not None:
            forget(spark, written)
        docs = written = table
    return table
