"""From raw documents to packed training sequences, stage by stage; each stage's decisions hold for the next.

Every stage takes an empty table to an empty one, works on whole texts of any length, leaves null ids alone, and all but
the last return the columns they get, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.llm import common, decontaminate, linededup, neardup, packing, quality


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject. Each row is judged by its own text, so repeated rows go or stay
    together; null and empty texts have the bias's score, near one half, and stay. Without labels all stay."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model).where("predicted = 1").select(docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of recurring templates; n_chars, if it is there, follows the text. Null and empty
    texts stay as they are; repeated rows lose the same lines; of equal first places the least doc_id keeps the line."""
    out = linededup.deduplicate(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the least doc_id. Null, empty and wordless texts are in no
    group and stay; rows that repeat a doc_id are one document and stay together."""
    gone = neardup.near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts hold none; repeated rows go together; items without words
    are in nothing."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of all documents in sequences of power-of-two lengths; null and empty texts give the end id, repeated
    rows are packed each by itself."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_lines),
    ("near-dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Training, MinHash and tokenizers have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
