"""The corpus pipeline: the stages a training corpus goes through, one operator each.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read back as the next stage's ``docs``.  All stages
but the last keep the columns of their input.

1. quality classifier: documents scored below its threshold go;
2. line dedup: of equal and nearly equal lines, all but the first go; a
   document that loses all its lines stays as an empty text;
3. SimHash near-dedup (3-word shingles, 2 bits): one document of each group
   stays, the one with the smallest id;
4. benchmark decontamination: windows of 10 benchmark words are cut out;
5. best-fit packing into sequences of 1024 tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cohortkit.llm.common import materialize, table
from cohortkit.llm.decontaminate import decontaminated
from cohortkit.llm.line_dedup import line_dedup
from cohortkit.llm.packing import pack_documents
from cohortkit.llm.quality import quality_filter
from cohortkit.llm.simhash import near_dedup


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_filter(docs, table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup(docs, shingle=3, distance=2)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminated(docs, table(spark, sf_dir, "benchmark"), window=10)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, capacity=1024)


STAGES = [
    ("quality classifier", accept_quality),
    ("line dedup", drop_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", cut_benchmark),
    ("best-fit packing", pack),
]
#: learning, fuzzy matching and packing are not expressible in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
