"""Documents to training sequences: quality, near-duplicates, benchmark leaks, personal data, packing.

All stages take any columns beside ``doc_id`` and ``text``, whatever their names, and all but
the last return the columns they got. A null id is kept as null; equal rows fare alike; an
empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm.common import table, written
from waybill.llm.decontaminate import decontaminated
from waybill.llm.minhash import near_duplicates_removed
from waybill.llm.packing import packed
from waybill.llm.private import private_removed
from waybill.llm.quality import quality_kept

#: No SQL says what the later stages do; the tests hold them against brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects. Null and empty texts have too few words and go; repeated rows all stay or all go."""
    return quality_kept(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, 80 % and more.

    The smallest id stays, null ids last, then the smallest text mark; rows that repeat it in id and text
    stay once. Texts without words, null ones too, are no copies and all stay.
    """
    return near_duplicates_removed(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; rows with equal texts go together, null and empty ones stay."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced; ``n_chars`` follows the text. A null text stays null."""
    clean = private_removed(docs)
    if "n_chars" not in docs.columns:
        return clean
    chars = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text"))
    return clean.withColumn("n_chars", chars.cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens. Null and empty texts are their end token; repeated rows are packed each."""
    return packed(docs, added=True)


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
