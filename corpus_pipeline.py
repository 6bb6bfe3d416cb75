"""From raw documents to packed training sequences, in four stages.

Each stage takes the rows that its predecessor kept and returns the columns of ``documents``, the last one
the packed pieces. ``run`` writes each stage as Parquet in the shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetgauge.llm.batches import table
from fleetgauge.llm.jaccard_join import keep_one_of_each
from fleetgauge.llm.packing import pack
from fleetgauge.llm.quality_trees import fit_quality, keep_quality
from fleetgauge.llm.queries import SEQUENCE_TOKENS, vocabulary
from fleetgauge.llm.toxicity import drop_toxic, fit_toxicity
from fleetgauge.session import new_scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and that the quality trees do not reject.

    Judged row by row: NULL, empty and blank texts fail the base rule, repeated rows stay or go together, NULL ids make
    no difference. Without labels the base rule alone decides.
    """
    return keep_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the subword model does not call toxic.

    Judged row by row, as above; a text without words has the score of the bias. Without labels of both
    classes all stay.
    """
    return drop_toxic(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id.

    Rows without words are nobody's duplicates and stay, a NULL id comes last, of rows that repeat id and text one
    stays, and rows that repeat an id alone are told apart by their texts.
    """
    return keep_one_of_each(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences of a fixed number of tokens.

    A NULL or empty text is its end id; rows that repeat an id are packed each. Columns are those of ``pack``.
    """
    return pack(docs, vocabulary("byte_bpe_50k.json"), 0, SEQUENCE_TOKENS)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("packing", packing),
]

#: No SQL expresses the two trained stages; the tests hold ``run`` against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again; an empty table gives no pieces.

    Further columns of ``documents`` go along up to the last stage, whatever their names.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
