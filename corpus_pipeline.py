"""A training-data pipeline over ``documents``: five stages, each one of the llm operators.

Every stage is (spark, docs, sf_dir) -> DataFrame and works on all rows that its predecessor kept. All but
the last return the columns of ``documents``; the last adds ``piece_ids``. :func:`run` writes each
stage's result as Parquet in the shared folder and reads it again for the next.

What holds for all stages: a null text counts as empty (only the quality rules drop it), a null id or
source is a value like others, the last in order; texts of any length are worked on whole; extra columns
pass with their names and values, whatever those are; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chordgrid.llm.exact_dedup import drop_copies
from chordgrid.llm.mixing import mixed
from chordgrid.llm.ngram_join import drop_near_copies
from chordgrid.llm.quality_rules import drop_rejected
from chordgrid.llm.sentencepiece_codec import with_pieces
from chordgrid.llm.shared import work_folder, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Rows that repeat id and text stay or go together."""
    return drop_rejected(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text (white space normalised): the one with the smallest id; of rows that repeat
    id and text, the first by their other columns."""
    return drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: the one with the smallest id. Texts without a word are
    near to nothing and stay."""
    return drop_near_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, none above three times; those without words never.
    Rows that repeat id, source and size are taken together."""
    return mixed(docs)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their SentencePiece ids, none for an empty text, in ``piece_ids`` (``_piece_ids`` where
    documents have such a column)."""
    return with_pieces(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("exact_dedup", exact_stage),
    ("ngram_join", near_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", pieces_stage),
]

#: The mix draws from hypergeometric laws and the pieces come from Viterbi: SQL cannot state them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), folder, name)
    return docs
