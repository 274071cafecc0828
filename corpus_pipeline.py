"""The corpus pipeline: quality, language, near duplicates, decontamination and piece ids, each stage over all that its predecessor kept.

Every stage but the last gives rows of its input whole, with all their columns, whatever their names and types. Rows are told
apart by a key of their own where doc_ids are null or repeated. Empty tables give empty ones. Null and empty texts have a
quality score like any; they go with the texts in no known language, as nothing in them can be judged.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm import decontamination, jaccard, languages, pieces, quality
from orrery.llm.common import table, unused, written


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the quality classifier scores 0.3 or more; rows of equal texts all stay or none."""
    model, column = quality.train(docs, table(spark, sf_dir, "labels")), unused(docs.columns, "quality score")
    return quality.score(docs, model, column).filter(F.col(f"`{column}`") >= quality.THRESHOLD).drop(column)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents with letters whose language is known with a posterior of one half or more; a null lang or source is no evidence."""
    docs, key = jaccard.keyed(spark, docs)
    rows = jaccard.by_key(docs, key)
    return jaccard.without(docs, written(spark, languages.rejected(rows, rows), "language-rejected"), key)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each component of near duplicates (five words, similarity of 0.8 or more) one row, of least doc_id; of rows that
    tie, that of the least digest of its text. Rows without words stay."""
    return jaccard.one_of_each(spark, docs, 5, 80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that hold no benchmark item within its error budget; null texts hold none."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document left: a row for each row, a null doc_id stays, a null text has no ids."""
    return pieces.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=True, remembered=48 << 20, kept=4 << 20)


STAGES = [
    ("quality classifier", good),
    ("language ID", known_language),
    ("n-gram Jaccard join", distinct),
    ("benchmark decontamination", decontaminated),
    ("SentencePiece encoding and decoding", encoded),
]

#: Stages with trained models and searches over edit distances aren't expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other on the documents, each one's result written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
