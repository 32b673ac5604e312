"""From raw documents to encoded ones: five stages, each a table for the next.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but
the last return the columns of documents; the last returns the encoding of what is left.
"""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import decontaminate, lines, pieces, quality, simhash
from clickloom.llm.common import ship, table
from clickloom.llm.queries import tokenizer
from clickloom.session import configure, store


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines go from all documents but the first that has them."""
    return lines.dedup_lines(docs).drop("_lines")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_one(docs, size=4, radius=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of the benchmark go."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number and digest of the ids, digest of the decoded text."""
    done = pieces.encode_digest(F.col("text"), tokenizer("piece_bpe_32k.model"))
    return docs.select("doc_id", done.alias("e")).select("doc_id", "e.*")


def _ready(stage):
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(configure(spark))
        return stage(spark, docs, sf_dir)

    return run


STAGES = [
    (stage.__name__, _ready(stage)) for stage in (quality_rules, line_dedup, near_duplicates, decontamination, encoding)
]

#: SQL has neither the covariance estimates, nor the chunks, nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
