"""A training corpus from documents: five stages, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from staylens.llm import decontaminate, jaccard, pieces, pu_quality, secrets, words
from staylens.llm.components import stored
from staylens.session import configure, scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    configure(spark)
    path = scratch_path(spark, "quality-features")
    pu_quality.featured(docs).write.parquet(path)
    model = pu_quality.learn(spark.read.parquet(path), words.documents(spark, sf_dir, "labels"))
    return pu_quality.good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shingle Jaccard links connect: that of the smallest key."""
    configure(spark)
    return jaccard.one_of_each(spark, docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with a benchmark item."""
    configure(spark)
    return decontaminate.uncontaminated(spark, docs, words.documents(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret of the text replaced by a mark."""
    return secrets.masked(spark, docs, scratch_path(spark, "secret-ledger"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document."""
    configure(spark)
    return pieces.encode(spark, docs)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("SentencePiece encoding", encoding),
]

#: SQL cannot express the learned classifier or the lattice; the operators of the stages have plain versions in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = words.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), "stage-" + name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
