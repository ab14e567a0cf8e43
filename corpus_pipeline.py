"""From raw documents to token ids: five stages, each an operator of ``tarmac.llm``.

Every stage takes all that its predecessor kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import decontaminate, line_dedup, ngram_join, pieces, quality, toxicity
from tarmac.llm.common import table
from tarmac.llm.queries import PIECES
from tarmac.session import materialize

#: Documents with a score of this or more are toxic.
TOXIC_FROM = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below ``TOXIC_FROM``. Labels are learned from the rows that ``op10_toxicity`` learns from."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.fit(docs.select("doc_id", "text"), labels.where(quality.fold("doc_id", 3) != 1))
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    return toxicity.score(rows, model, "row.text", keep=["row"]).where(F.col("score") < TOXIC_FROM).select("row.*")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier line; one that loses all its lines goes."""
    kept = line_dedup.drop_repeated_lines(docs)
    if "n_chars" in docs.columns:
        changed = F.length("text").cast(docs.schema["n_chars"].dataType)
        kept = kept.withColumn("n_chars", changed)
    return kept.select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, that of the least id."""
    return ngram_join.one_per_class(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids and whether these decode to the text."""
    return pieces.encode(docs, PIECES, with_decoded=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("ngram_jaccard_join", one_of_each),
    ("benchmark_decontamination", drop_leaks),
    ("sentencepiece", encode),
]

#: The stages fit models and verify edits, which SQL cannot state; tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written to the shared folder for the next one."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
