"""The training-data pipeline: documents through four of the operators, stage by stage.

Each stage gets what the one before it kept, as a table, and returns the columns
of ``documents``; the last one returns what a trainer reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadbook.llm import mixing, sentencepiece_codec, simhash, toxicity
from roadbook.llm.common import Scratch, table
from roadbook.llm.queries import PIECES, piece_digests


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not call toxic."""
    chain, _ = toxicity.train(docs, table(spark, sf_dir, "labels"), toxicity.categories())
    scored = toxicity.score(docs, chain, keep=docs.columns)
    verdict = scored.columns[-1]  # the chain ends with the toxic category
    return scored.where(~F.col(verdict)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    return simhash.deduplicate(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in its order."""
    return mixing.mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document of the mix, with the digests to check them by."""
    coded = sentencepiece_codec.encode_decode(docs, sentencepiece_codec.read_model(PIECES))
    return piece_digests(coded, "ids")


STAGES = [
    ("toxicity", reject_toxic),
    ("SimHash near-dedup", drop_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode_pieces),
]
# The first stage fits a model, which SQL cannot: tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        docs = scratch.keep(made) if number < len(STAGES) - 1 else made
    return docs
