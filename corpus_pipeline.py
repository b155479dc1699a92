"""Corpus pipeline: what a training corpus goes through, stage by stage, each by one operator.

Every stage takes (spark, docs, sf_dir) and returns the documents it keeps, with their
columns; the last one returns the encoded documents. Models are fitted on the stage's own
input, from bounded samples of labelled rows (see the operators).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lidarlattice.llm import decontaminate, language_id, quality, sentencepiece_codec, simhash
from lidarlattice.llm._common import cut, held_out, table

#: Least part of the bits of a text's own n-grams that the winning language must have, whatever the number of languages.
LANGUAGE_SCORE = 0.28


def _packed(docs: DataFrame) -> DataFrame:
    """The text beside all other columns as one, so that no name clashes with what a model appends."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("doc"), "text")


def _unpacked(kept: DataFrame, columns: list[str]) -> DataFrame:
    return kept.select(*[F.col("text") if c == "text" else F.col(f"doc.`{c}`") for c in columns])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score 0.3 or more)."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return _unpacked(quality.score_texts(_packed(docs), model, keep_text=True).where("predicted = 1"), docs.columns)


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language: not those without letters, nor those that fit none."""
    model = language_id.fit(docs.where(~held_out()))
    named = language_id.identify(_packed(docs), model, keep_text=True, share=True)
    return _unpacked(named.where((F.col("lang_pred") != "und") & (F.col("share") >= LANGUAGE_SCORE)), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    return simhash.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item, verbatim or with other numbers and names."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the documents' ids and decoded texts."""
    return sentencepiece_codec.digest_texts(docs.select("doc_id", "text"))


STAGES = [
    ("quality classifier", keep_quality),
    ("language ID", keep_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark),
    ("SentencePiece encoding and decoding", encode),
]

#: The classifiers are fitted models, which SQL cannot express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what each keeps is cut by a checkpoint, as later stages read it more than once."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
