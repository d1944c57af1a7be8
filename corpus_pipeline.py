"""Corpus preparation: each stage works on all documents its predecessor kept.

language    documents without any letter, or without text, go; all others stay
duplicates  of documents linked by five-word shingles at similarity 0.8, the least doc_id of each group stays
mix         documents appear as often as the mix of sources takes them: not at all, once or twice
pieces      ids of every text, and whether they decode to it

Every stage takes null values in any column, repeated rows, empty tables and further columns. All but
the last return the columns they were given.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorstream.llm import langid, mixing, partenum, piece
from sensorstream.llm.common import table, word_count

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Predict the language of every text, learning from the labelled ones, and reject what has none. Where nothing is
    labelled there is no prediction, and letters alone decide."""
    model = langid.fit(docs, F.lit(True))
    if not model.families:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = langid.identify(docs, model)
    return found.where(F.col("lang_pred") != langid.UNKNOWN).select(*docs.columns)


def duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates. Rows equal in doc_id and text are one document;
    documents without doc_id or without words are nobody's duplicates."""
    groups = partenum.similar_components(docs, percent=80, width=5)
    stays = groups.where("component_id is null or doc_id = component_id").select(F.col("doc_id").alias("_stays")).distinct()
    kept = docs.join(stays, F.col("doc_id").eqNullSafe(F.col("_stays")), "left_semi")
    known = kept.where("doc_id is not null").withColumn("_text", F.xxhash64("text")).dropDuplicates(["doc_id", "_text"]).drop("_text")
    return known.unionByName(kept.where("doc_id is null"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at weights 3, 1, 2 by name and 150 % of all words; nothing more than twice."""
    mixed = mixing.mix_copies(docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text", "source"), word_count(F.col("text")))
    return mixed.where("copies > 0").withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*")


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, how many they are, and whether they decode to the text (null counts as empty)."""
    coded = piece.encode_pieces(docs.select("doc_id", "lang", "source", "text"), PIECE_MODEL, decoded="decoded")
    return coded.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language), ("duplicates", duplicates), ("mix", mix), ("pieces", pieces),
]

#: Predictions, rounding draws and token ids are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage keeps is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
