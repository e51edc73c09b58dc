"""A corpus pipeline of five stages, each one of the operators in creditmart.llm.

Every stage takes (spark, docs, sf_dir), where docs are all that the stage before has kept, and returns documents; the last one
adds the token ids. Null texts leave in the first stage; extra columns go through all stages.
Empty and blank texts leave there too, texts without any letter as well; texts of any length go through whole. Repeated rows and
rows of one doc_id are near duplicates of each other, of which one stays; of equal ids, the text's hash decides. An empty table
gives an empty one with the same columns.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmart.llm import bpe, decontam, langid, linededup, simhash
from creditmart.llm.common import delete_at_end, free_name, table
from creditmart.llm.queries import BPE_FILE, PIECE_FILE
from creditmart.session import shared_folder


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of some language: those without any letter are rejected. `lang` becomes the predicted one."""
    model = langid.fit(docs, langid.read_pieces(PIECE_FILE))
    found = langid.predict(docs, model)
    named = [F.col("lang_pred").alias(c) if c == "lang" else F.col(c) for c in docs.columns]
    return found.filter(F.col("lang_pred") != langid.UNKNOWN).select(*named)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate of their source, or of it in their language. One of such lines only is a copy and stays whole."""
    host = free_name(docs, "line_host")
    named = docs.withColumn(host, F.to_json(F.struct("source", "lang")))
    kept = linededup.drop_boilerplate(named, "doc_id", ["source", host], "text", max_ratio=0.05, min_pages=5, whole=True)
    sized = [F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    return kept.select(*sized)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles alike to 0.8 or more."""
    return simhash.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids."""
    return bpe.encode(docs, BPE_FILE)


STAGES = [
    ("language", language),
    ("line_dedup", lines),
    ("near_dedup", near_duplicates),
    ("decontamination", benchmark),
    ("encoding", encoding),
]
#: SQL cannot express near duplicates and encoding; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each one's rows written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    delete_at_end(spark, folder)
    return docs
