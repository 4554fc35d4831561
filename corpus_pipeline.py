"""From raw documents to sampled pieces: filter, two kinds of dedup, mixture, encoding.

Each stage takes all that the one before kept, as a written table, and its decisions take effect:

1. toxicity: documents that the field rejects go;
2. exact_dedup: of equal texts the row with the largest id stays;
3. simhash_near_dedup: of each group of linked fingerprints the row with the least id stays;
4. mix_sources: documents stand as often as the mixture takes them, or not at all;
5. sentencepiece: two sampled segmentations of each document.

Stages 1 to 4 return the columns that they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm.exact import drop_copies
from corpusloom.llm.mixing import mix_documents
from corpusloom.llm.pieces import sample_pieces
from corpusloom.llm.simhash import drop_near_copies
from corpusloom.llm.toxicity import drop_toxic
from corpusloom.session import materialize

#: Public model file for the last stage; every executor has it.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs, bits=3, shingle=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_documents(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sample_pieces(docs, MODEL)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup),
          ("simhash_near_dedup", simhash_near_dedup), ("mix_sources", mix_sources),
          ("sentencepiece", sentencepiece)]

#: SQL has neither the field nor the lattice; tests/llm/test_pipeline.py holds run() against plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
