"""A pipeline from raw documents to packed training sequences.

Each stage takes all rows that the one before kept; all but the last return the
columns of documents, with n_chars counted anew. In order: toxic documents go;
later occurrences of three-line windows go, and with them documents that have
nothing else; one document of each group of near duplicates stays; documents
that hold a benchmark passage go; the rest is packed into sequences.

Defined results: a row without a doc_id can be neither marked toxic by its own
label nor linked or held to be contaminated, and is packed like any other;
repeated rows (id and text) become one; rows of one id with several texts are
documents of their own, but for decontamination, which takes out all texts of an
id that holds an item; null and empty texts stay and are packed as their end id;
an empty table packs into nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brookflow.llm import decontaminate, linededup, minhash, packing, toxicity
from brookflow.llm.common import new_dir, staged, table
from brookflow.llm.tokens import default_path

#: Runs of five words and this similarity make near duplicates here; op5's contract has its own.
NEAR_PERCENT = 80


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document stays unless lines were taken out and only blanks are left."""
    out = linededup.deduplicated(docs).where((F.col("__removed") == 0) | (F.trim("text", F.lit(" \t\r\n")) != ""))
    counted = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.withColumn("n_chars", F.when(F.col("__removed") > 0, counted).otherwise(F.col("n_chars"))).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group one row stays: exact repetitions of a row's id and text go too (the first by the other columns stays)."""
    found = minhash.near_duplicates(docs, least_percent=NEAR_PERCENT).where("doc_id is not null")
    marks = found.groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).agg(F.bool_and("stands").alias("__stands"), F.count(F.lit(1)).alias("__n"))
    marks = staged(marks.where("not __stands or __n > 1"), "copies")
    keyed = docs.withColumn("__text", F.xxhash64("text"))
    marked = keyed.join(marks, (keyed["doc_id"] == marks["__id"]) & (keyed["__text"] == marks["__hash"]), "left")
    others = [F.col(c) for c in docs.columns if c not in ("doc_id", "text")]
    nth = F.row_number().over(W.partitionBy("doc_id", "__text").orderBy(*others))
    once = marked.where("__stands").withColumn("__nth", nth).where("__nth = 1")
    return marked.where("__stands is null").select(docs.columns).unionByName(once.select(docs.columns))


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    held = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("__held")).distinct()
    return docs.join(held, docs["doc_id"] == held["__held"], "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_documents(spark, docs, default_path())


STAGES = [
    ("toxicity", remove_toxic),
    ("line_dedup", dedup_lines),
    ("minhash", near_dedup),
    ("decontaminate", remove_contaminated),
    ("packing", pack),
]

#: The classifier of the first stage and the packing plan have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage's rows are written and read again as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
