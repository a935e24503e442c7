"""From raw documents to packed training sequences: quality rules, near-duplicates, secrets, packing.

Every stage reads the documents that the one before kept, and its decisions take effect: rejected documents and further
members of a group of near-duplicates go, confirmed secrets are cut out of the texts, and the last stage returns the pieces of
all sequences. Stages are written to the shared folder as Parquet and read again, so a lost executor repeats one stage; what a stage
writes for itself is removed when its result is written, and a result when the next one is.

Near-duplicates are texts whose SimHash fingerprints (three-word shingles) are linked by three differing bits or fewer. The document
with the smallest id of each group stays, one row of it (one without an id only if no other is there). Rows are told apart by a
number of their own, not by id, so texts that share an id are judged each for itself. The stage and the secret scan return the given
columns, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import op1_secrets, op2_quality, op5_packing, op7_simhash
from tallyloom.llm.names import unused
from tallyloom.operators.staging import run_scope, stage
from tallyloom.session import new_folder
from tallyloom.sources import files


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the certified cutoffs of their language."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "lang", "text")  # no given name meets one of the measures
    measured = stage(op2_quality.measure(rows).drop("text"), "measured")
    cutoffs = op2_quality.calibrate(measured, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return op2_quality.judge(measured, cutoffs).where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    uid, = unused(docs, "row_number")
    numbered = stage(docs.withColumn(uid, F.monotonically_increasing_id()), "numbered")
    found = op7_simhash.near_duplicates(numbered, uid).select(F.col(uid).alias("uid"), "component_id")
    ids = numbered.select(F.col(uid).alias("uid"), F.col("doc_id").alias("id"))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "uid")
    grouped = stage(found.join(ids, "uid").select("uid", "id", "component_id"), "grouped")
    first = grouped.groupBy("component_id").agg(F.min(order).alias("first")).select(F.col("first.uid").alias("uid"))
    others = stage(grouped.select("uid").join(first, "uid", "left_anti").withColumnRenamed("uid", uid), "others")
    return numbered.join(others, uid, "left_anti").select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with confirmed secrets replaced by a mark."""
    return op1_secrets.redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    pieces = op5_packing.pack_documents(docs, "byte_bpe_50k.tiktoken", op5_packing.specials("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality rules", quality), ("near-duplicates", near_duplicates), ("secret scan", secrets), ("packing", packing)]
#: SQL can express neither the fingerprints, the forest nor the token ids; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, over the documents of ``sf_dir``."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, apply in STAGES[:-1]:
        path = new_folder(spark, name.replace(" ", "-"))
        with run_scope(spark):
            out = apply(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            files.remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
