"""From raw documents to token files, in stages that each write what they keep.

Each stage takes ``(spark, docs, sf_dir)`` and returns the columns of ``documents``, the last one
a row per document of the token files. Documents may come with further columns; they are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodespark.llm import decontaminate, minhash, mixing, quality, queries
from lodespark.llm.storage import new_folder
from lodespark.staging import stage


def _whole(docs: DataFrame) -> DataFrame:
    """Rows packed beside what an operator reads, so that its columns cannot clash with theirs."""
    return docs.select(F.struct("*").alias("row"), "doc_id", "source", "text")


def _packed(docs: DataFrame, name: str) -> DataFrame:
    """The text, and all other columns packed, for operators that hand both on: texts are sent once."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select(F.struct(*others).alias(name), "text")


def _unpacked(found: DataFrame, docs: DataFrame, name: str) -> DataFrame:
    return found.select(*(F.col("text" if c == "text" else f"{name}.`{c}`") for c in docs.columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base rule or the model."""
    model = quality.fit(docs, queries.table(spark, sf_dir, "labels"))
    judged = quality.assess(_packed(docs, "row"), model, with_text=True)
    return _unpacked(judged.where("kept"), docs, "row")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates; equal texts of an id are one document."""
    linked = minhash.link(docs, width=5, percent=80)
    kept = stage(linked.where("kept").groupBy("doc_id").agg(F.count("*").alias("n")))
    single, repeated = kept.where("n = 1 or doc_id is null"), kept.where("n > 1 and doc_id is not null")

    def of(ids: DataFrame) -> DataFrame:
        return docs.join(ids, docs["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi")

    if repeated.isEmpty():
        return of(kept)
    return of(single).unionByName(of(repeated).dropDuplicates(["doc_id", "text"]))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which a share lies in passages of the benchmark."""
    benchmark = queries.table(spark, sf_dir, "benchmark")
    found = decontaminate.judged(decontaminate.hits(_packed(docs, "doc_id"), benchmark, with_text=True))
    return _unpacked(found.where("not contaminated"), docs, "doc_id")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take documents, some of them repeatedly, until each source is near its target."""
    measured = mixing.measured(_whole(docs))
    plan = mixing.plan(stage(measured.select("source", "size", "ticket")))
    taken = mixing.taken(measured, plan).where("copies > 0")
    # At most three copies of a row.
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return queries.token_files(spark, docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("token_files", token_files),
]

# No SQL expresses the model of the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_folder(spark, "pipeline")
    for number, (name, step) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
