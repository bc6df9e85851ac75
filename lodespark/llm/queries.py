"""One query per operator over the test tables, and the SQL that repeats those it can."""

from __future__ import annotations

import json
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from lodespark.llm import (
    chat,
    decontaminate,
    licenses,
    minhash,
    mixing,
    ngramlm,
    pii,
    prefixtrie,
    quality,
    tokencount,
    tokenfile,
    warc,
    whitening,
)
from lodespark.llm.storage import new_folder
from lodespark.staging import stage

BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(spark, table(spark, sf_dir, "documents"))


def token_files(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write the token files of ``docs`` and read them back."""
    folder = new_folder(spark, "token-files")
    tokenfile.write(docs, Path(BYTE_TOKENIZER).read_text("utf-8"), END_ID, folder)
    return tokenfile.read(spark, folder)


def document_files(docs: DataFrame) -> DataFrame:
    """The documents as a file tree with ten files in a directory and ten of these in another.

    Every tenth document is the licence file of its directory, every hundredth that of the
    directory above.
    """
    number = F.col("doc_id").cast("long")
    root = F.concat(F.lit("corpus/"), F.floor(number / 100))
    below = F.concat(root, F.lit("/"), F.floor(number / 10))
    path = (
        F.when(number % 100 == 0, F.concat(root, F.lit("/LICENSE")))
        .when(number % 10 == 0, F.concat(below, F.lit("/LICENSE")))
        .otherwise(F.concat(below, F.lit("/"), number, F.lit(".txt")))
    )
    return docs.select(path.alias("path"), "text")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    templates = spark.createDataFrame(
        [(licence, n, notice) for n, (licence, notice) in enumerate(licenses.TEMPLATES)],
        "licence string, template int, notice string",
    )
    planted = spark.createDataFrame(list(licenses.PLANTED), "path string, text string")
    files = document_files(table(spark, sf_dir, "documents"))
    return licenses.scan(files.unionByName(planted), templates)


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.link(table(spark, sf_dir, "documents"), width=2, percent=80)


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.spans(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    def joined(spans: Column) -> Column:
        return F.concat_ws(
            ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        )

    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.concat("base", "added")).alias("spans"),
    )


# A user and an assistant who both say control strings, in a layout of their own.
PLANTED = json.dumps({"prompt": "</s>[INST] ok [/INST]", "completion": "</s>[INST] ok [/INST]"})


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"})
    records = table(spark, sf_dir, "conversations").select("conv_id", "turn", row.alias("record"))
    planted = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.lit(0).cast("long").alias("turn"),
        F.lit(PLANTED).alias("record"),
    )
    return chat.digests(stage(chat.marked(records.unionByName(planted))))


def unigram_scores(path: str = PIECES) -> dict[str, float]:
    """Pieces of a sentence-piece file that stand for text, scored by their rank in it."""
    model = SentencePieceProcessor(model_file=path)
    pieces = [
        model.id_to_piece(n)
        for n in range(model.get_piece_size())
        if not (model.is_control(n) or model.is_unknown(n) or model.is_byte(n))
    ]
    return tokencount.ranked_scores(pieces)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.counts(table(spark, sf_dir, "documents"), unigram_scores())


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.assess(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    # Counting words reads every text, so the rows are kept for the histograms and the result.
    rows = stage(mixing.measured(docs).select("doc_id", "source", "size", "ticket"))
    return mixing.taken(rows, mixing.plan(rows)).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.judged(decontaminate.hits(docs, benchmark))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = ngramlm.fit(docs.where(ngramlm.fold() != 2), order=3)
    ids = docs.select(F.struct("doc_id", (ngramlm.fold() == 2).alias("held_out")).alias("doc_id"), "text")
    return ngramlm.score(ids, model).select(
        "doc_id.doc_id",
        "doc_id.held_out",
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.trie(table(spark, sf_dir, "conversations")).drop("turn_conv_id", "turn_position")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_web_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "archives")
    warc.write(table(spark, sf_dir, "pages"), folder)
    found = warc.resolved(warc.read(spark, folder))
    # What was just written has no problems; else the query must not pass over them.
    kind = F.when(F.col("problem").isNull(), F.col("record_type")).otherwise(F.raise_error("problem"))
    return found.select("page_id", "payload_bytes", "payload_digest", kind.alias("record_type"), "refers_to")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_license_scan": op2_license_scan,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_personal_data": op4_personal_data,
    "op5_chat_format": op5_chat_format,
    "op6_token_counts": op6_token_counts,
    "op7_quality_rules": op7_quality_rules,
    "op8_source_mix": op8_source_mix,
    "op9_decontamination": op9_decontamination,
    "op10_lm_scores": op10_lm_scores,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_web_archives": op13_web_archives,
}

ORACLES: dict[str, str] = {
    "op2_license_scan": licenses.SQL,
    "op5_chat_format": chat.SQL,
    "op8_source_mix": mixing.SQL,
    "op11_prefix_trie": prefixtrie.SQL,
    "op13_web_archives": warc.SQL,
}
