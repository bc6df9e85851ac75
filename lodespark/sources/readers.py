"""Readers for the text and CSV inputs. Blank lines are skipped.

A ``read_`` function reads a file or folder, a ``parse_`` function rows of lines (``value``, where an
id is needed also ``line_id``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodespark.functions.text import WHITESPACE, words

RATINGS = "user_id long, item_id long, rating double, ts long"
REQUESTS = "user_id long, item_id long, ts long"
PREDICTIONS = "user_id long, item_id long, score double, ts long"
LABELS = "user_id long, item_id long, label int, ts long"


def _lines(spark: SparkSession, path: str, max_lines: int | None = None) -> DataFrame:
    """``(line_id, value)`` with ids that rise with file name and position in the file."""
    lines = spark.read.text(path)
    if max_lines is None:
        return in_file_order(lines)
    return in_file_order(first_pieces(lines, max_lines)).orderBy("line_id").limit(max_lines)


def not_blank(lines: DataFrame) -> DataFrame:
    """Lines (``value``) with more than white space."""
    return lines.where(F.regexp_replace("value", f"[{WHITESPACE}]", "") != "")


def first_pieces(rows: DataFrame, n: int) -> DataFrame:
    """Rows of the first pieces of files, in file order, that hold ``n`` rows together.

    Counts per piece find the last one. Spark may cut files otherwise when it reads them again,
    so that all that starts before the end of that piece is taken.
    """
    file, start = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    end = start + F.col("_metadata.file_block_length")
    pieces = rows.groupBy(file.alias("file"), start.alias("start"), end.alias("end")).agg(
        F.count(F.lit(1)).alias("n")
    )
    last = (
        pieces.withColumn("upto", F.sum("n").over(Window.orderBy("file", "start")))
        .where(F.col("upto") >= n)
        .orderBy("upto")
        .first()
    )
    if last is None:
        return rows
    return rows.where((file < last["file"]) | ((file == last["file"]) & (start < last["end"])))


def in_file_order(rows: DataFrame) -> DataFrame:
    """Add ``line_id`` to rows read from files; it follows file name and position.

    Spark packs pieces of files into tasks by size, so the piece a row is from decides first. A
    piece is a row in the numbering of the pieces.
    """
    piece = ("_file", "_start")
    places = rows.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_place"),
    )
    order = Window.orderBy(*piece)
    pieces = places.select(*piece).distinct().withColumn("_piece", F.row_number().over(order) - 1)
    line_id = F.shiftleft(F.col("_piece").cast("long"), 33) + F.col("_place")
    return places.join(pieces, list(piece)).select(line_id.alias("line_id"), *rows.columns)


def _numbers(column: Column, kind: str) -> Column:
    return words(column).cast(f"array<{kind}>")


def read_adjacency(spark: SparkSession, path: str) -> DataFrame:
    return parse_adjacency(_lines(spark, path))


def parse_adjacency(lines: DataFrame) -> DataFrame:
    """``user<TAB>f1,f2,..`` as ``(user, friends)``; friends may be missing."""
    parts = F.split(F.trim("value"), "\t")
    listed = F.filter(F.split(F.get(parts, 1), ","), lambda part: F.trim(part) != "")
    friends = F.coalesce(listed.cast("array<long>"), F.array().cast("array<long>"))
    return not_blank(lines).select(
        F.trim(F.get(parts, 0)).cast("long").alias("user"),
        F.array_distinct(friends).alias("friends"),
    )


def read_baskets(spark: SparkSession, path: str) -> DataFrame:
    return parse_baskets(_lines(spark, path))


def parse_baskets(lines: DataFrame) -> DataFrame:
    """Whitespace-separated items as ``(basket_id, items)`` without repeats."""
    return not_blank(lines).select(
        F.col("line_id").alias("basket_id"),
        F.sort_array(F.array_distinct(words(F.col("value")))).alias("items"),
    )


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    return unique_ids(parse_articles(spark.read.text(path)))


def parse_articles(lines: DataFrame) -> DataFrame:
    """``id text`` as ``(doc_id, text)``: the id ends at the first space."""
    value = F.col("value")
    space = F.instr(value, " ")
    return lines.where(F.length("value") > 0).select(
        F.when(space == 0, F.trim(value)).otherwise(F.substring_index(value, " ", 1)).alias("doc_id"),
        F.when(space == 0, F.lit("")).otherwise(F.expr("substring(value, instr(value, ' ') + 1)")).alias("text"),
    )


def unique_ids(docs: DataFrame) -> DataFrame:
    """Fails if two documents have the same id."""
    repeated = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    example = repeated.first()
    if example is not None:
        raise ValueError(f"document id {example['doc_id']} occurs {example['n']} times")
    return docs


def read_points(spark: SparkSession, path: str, max_lines: int | None = None) -> DataFrame:
    """``max_lines`` keeps the first lines of the file; blank ones count but give no point."""
    return parse_points(_lines(spark, path, max_lines))


def parse_points(lines: DataFrame) -> DataFrame:
    """Whitespace-separated numbers as ``(point_id, coords)``."""
    return not_blank(lines).select(
        F.col("line_id").alias("point_id"), _numbers(F.col("value"), "double").alias("coords")
    )


def read_centroids(spark: SparkSession, path: str) -> DataFrame:
    """In order of the id."""
    return parse_centroids(_lines(spark, path)).orderBy("cluster_id")


def parse_centroids(lines: DataFrame) -> DataFrame:
    """``id<TAB>v1 v2 ..`` as ``(cluster_id, center)``."""
    parts = F.split("value", "\t")
    return not_blank(lines).select(
        F.trim(F.get(parts, 0)).cast("int").alias("cluster_id"),
        _numbers(F.get(parts, 1), "double").alias("center"),
    )


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """``user,item,rating,ts`` with a ``line_id``, by which the last of repeated ratings is found."""
    return parse_csv(_lines(spark, path), RATINGS, "line_id")


def parse_csv(lines: DataFrame, schema: str, *kept: str) -> DataFrame:
    """Comma-separated values (``value``) in the columns of ``schema``; a wrong one is an error."""
    row = F.from_csv("value", schema, {"mode": "FAILFAST"})
    return not_blank(lines).select(row.alias("row"), *kept).select("row.*", *kept)


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """``user,item,ts``."""
    return parse_csv(spark.read.text(path), REQUESTS)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """``user,item,score,ts``."""
    return parse_csv(spark.read.text(path), PREDICTIONS)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """``user,item,label,ts``."""
    return parse_csv(spark.read.text(path), LABELS)
