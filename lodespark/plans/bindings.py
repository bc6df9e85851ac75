"""Job inputs made from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodespark.functions.text import words
from lodespark.operators import graph, recommend
from lodespark.staging import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spread(
        table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag"
        )
    )
    orders = table(spark, sf_dir, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def parts_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of the parts on neighbouring lines of an order, given as adjacency lists."""
    lines = spread(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"))
    following = Window.partitionBy("l_orderkey").orderBy("l_linenumber").rangeBetween(1, 1)
    adjacency = lines.where("l_orderkey is not null and l_linenumber is not null").select(
        F.col("l_partkey").alias("user"), F.collect_list("l_partkey").over(following).alias("friends")
    )
    return graph.edges(adjacency)


def turn_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation turn is a basket, its words are the items."""
    turns = spread(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"))
    return turns.select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias(
            "basket_id"
        ),
        F.array_distinct(words(F.col("text"))).alias("items"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def embedding_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("point_id"), F.col("embedding").cast("array<double>").alias("coords")
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers rate suppliers: the quantity gives the rating, the last order counts."""
    placed = F.col("o_orderdate")
    seconds = (
        F.unix_date(placed.cast("date")).cast("long") * 86400
        + F.hour(placed) * 3600
        + F.minute(placed) * 60
        + F.second(placed)
    )
    rows = order_lines(spark, sf_dir).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_suppkey").alias("item_id"),
        (0.5 * (1 + F.pmod(F.col("l_quantity").cast("long") - 1, F.lit(10)))).alias("rating"),
        seconds.alias("ts"),
        F.col("l_orderkey"),
        F.col("l_partkey"),
        F.col("l_linenumber"),
    )
    return recommend.dedupe(rows, ["ts", "l_orderkey", "l_partkey", "l_linenumber"])


def length_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality labels against the length of the document as the score."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").alias("score"))
    marks = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return docs.join(marks, "doc_id").select("score", "label")
