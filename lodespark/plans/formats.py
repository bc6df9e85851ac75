"""Queries over the line formats: lines are made of table columns and parsed, or rows become lines.

``QUERIES`` and ``ORACLES`` have the same names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodespark.operators import baskets, clustering, evaluate, recommend
from lodespark.plans import bindings, oracles, queries
from lodespark.sources import readers, writers
from lodespark.staging import stage

FIRST_POINTS = 200
# How much farther from the middle of the scale ratings lie that predictions are clipped of.
SPREAD = 6


def _line_items(spark: SparkSession, sf_dir: str, *values: str) -> DataFrame:
    """Lines made of the order lines, and a blank one beside the first of each order."""
    lines = bindings.table(spark, sf_dir, "lineitem")
    text: Column = F.concat(*[F.expr(v).cast("string") for v in values])
    number = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    blank = lines.where("l_linenumber = 1").select(
        (-number).cast("long").alias("line_id"), F.repeat(F.lit(" \t"), F.col("l_linenumber")).alias("value")
    )
    return lines.select(number.cast("long").alias("line_id"), text.alias("value")).unionByName(blank)


def parse_adjacency_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _line_items(
        spark, sf_dir, "l_orderkey", "'\t'", "l_partkey", "', ,'", "l_suppkey", "','", "l_partkey"
    )
    found = readers.parse_adjacency(lines)
    return found.select("user", F.explode("friends").alias("friend"))


def parse_basket_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = bindings.table(spark, sf_dir, "conversations")
    number = (F.col("conv_id") * 1000 + F.col("turn")).alias("line_id")
    found = readers.parse_baskets(turns.select(number, F.col("text").alias("value")))
    return found.select("basket_id", F.explode("items").alias("item"))


def parse_article_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = bindings.documents(spark, sf_dir)
    lines = docs.select(F.concat_ws(" ", F.col("doc_id").cast("string"), "text").alias("value"))
    found = readers.parse_articles(lines)
    return found.select("doc_id", F.md5("text").alias("text_md5"))


def parse_point_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _line_items(spark, sf_dir, "l_partkey", "' \t'", "l_linenumber", "'.5  -'", "l_suppkey")
    return readers.parse_points(lines).select(
        "point_id", F.posexplode("coords").alias("dim", "value")
    )


def parse_centroid_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _line_items(spark, sf_dir, "l_orderkey", "'\t'", "l_linenumber", "'.25 '", "l_partkey")
    return readers.parse_centroids(lines).select(
        "cluster_id", F.posexplode("center").alias("dim", "value")
    )


def parse_rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = ("l_suppkey", "','", "l_partkey", "','", "l_linenumber", "'.5,'", "l_orderkey")
    return readers.parse_csv(_line_items(spark, sf_dir, *parts), readers.RATINGS, "line_id")


def parse_request_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = ("l_suppkey", "','", "l_partkey", "','", "l_orderkey")
    return readers.parse_csv(_line_items(spark, sf_dir, *parts), readers.REQUESTS)


def aligned_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions and labels parsed from lines and put side by side."""
    orders = bindings.table(spark, sf_dir, "orders")

    def lines(value: str) -> DataFrame:
        parts = ("o_custkey", "','", "o_orderkey", "','", value, "','", "o_custkey + o_orderkey")
        text = F.concat(*[F.expr(part).cast("string") for part in parts])
        return orders.select(text.alias("value"))

    return evaluate.aligned(
        readers.parse_csv(lines("o_orderkey % 64 + 0.5"), readers.PREDICTIONS),
        readers.parse_csv(lines("o_orderkey % 2"), readers.LABELS),
    )


def pair_count_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return writers.pair_count_lines(queries.friend_recommendations(spark, sf_dir))


def similar_pair_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return writers.similar_pair_lines(queries.near_duplicates(spark, sf_dir), "jaccard")


def rule_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = stage(bindings.turn_baskets(spark, sf_dir))
    found = stage(baskets.rules(turns, queries.SUPPORT))
    summary = baskets.summary(turns, queries.SUPPORT, rule_rows=found)
    return writers.rule_lines(summary, baskets.top_rules(found))


def wcss_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return writers.wcss_lines(queries.kmeans_wcss(spark, sf_dir))


def elbow_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return writers.elbow_lines(queries.kmeans_elbow(spark, sf_dir))


def centroid_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centroids to four decimals, which engines write alike."""
    points = bindings.embedding_points(spark, sf_dir)
    centroids, _ = clustering.kmeans(points, queries.CLUSTERS, queries.STEPS)
    short = F.transform("center", lambda x: F.format_string("%.4f", x))
    return writers.centroid_lines(centroids.withColumn("center", short))


def recommendation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return writers.recommendation_lines(queries.recommend_item_based(spark, sf_dir))


def score_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = queries.validation_sample(spark, sf_dir)
    score = F.format_string("%.6f", F.col("item_id") / (F.col("user_id") + F.col("item_id") + 1))
    return writers.score_lines(rows.withColumn("score", score))


def request_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return writers.request_lines(queries.validation_sample(spark, sf_dir))


def label_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return writers.label_lines(queries.validation_sample(spark, sf_dir))


def first_points_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns and the cluster of the first points, fewer than there are."""
    points = bindings.embedding_points(spark, sf_dir)
    centroids, _ = clustering.kmeans(points, queries.CLUSTERS, queries.STEPS)
    return queries.rounded(clustering.sample(points, centroids, n=FIRST_POINTS), "x", "y")


def clipped_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item-based predictions of one user for every unrated item, within the rating scale."""
    centered = stage(recommend.center(bindings.ratings(spark, sf_dir)))
    wanted = recommend.unrated(centered, queries.TARGET_USER)
    return queries.rounded(recommend.predict_item_based(centered, wanted), "prediction")


def clipped_wide_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from ratings spread so far that predictions pass both ends of the scale."""
    rows = bindings.ratings(spark, sf_dir)
    wide = F.lit(3.0) + SPREAD * (F.col("rating") - 3.0)
    centered = stage(recommend.center(rows.withColumn("rating", wide)))
    wanted = recommend.unrated(centered, queries.TARGET_USER)
    return queries.rounded(recommend.predict_item_based(centered, wanted), "prediction")


QUERIES = {
    f.__name__: f
    for f in (
        parse_adjacency_lines,
        parse_basket_lines,
        parse_article_lines,
        parse_point_lines,
        parse_centroid_lines,
        parse_rating_lines,
        parse_request_lines,
        aligned_predictions,
        pair_count_lines,
        similar_pair_lines,
        rule_lines,
        wcss_lines,
        elbow_lines,
        centroid_lines,
        recommendation_lines,
        score_lines,
        request_lines,
        label_lines,
        first_points_sample,
        clipped_predictions,
        clipped_wide_predictions,
    )
}

_NUMBER = "(l_orderkey * 10 + l_linenumber)::BIGINT"


def _lines(name: str, value: str) -> str:
    return f"SELECT {value} AS value FROM ({oracles.ORACLES[name]})"


ORACLES = {
    "parse_adjacency_lines": f"""
SELECT l_orderkey AS "user", unnest(list_distinct([l_partkey, l_suppkey])) AS friend
FROM lineitem""",
    "parse_basket_lines": oracles._with(oracles.ITEMS)
    + " SELECT conv_id * 1000 + turn AS basket_id, item FROM basket_items",
    "parse_article_lines": """
SELECT doc_id::VARCHAR AS doc_id, md5(text) AS text_md5 FROM documents""",
    "parse_point_lines": f"""
SELECT {_NUMBER} AS point_id, unnest([0, 1, 2])::INTEGER AS dim,
  unnest([l_partkey::DOUBLE, l_linenumber + 0.5, -l_suppkey::DOUBLE])::DOUBLE AS value
FROM lineitem""",
    "parse_centroid_lines": f"""
SELECT l_orderkey::INTEGER AS cluster_id, unnest([0, 1])::INTEGER AS dim,
  unnest([l_linenumber + 0.25, l_partkey::DOUBLE])::DOUBLE AS value
FROM lineitem""",
    "parse_rating_lines": f"""
SELECT l_suppkey AS user_id, l_partkey AS item_id, (l_linenumber + 0.5)::DOUBLE AS rating,
  l_orderkey AS ts, {_NUMBER} AS line_id FROM lineitem""",
    "parse_request_lines": f"""
SELECT l_suppkey AS user_id, l_partkey AS item_id, l_orderkey AS ts
FROM lineitem""",
    "aligned_predictions": """
SELECT o_custkey AS user_id, o_orderkey AS item_id, o_custkey + o_orderkey AS ts,
  (o_orderkey % 64 + 0.5)::DOUBLE AS score, (o_orderkey % 2)::INTEGER AS label FROM orders""",
    "pair_count_lines": _lines("friend_recommendations", "a || chr(9) || b || chr(9) || mutual"),
    "similar_pair_lines": _lines(
        "near_duplicates", "doc_a || chr(9) || doc_b || chr(9) || printf('%.6f', jaccard)"
    ),
    "rule_lines": f"""
SELECT frequent_items::VARCHAR AS value FROM ({oracles.ORACLES['rule_summary']})
UNION ALL SELECT rules::VARCHAR FROM ({oracles.ORACLES['rule_summary']})
UNION ALL SELECT printf('Rule: %s -> %s, Confidence: %.4f, Support: %d', antecedent, consequent,
  confidence, support) FROM ({oracles.ORACLES['association_rules_top10']})""",
    "wcss_lines": _lines("kmeans_wcss", "wcss::VARCHAR"),
    "elbow_lines": _lines("kmeans_elbow", "k || ' ' || wcss::VARCHAR"),
    "centroid_lines": oracles._kmeans((queries.CLUSTERS,))
    + f""" SELECT cl || chr(9) || string_agg(printf('%.4f', v), ' ' ORDER BY dim) AS value
    FROM c{queries.STEPS} GROUP BY cl""",
    "recommendation_lines": _lines(
        "recommend_item_based", "item_id || chr(9) || printf('%.6f', prediction)"
    ),
    "score_lines": _lines(
        "validation_sample",
        "user_id || ',' || item_id || ',' ||"
        " printf('%.6f', item_id / (user_id + item_id + 1)::DOUBLE) || ',' || ts",
    ),
    "request_lines": _lines("validation_sample", "user_id || ',' || item_id || ',' || ts"),
    "label_lines": _lines(
        "validation_sample", "user_id || ',' || item_id || ',' || label || ',' || ts"
    ),
    "first_points_sample": oracles.ORACLES["cluster_sample"].replace(
        "LIMIT 5000", f"LIMIT {FIRST_POINTS}"
    ),
    "clipped_predictions": oracles._with(
        oracles.RATINGS,
        oracles.TARGET_REQUESTS,
        oracles.ITEM_SIMILARITY,
        oracles._by_item(oracles.NEIGHBOURS),
    )
    + """ SELECT user_id, item_id, round(greatest(0.5, least(5.0, prediction)), 6) AS prediction
    FROM by_item""",
    "clipped_wide_predictions": oracles._with(
        oracles.RATINGS.replace("AS MATERIALIZED (\n  SELECT user_id, item_id, rating, ts", f"""AS MATERIALIZED (
  SELECT user_id, item_id, 3.0::DOUBLE + {SPREAD} * (rating - 3.0::DOUBLE) AS rating, ts"""),
        oracles.TARGET_REQUESTS,
        oracles.ITEM_SIMILARITY,
        oracles._by_item(oracles.NEIGHBOURS),
    )
    + """ SELECT user_id, item_id, round(greatest(0.5, least(5.0, prediction)), 6) AS prediction
    FROM by_item""",
}
