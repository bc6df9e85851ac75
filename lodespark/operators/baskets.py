"""Frequent items, frequent pairs and association rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodespark.operators.cooccurrence import LARGE_GROUP, pair_counts


def weighted_baskets(baskets: DataFrame) -> DataFrame:
    """Distinct item sets with the number of baskets holding each.

    ``baskets`` has ``(basket_id, items: array<string>)`` with unique ids. Copies of a basket are
    merged before the first shuffle, so a basket seen very often costs one row.
    Empty baskets are dropped.
    """
    items = F.sort_array(F.array_distinct("items"))
    return (
        baskets.select("basket_id", items.alias("items"))
        .where(F.size("items") > 0)
        .groupBy("items")
        .agg(F.min("basket_id").alias("group_id"), F.count(F.lit(1)).alias("weight"))
    )


def basket_members(baskets: DataFrame) -> DataFrame:
    """Long form ``(group_id, item, weight)`` of the distinct baskets."""
    return weighted_baskets(baskets).select(
        "group_id", F.explode("items").alias("item"), "weight"
    )


def frequent_items(baskets: DataFrame, support: int) -> DataFrame:
    """Items held by at least ``support`` baskets: ``(item, support)``."""
    return (
        baskets.select(F.explode(F.array_distinct("items")).alias("item"))
        .groupBy("item")
        .agg(F.count(F.lit(1)).alias("support"))
        .where(F.col("support") >= support)
    )


def frequent_pairs(
    baskets: DataFrame, support: int, large_group: int = LARGE_GROUP
) -> DataFrame:
    """Item pairs held together by at least ``support`` baskets."""
    return pair_counts(basket_members(baskets), support, large_group)


def rules(
    baskets: DataFrame,
    support: int,
    min_confidence: float = 0.5,
    large_group: int = LARGE_GROUP,
) -> DataFrame:
    """Rules ``antecedent -> consequent`` with enough confidence, in both directions."""
    pairs = frequent_pairs(baskets, support, large_group)
    items = frequent_items(baskets, support)
    directions = F.array(
        F.struct(F.col("item_a").alias("antecedent"), F.col("item_b").alias("consequent")),
        F.struct(F.col("item_b").alias("antecedent"), F.col("item_a").alias("consequent")),
    )
    return (
        pairs.select("support", F.inline(directions))
        .join(
            items.select(F.col("item").alias("antecedent"), F.col("support").alias("item_support")),
            "antecedent",
        )
        .withColumn("confidence", F.col("support") / F.col("item_support"))
        .where(F.col("confidence") >= min_confidence)
        .select("antecedent", "consequent", "confidence", "support")
    )


def top_rules(rule_rows: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` rules of highest confidence, then support, then items."""
    return rule_rows.orderBy(
        F.desc("confidence"), F.desc("support"), "antecedent", "consequent"
    ).limit(k)


def summary(
    baskets: DataFrame,
    support: int,
    min_confidence: float = 0.5,
    rule_rows: DataFrame | None = None,
) -> DataFrame:
    """One row: the number of frequent items and of rules that pass; the rules may be given."""
    if rule_rows is None:
        rule_rows = rules(baskets, support, min_confidence)
    items = frequent_items(baskets, support).select(
        F.lit(1).alias("is_item"), F.lit(0).alias("is_rule")
    )
    passing = rule_rows.select(F.lit(0).alias("is_item"), F.lit(1).alias("is_rule"))
    return items.unionByName(passing).agg(
        F.coalesce(F.sum("is_item"), F.lit(0)).alias("frequent_items"),
        F.coalesce(F.sum("is_rule"), F.lit(0)).alias("rules"),
    )
