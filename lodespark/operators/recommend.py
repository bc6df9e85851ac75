"""Neighbourhood recommenders on ``(user_id, item_id, rating, ts)`` rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodespark.functions.scoring import clip
from lodespark.staging import stage

EPS = 1e-12
MIN_OVERLAP = 5
NEIGHBOURS = 10
# Rows (of three numbers) up to which the left side is sent to every task.
SMALL_SIDE = 1_000_000
# Rows that one key may have on such a left side: each row on the right makes as many pairs.
SMALL_KEY = 1000
# Rows up to which all of one member are brought into one task.
LARGE_MEMBER = 1_000_000
# A key is joined in chunks when it gives more than this many pairs of rows.
LARGE_KEY_PAIRS = 10_000_000


def dedupe(ratings: DataFrame, order: list[str]) -> DataFrame:
    """Last rating per user and item, by the ``order`` columns."""
    place = F.struct(*[F.col(c).alias(f"place{n}") for n, c in enumerate(order)])
    last = F.max(F.struct(place.alias("place"), "rating", "ts")).alias("last")
    return (
        ratings.groupBy("user_id", "item_id")
        .agg(last)
        .select("user_id", "item_id", "last.rating", "last.ts")
    )


def means(ratings: DataFrame, by: str) -> DataFrame:
    """``(by, mean, count)`` per user or item."""
    return ratings.groupBy(by).agg(
        F.avg("rating").alias("mean"), F.count(F.lit(1)).alias("count")
    )


def global_mean(ratings: DataFrame) -> float:
    """Mean of all ratings, 3.0 without any."""
    value = ratings.agg(F.avg("rating")).first()[0]
    return 3.0 if value is None else float(value)


def center(ratings: DataFrame) -> DataFrame:
    """Ratings with ``centered`` = rating minus the user's mean.

    The means are aggregated and joined back, so that a user with very many ratings
    is not gathered in one window partition.
    """
    user_means = means(ratings, "user_id").select("user_id", F.col("mean").alias("user_mean"))
    return ratings.join(user_means, "user_id").withColumn(
        "centered", F.col("rating") - F.col("user_mean")
    )


def similarity(
    left: DataFrame,
    right: DataFrame,
    min_overlap: int = MIN_OVERLAP,
    small_side: int = SMALL_SIDE,
    large_member: int = LARGE_MEMBER,
    large_key_pairs: int = LARGE_KEY_PAIRS,
    small_key: int = SMALL_KEY,
) -> DataFrame:
    """Cosine similarity on common keys between members of two sets of rows.

    ``left`` and ``right`` hold ``(member, key, value)``. Dot product and norms run
    over the common keys only. Returns ``(left_id, right_id, overlap, similarity)`` for
    different members with at least ``min_overlap`` common keys.

    The rows on the left are counted. If they are few, also per key, they are broadcast; otherwise
    both sides are joined by key.
    """
    left = stage(left)
    a = left.select(F.col("member").alias("left_id"), "key", F.col("value").alias("x"))
    b = right.select(F.col("member").alias("right_id"), "key", F.col("value").alias("y"))
    crowd = left.groupBy("key").count().agg(F.sum("count"), F.max("count")).first()
    if (crowd[0] or 0) <= small_side and (crowd[1] or 0) <= small_key:
        sums = _sums_with_small_left(a, b, large_member)
    else:
        sums = _sums_by_key(a, b, min_overlap, large_key_pairs)
    norms = (F.sqrt("xx") + EPS) * (F.sqrt("yy") + EPS)
    return sums.where(F.col("overlap") >= min_overlap).select(
        "left_id", "right_id", "overlap", (F.col("xy") / norms).alias("similarity")
    )


def _sums_with_small_left(a: DataFrame, b: DataFrame, large_member: int) -> DataFrame:
    """Sums per pair where ``a`` fits into every task.

    The right side is partitioned by its member, so that the sums of a pair are complete
    within a task and only the rows, not the joined pairs, are shuffled. Members
    with very many rows stay where they are and their partial sums are merged.
    """
    sizes = b.groupBy("right_id").agg(F.count(F.lit(1)).alias("n"))
    large = stage(sizes.where(F.col("n") > large_member).select("right_id"))
    small = F.broadcast(a)
    if large.isEmpty():
        return _sums(small.join(b.repartition("right_id"), "key"))
    rest = b.join(large, "right_id", "left_anti").repartition("right_id")
    spread_out = b.join(large, "right_id", "left_semi")
    return _sums(small.join(rest, "key")).unionByName(_sums(small.join(spread_out, "key")))


def _sums_by_key(
    a: DataFrame, b: DataFrame, min_overlap: int, large_key_pairs: int
) -> DataFrame:
    """Sums per pair where both sides are large.

    Keys that would give very many pairs are treated apart. Up to ``min_overlap - 1``
    of them cannot make up the overlap alone, so they are left out of the join and
    added for the pairs it finds; any others are joined in chunks.
    """
    per_key = (
        a.groupBy("key")
        .agg(F.count(F.lit(1)).alias("left_rows"))
        .join(b.groupBy("key").agg(F.count(F.lit(1)).alias("right_rows")), "key")
        .withColumn("pairs", F.col("left_rows") * F.col("right_rows"))
    )
    large = stage(per_key.where(F.col("pairs") > large_key_pairs).select("key", "pairs"))
    if large.isEmpty():
        return _sums(a.join(b, "key"))
    aside = stage(large.orderBy(F.desc("pairs"), "key").limit(min_overlap - 1).select("key"))
    chunked = large.join(aside, "key", "left_anti").select(
        "key", F.ceil(F.col("pairs") / large_key_pairs).cast("int").alias("chunks")
    )
    chunks = F.coalesce("chunks", F.lit(1))
    a_rest = (
        a.join(aside, "key", "left_anti")
        .join(chunked, "key", "left")
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))
        .drop("chunks")
    )
    b_rest = (
        b.join(aside, "key", "left_anti")
        .join(chunked, "key", "left")
        .withColumn("chunk", F.pmod(F.xxhash64("right_id"), chunks).cast("int"))
        .drop("chunks")
    )
    found = stage(_sums(a_rest.join(b_rest, ["key", "chunk"])))
    extra = _sums(
        found.select("left_id", "right_id")
        .join(a.join(aside, "key", "left_semi"), "left_id")
        .join(b.join(aside, "key", "left_semi"), ["right_id", "key"])
    )
    return (
        found.unionByName(extra)
        .groupBy("left_id", "right_id")
        .agg(*[F.sum(c).alias(c) for c in ("overlap", "xy", "xx", "yy")])
    )


def _sums(joined: DataFrame) -> DataFrame:
    x, y = F.col("x"), F.col("y")
    return (
        joined.where("left_id <> right_id")
        .groupBy("left_id", "right_id")
        .agg(
            F.count(F.lit(1)).alias("overlap"),
            F.sum(x * y).alias("xy"),
            F.sum(x * x).alias("xx"),
            F.sum(y * y).alias("yy"),
        )
    )


def user_similarity(
    centered: DataFrame, targets: DataFrame, min_overlap: int = MIN_OVERLAP
) -> DataFrame:
    """Similarity of the target users (``user_id`` rows) to all users, on common items."""
    rows = centered.select(
        F.col("user_id").alias("member"), F.col("item_id").alias("key"),
        F.col("centered").alias("value"),
    )
    wanted = targets.select(F.col("user_id").alias("member")).distinct()
    return similarity(rows.join(wanted, "member", "left_semi"), rows, min_overlap)


def item_similarity(
    centered: DataFrame, requests: DataFrame, min_overlap: int = MIN_OVERLAP
) -> DataFrame:
    """Similarity of the requested items to the items rated by the requesting users."""
    rows = centered.select(
        F.col("item_id").alias("member"), F.col("user_id").alias("key"),
        F.col("centered").alias("value"),
    )
    asked = requests.select(F.col("item_id").alias("member")).distinct()
    users = requests.select("user_id").distinct()
    rated = (
        centered.join(users, "user_id", "left_semi")
        .select(F.col("item_id").alias("member"))
        .distinct()
    )
    return similarity(
        rows.join(asked, "member", "left_semi"),
        rows.join(rated, "member", "left_semi"),
        min_overlap,
    )


def unrated(
    ratings: DataFrame, user_id: int, low: int | None = None, high: int | None = None
) -> DataFrame:
    """Requests ``(user_id, item_id)`` for the items of the catalogue that a user has not rated.

    The catalogue is every rated item, or those with ids from ``low`` to ``high`` if given.
    """
    rated = ratings.where(F.col("user_id") == user_id).select("item_id")
    items = ratings.select("item_id").distinct()
    if low is not None:
        items = items.where(F.col("item_id") >= low)
    if high is not None:
        items = items.where(F.col("item_id") <= high)
    return items.join(rated, "item_id", "left_anti").select(
        F.lit(user_id).cast("long").alias("user_id"), "item_id"
    )


def _nearest(rows: DataFrame, neighbours: int) -> DataFrame:
    """Weighted residual over the most similar neighbours of each request.

    Similarities are ranked to ten decimals, so that rounding in the last bits does not
    decide between equal ones; those go by id.
    """
    order = Window.partitionBy("user_id", "item_id").orderBy(
        F.desc(F.round("similarity", 10)), "neighbour"
    )
    return (
        rows.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= neighbours)
        .groupBy("user_id", "item_id")
        .agg(
            F.sum(F.col("similarity") * F.col("residual")).alias("numerator"),
            F.sum(F.abs("similarity")).alias("denominator"),
        )
    )


def _prediction(base: Column) -> Column:
    """Base plus weighted residual; the base alone where the weights vanish."""
    return F.when(
        F.col("denominator") > EPS, base + F.col("numerator") / F.col("denominator")
    ).otherwise(base)


def predict_user_based(
    centered: DataFrame,
    requests: DataFrame,
    neighbours: int = NEIGHBOURS,
    min_overlap: int = MIN_OVERLAP,
    clipped: bool = True,
) -> DataFrame:
    """``(user_id, item_id, prediction)`` from the most similar users who rated the item."""
    wanted = requests.select("user_id", "item_id").distinct()
    sims = stage(user_similarity(centered, wanted, min_overlap))
    raters = centered.select(
        F.col("user_id").alias("neighbour"), "item_id", F.col("centered").alias("residual")
    )
    near = sims.select(
        F.col("left_id").alias("user_id"), F.col("right_id").alias("neighbour"), "similarity"
    )
    # From the neighbours that were found to what they rated of the requested items, so that an
    # item with many raters does not meet all who ask for it. Of each request a task hands on its
    # nearest neighbours only, as the window asks for the first ranks.
    asked = raters.join(wanted.select("item_id").distinct(), "item_id", "left_semi")
    rows = near.join(asked, "neighbour").join(wanted, ["user_id", "item_id"], "left_semi")
    base = means(centered, "user_id").select("user_id", "mean")
    return _predictions(wanted, rows, base, "user_id", neighbours, clipped)


def predict_item_based(
    centered: DataFrame,
    requests: DataFrame,
    neighbours: int = NEIGHBOURS,
    min_overlap: int = MIN_OVERLAP,
    clipped: bool = True,
) -> DataFrame:
    """``(user_id, item_id, prediction)`` from the most similar items the user rated."""
    wanted = requests.select("user_id", "item_id").distinct()
    sims = stage(item_similarity(centered, wanted, min_overlap))
    base = means(centered, "item_id").select("item_id", "mean")
    rated = (
        centered.join(wanted.select("user_id").distinct(), "user_id", "left_semi")
        .join(base, "item_id")
        .select(
            "user_id",
            F.col("item_id").alias("neighbour"),
            (F.col("rating") - F.col("mean")).alias("residual"),
        )
    )
    near = sims.select(
        F.col("left_id").alias("item_id"), F.col("right_id").alias("neighbour"), "similarity"
    )
    rows = near.join(rated, "neighbour").join(wanted, ["user_id", "item_id"], "left_semi")
    return _predictions(wanted, rows, base, "item_id", neighbours, clipped)


def _predictions(
    wanted: DataFrame,
    rows: DataFrame,
    base: DataFrame,
    base_key: str,
    neighbours: int,
    clipped: bool,
) -> DataFrame:
    value = _prediction(F.coalesce("mean", F.lit(0.0)))
    return (
        wanted.join(base, base_key, "left")
        .join(_nearest(rows, neighbours), ["user_id", "item_id"], "left")
        .select("user_id", "item_id", (clip(value) if clipped else value).alias("prediction"))
    )


def top_n(predictions: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` highest predictions, ties by item."""
    return predictions.orderBy(F.desc("prediction"), "item_id").limit(n)
