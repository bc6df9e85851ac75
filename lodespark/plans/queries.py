"""One query per operator over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodespark.functions.text import amplify
from lodespark.operators import (
    baskets,
    clustering,
    cooccurrence,
    evaluate,
    graph,
    latent,
    neardup,
    recommend,
    sampling,
    tfidf,
)
from lodespark.plans import bindings
from lodespark.staging import stage

SUPPORT = 20
CLUSTERS = 4
STEPS = 3
TARGET_USER = 41
DIGEST_RANKS = (4, 8, 16)
SAMPLE = 200
# Hash functions shared with the SQL: drawn once below this bound, reduced modulo the prime.
COEFFICIENTS = neardup.draw_coefficients(neardup.BANDS * neardup.ROWS_PER_BAND, 2**31 - 1)
# The four worked constructions.
CHAINS = {
    "and2_or3": [("and", 2), ("or", 3)],
    "or3_and2": [("or", 3), ("and", 2)],
    "and2_or2_and2": [("and", 2), ("or", 2), ("and", 2)],
    "or2_and2_or2_and2": [("or", 2), ("and", 2), ("or", 2), ("and", 2)],
}
NEIGHBOURHOOD_PARTS = ["user_score", "item_score", "popularity_score"]
NEIGHBOURHOOD_WEIGHTS = [(0.4, 0.4, 0.2), (0.6, 0.2, 0.2), (0.2, 0.6, 0.2), (0.1, 0.1, 0.8)]

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bindings.parts_graph(spark, sf_dir)


def mutual_neighbor_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.candidate_totals(bindings.parts_graph(spark, sf_dir))


def friend_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.recommend(bindings.parts_graph(spark, sf_dir), 10)


def frequent_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baskets.frequent_items(bindings.turn_baskets(spark, sf_dir), SUPPORT)


def frequent_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baskets.frequent_pairs(bindings.turn_baskets(spark, sf_dir), SUPPORT)


def association_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(baskets.rules(bindings.turn_baskets(spark, sf_dir), SUPPORT), "confidence")


def association_rules_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = baskets.rules(bindings.turn_baskets(spark, sf_dir), SUPPORT)
    return rounded(baskets.top_rules(rules), "confidence")


def rule_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baskets.summary(bindings.turn_baskets(spark, sf_dir), SUPPORT)


def text_shingles(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = neardup.shingle_sets(bindings.documents(spark, sf_dir))
    return sets.select(
        "doc_id",
        F.size("shingles").cast("long").alias("shingles"),
        F.md5(F.array_join("shingles", "|")).alias("digest"),
    )


def minhash_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.document_signatures(bindings.documents(spark, sf_dir), COEFFICIENTS)


def _signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = neardup.shingle_sets(bindings.documents(spark, sf_dir))
    return neardup.signatures(stage(neardup.classes(sets)), coefficients=COEFFICIENTS)


def minhash_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    signed = stage(_signatures(spark, sf_dir))
    return neardup.candidates(signed, neardup.BANDS, neardup.ROWS_PER_BAND)


def near_duplicate_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.copies(neardup.shingle_sets(bindings.documents(spark, sf_dir)))


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = neardup.near_duplicates(bindings.documents(spark, sf_dir), coefficients=COEFFICIENTS)
    return rounded(pairs, "jaccard")


def lsh_amplification(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = neardup.near_duplicates(
        bindings.documents(spark, sf_dir), coefficients=COEFFICIENTS, min_agreement=0.0
    )
    chains = {name: amplify(F.col("jaccard"), steps) for name, steps in CHAINS.items()}
    columns = ["doc_a", "doc_b", "jaccard", *chains]
    return rounded(pairs.withColumns(chains).select(*columns), "jaccard", *chains)


def tfidf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tfidf.weights(tfidf.token_lists(bindings.documents(spark, sf_dir)))
    return rounded(rows.select("doc_id", "term", "tf", "df", "weight"), "weight")


def tfidf_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tfidf.copies(tfidf.token_lists(bindings.documents(spark, sf_dir)))


def _class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = tfidf.token_lists(bindings.documents(spark, sf_dir))
    return stage(tfidf.weights(stage(tfidf.classes(lists))))


def tfidf_cosine_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tfidf.cosine_pairs(_class_weights(spark, sf_dir)), "similarity")


def tfidf_hyperplane_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tfidf.hyperplane_keys(_class_weights(spark, sf_dir))


def tfidf_lsh_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = _class_weights(spark, sf_dir)
    return rounded(
        tfidf.cosine_pairs(weights, keys=tfidf.hyperplane_keys(weights)), "similarity"
    )


def tfidf_gaussian_lsh_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = _class_weights(spark, sf_dir)
    keys = tfidf.hyperplane_keys(weights, kind="gaussian")
    return rounded(tfidf.cosine_pairs(weights, keys=keys), "similarity")


def kmeans_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    centroids, _ = clustering.kmeans(bindings.embedding_points(spark, sf_dir), CLUSTERS, STEPS)
    return rounded(
        centroids.select("cluster_id", F.posexplode("center").alias("dim", "value")), "value"
    )


def kmeans_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = bindings.embedding_points(spark, sf_dir)
    centroids, _ = clustering.kmeans(points, CLUSTERS, STEPS)
    assigned = clustering.assign(points, centroids)
    return rounded(assigned.select("point_id", "cluster_id", "distance"), "distance")


def kmeans_wcss(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = bindings.embedding_points(spark, sf_dir)
    centroids, _ = clustering.kmeans(points, CLUSTERS, STEPS)
    return rounded(clustering.wcss(points, centroids), "wcss")


def kmeans_elbow(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = bindings.embedding_points(spark, sf_dir)
    return rounded(clustering.elbow(points, max_iter=STEPS), "wcss")


def cluster_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = bindings.embedding_points(spark, sf_dir)
    centroids, _ = clustering.kmeans(points, CLUSTERS, STEPS)
    return rounded(clustering.sample(points, centroids), "x", "y")


def rating_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(bindings.ratings(spark, sf_dir))
    by_user = recommend.means(rows, "user_id").select(
        F.lit("user").alias("kind"), F.col("user_id").alias("id"), "mean", "count"
    )
    by_item = recommend.means(rows, "item_id").select(
        F.lit("item").alias("kind"), F.col("item_id").alias("id"), "mean", "count"
    )
    return rounded(by_user.unionByName(by_item), "mean")


def rating_centered(spark: SparkSession, sf_dir: str) -> DataFrame:
    centered = recommend.center(bindings.ratings(spark, sf_dir))
    return rounded(
        centered.select("user_id", "item_id", "rating", "ts", "centered"), "centered"
    )


def _centered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(recommend.center(bindings.ratings(spark, sf_dir)))


def _target(spark: SparkSession) -> DataFrame:
    return spark.range(TARGET_USER, TARGET_USER + 1).withColumnRenamed("id", "user_id")


def user_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    sims = recommend.user_similarity(_centered(spark, sf_dir), _target(spark))
    return rounded(
        sims.select(
            F.col("left_id").alias("user_id"), F.col("right_id").alias("neighbour"),
            "overlap", "similarity",
        ),
        "similarity",
    )


def item_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    centered = _centered(spark, sf_dir)
    sims = recommend.item_similarity(centered, recommend.unrated(centered, TARGET_USER))
    return rounded(
        sims.select(
            F.col("left_id").alias("item_id"), F.col("right_id").alias("neighbour"),
            "overlap", "similarity",
        ),
        "similarity",
    )


def recommend_user_based(spark: SparkSession, sf_dir: str) -> DataFrame:
    centered = _centered(spark, sf_dir)
    predicted = recommend.predict_user_based(centered, recommend.unrated(centered, TARGET_USER))
    return recommend.top_n(rounded(predicted, "prediction"))


def recommend_item_based(spark: SparkSession, sf_dir: str) -> DataFrame:
    centered = _centered(spark, sf_dir)
    predicted = recommend.predict_item_based(centered, recommend.unrated(centered, TARGET_USER))
    return recommend.top_n(rounded(predicted, "prediction"))


def popularity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        latent.popularity_scores(stage(bindings.ratings(spark, sf_dir))),
        "mean", "popularity", "preference",
    )


def validation_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.validation_sample(stage(bindings.ratings(spark, sf_dir)), SAMPLE, SAMPLE)


def training_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, sample = _sampled(spark, sf_dir)
    return sampling.training_split(rows, sample)


def _sampled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = stage(bindings.ratings(spark, sf_dir))
    return rows, stage(sampling.validation_sample(rows, SAMPLE, SAMPLE))


def svd_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, sample = _sampled(spark, sf_dir)
    scores = latent.factor_scores(rows, sample, latent.item_factors(rows))
    return rounded(scores, "factor_score")


def ensemble_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, sample = _sampled(spark, sf_dir)
    return rounded(latent.components(rows, sample), *NEIGHBOURHOOD_PARTS)


def ensemble_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, sample = _sampled(spark, sf_dir)
    return rounded(latent.ensemble(rows, sample), "score")


def digest_factors(rows: DataFrame) -> DataFrame:
    """Factors that SQL can repeat: numbers from a digest of item and position."""
    numbers = [
        F.conv(F.substring(F.md5(F.concat_ws(":", F.col("item_id"), F.lit(n))), 1, 8), 16, 10)
        .cast("long") / 21474836480.0 - 0.1
        for n in range(max(DIGEST_RANKS))
    ]
    return rows.select("item_id").distinct().select("item_id", F.array(*numbers).alias("factor"))


def digest_factor_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, sample = _sampled(spark, sf_dir)
    return rounded(latent.ensemble(rows, sample, factors=digest_factors(rows)), "score")


def digest_factor_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, sample = _sampled(spark, sf_dir)
    cells = latent.grid_search(rows, sample, DIGEST_RANKS, factors=digest_factors(rows))
    return rounded(cells.select("rank", "cell", "auc"), "auc")


def cold_start_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Factor scores of sampled pairs, and of unknown users and items paired with known ones."""
    rows, sample = _sampled(spark, sf_dir)
    unknown = F.lit(-1).cast("long")
    asked = (
        sample.select("user_id", "item_id")
        .union(sample.select(unknown, "item_id"))
        .union(sample.select("user_id", unknown))
    )
    scores = latent.factor_scores(rows, asked, digest_factors(rows))
    return rounded(scores, "factor_score")


def item_cooccurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users who rated both of two items: the matrix that the factors belong to."""
    rows = bindings.ratings(spark, sf_dir).select(
        F.col("user_id").alias("group_id"), F.col("item_id").alias("item"),
        F.lit(1).cast("long").alias("weight"),
    )
    return cooccurrence.pair_counts(stage(rows), 1)


def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.roc_auc(bindings.length_scores(spark, sf_dir)), "auc")


def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.roc_curve(bindings.length_scores(spark, sf_dir)), "fpr", "tpr")


def roc_curve_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = bindings.length_scores(spark, sf_dir)
    return rounded(evaluate.roc_curve(scores, drop_collinear=True), "fpr", "tpr")


def _neighbourhood_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, sample = _sampled(spark, sf_dir)
    parts = sample.join(latent.components(rows, sample), ["user_id", "item_id"])
    return evaluate.grid(parts, NEIGHBOURHOOD_PARTS, NEIGHBOURHOOD_WEIGHTS)


def weight_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_neighbourhood_grid(spark, sf_dir).select("cell", "auc"), "auc")


def weight_grid_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = rounded(_neighbourhood_grid(spark, sf_dir).select("cell", "auc"), "auc")
    return evaluate.best_cell(cells)


def grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, sample = _sampled(spark, sf_dir)
    return rounded(latent.grid_search(rows, sample).select("rank", "cell", "auc"), "auc")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        graph_edges,
        mutual_neighbor_counts,
        friend_recommendations,
        frequent_items,
        frequent_pairs,
        association_rules,
        association_rules_top10,
        rule_summary,
        text_shingles,
        minhash_signatures,
        minhash_candidates,
        near_duplicate_copies,
        near_duplicates,
        lsh_amplification,
        tfidf_weights,
        tfidf_copies,
        tfidf_cosine_exact,
        tfidf_hyperplane_keys,
        tfidf_lsh_pairs,
        tfidf_gaussian_lsh_pairs,
        kmeans_centroids,
        kmeans_assign,
        kmeans_wcss,
        kmeans_elbow,
        cluster_sample,
        rating_means,
        rating_centered,
        user_similarity,
        item_similarity,
        recommend_user_based,
        recommend_item_based,
        popularity_scores,
        validation_sample,
        training_split,
        svd_scores,
        ensemble_components,
        ensemble_scores,
        digest_factor_ensemble,
        digest_factor_grid,
        cold_start_scores,
        item_cooccurrence,
        roc_auc,
        roc_curve,
        roc_curve_turns,
        weight_grid,
        weight_grid_best,
        grid_search,
    )
}
