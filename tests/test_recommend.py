"""Recommenders, factors and the ensemble against plain Python and NumPy."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodespark.functions import scoring
from lodespark.operators import latent, recommend
from lodespark.plans import bindings
from lodespark.staging import stage


def make_ratings(seed, users=25, items=18, share=0.6):
    rng = random.Random(seed)
    return {
        (u, i): rng.choice([0.5, 1.0, 2.5, 3.0, 4.0, 5.0])
        for u in range(1, users + 1)
        for i in range(1, items + 1)
        if rng.random() < share
    }


def frame(spark, ratings):
    rows = [(u, i, r, 1000 * u + i) for (u, i), r in ratings.items()]
    return spark.createDataFrame(rows, "user_id long, item_id long, rating double, ts long")


class Plain:
    """Dense restatement: rows are users, columns items, NaN where unrated."""

    def __init__(self, ratings):
        self.users = sorted({u for u, _ in ratings})
        self.items = sorted({i for _, i in ratings})
        self.r = np.full((len(self.users), len(self.items)), np.nan)
        for (u, i), value in ratings.items():
            self.r[self.users.index(u), self.items.index(i)] = value
        self.user_mean = np.nanmean(self.r, axis=1)
        self.item_mean = np.nanmean(self.r, axis=0)
        self.c = self.r - self.user_mean[:, None]

    @staticmethod
    def cosine(x, y, least):
        both = ~np.isnan(x) & ~np.isnan(y)
        if both.sum() < least:
            return None
        x, y = x[both], y[both]
        return x @ y / ((math.sqrt(x @ x) + 1e-12) * (math.sqrt(y @ y) + 1e-12))

    @staticmethod
    def blend(base, near, k):
        near = sorted(near, key=lambda n: (-round(n[0], 10), n[1]))[:k]
        total = sum(abs(s) for s, _, _ in near)
        return base if total <= 1e-12 else base + sum(s * d for s, _, d in near) / total

    def by_user(self, u, i, k, least):
        if u not in self.users:
            return 0.0
        a = self.users.index(u)
        near = []
        if i in self.items:
            col = self.items.index(i)
            for b, v in enumerate(self.users):
                if v != u and not np.isnan(self.r[b, col]):
                    s = self.cosine(self.c[a], self.c[b], least)
                    if s is not None:
                        near.append((s, v, self.c[b, col]))
        return self.blend(self.user_mean[a], near, k)

    def by_item(self, u, i, k, least):
        if i not in self.items:
            return 0.0
        col = self.items.index(i)
        near = []
        if u in self.users:
            a = self.users.index(u)
            for d, j in enumerate(self.items):
                if j != i and not np.isnan(self.r[a, d]):
                    s = self.cosine(self.c[:, col], self.c[:, d], least)
                    if s is not None:
                        near.append((s, j, self.r[a, d] - self.item_mean[d]))
        return self.blend(self.item_mean[col], near, k)


def requests(spark, pairs):
    return spark.createDataFrame(pairs, "user_id long, item_id long")


PAIRS = [(u, i) for u in (1, 2, 7, 99) for i in (1, 3, 5, 18, 77)]


@pytest.mark.parametrize("least", [1, 5, 12])
def test_predictions(spark, least):
    ratings = make_ratings(least)
    plain = Plain(ratings)
    centered = recommend.center(frame(spark, ratings)).cache()
    asked = requests(spark, PAIRS)
    for clipped in (True, False):
        users = recommend.predict_user_based(centered, asked, 4, least, clipped)
        items = recommend.predict_item_based(centered, asked, 4, least, clipped)
        for df, method in ((users, plain.by_user), (items, plain.by_item)):
            found = {(r["user_id"], r["item_id"]): r["prediction"] for r in df.collect()}
            wanted = {p: method(*p, 4, least) for p in PAIRS}
            if clipped:
                wanted = {p: max(0.5, min(5.0, x)) for p, x in wanted.items()}
            assert found == pytest.approx(wanted)


@pytest.mark.parametrize("least", [1, 3, 5])
def test_large_keys_give_the_same_similarity(spark, least):
    ratings = make_ratings(9, users=20, items=12, share=0.5)
    ratings |= {(1, i): 3.0 + i % 2 for i in range(1, 13)}
    rows = recommend.center(frame(spark, ratings)).select(
        F.col("item_id").alias("member"), F.col("user_id").alias("key"),
        F.col("centered").alias("value"),
    )

    def found(**limits):
        df = recommend.similarity(rows, rows, least, **limits)
        return {tuple(r)[:2]: tuple(r)[2:] for r in df.collect()}

    plain = Plain(ratings)
    wanted = {}
    for a, i in enumerate(plain.items):
        for b, j in enumerate(plain.items):
            s = None if i == j else plain.cosine(plain.c[:, a], plain.c[:, b], least)
            if s is not None:
                both = ~np.isnan(plain.c[:, a]) & ~np.isnan(plain.c[:, b])
                wanted[i, j] = (both.sum(), s)
    for limits in (
        {},
        {"large_member": 8},
        {"small_key": 1},
        {"small_side": 0},
        {"small_side": 0, "large_key_pairs": 20},
    ):
        values = found(**limits)
        assert values.keys() == wanted.keys() and values
        for pair, value in wanted.items():
            assert values[pair] == pytest.approx(value)


def test_last_rating_counts(spark):
    rows = spark.createDataFrame(
        [(1, 1, 2.0, 5, 0), (1, 1, 4.0, 5, 1), (1, 1, 1.0, 4, 2), (1, 2, 3.0, 1, 3)],
        "user_id long, item_id long, rating double, ts long, line_id long",
    )
    by_line = {tuple(r) for r in recommend.dedupe(rows, ["line_id"]).collect()}
    assert by_line == {(1, 1, 1.0, 4), (1, 2, 3.0, 1)}
    by_time = {tuple(r) for r in recommend.dedupe(rows, ["ts", "line_id"]).collect()}
    assert by_time == {(1, 1, 4.0, 5), (1, 2, 3.0, 1)}


def test_unrated_and_top_n(spark):
    ratings = frame(spark, {(1, 1): 3.0, (1, 4): 2.0, (2, 2): 1.0})
    assert [r["item_id"] for r in recommend.unrated(ratings, 1).collect()] == [2]
    assert recommend.unrated(ratings, 1, 3, 9).collect() == []
    wide = frame(spark, {(1, 1): 3.0, (2, 0): 1.0, (2, 5000): 2.0, (2, 1): 4.0})
    assert sorted(r["item_id"] for r in recommend.unrated(wide, 1).collect()) == [0, 5000]
    predicted = spark.createDataFrame(
        [(1, 9, 5.0), (1, 2, 5.0), (1, 3, 4.0)], "user_id long, item_id long, prediction double"
    )
    assert [r["item_id"] for r in recommend.top_n(predicted, 2).collect()] == [2, 9]


def test_global_mean_without_ratings(spark):
    empty = frame(spark, {(1, 1): 1.0}).where("user_id = 0")
    assert recommend.global_mean(empty) == 3.0


def test_scalars(spark):
    values = spark.createDataFrame([(x,) for x in (-800.0, -1.0, 0.0, 2.0, 800.0)], "x double")
    found = [r[0] for r in values.select(scoring.sigmoid(F.col("x"))).collect()]
    assert found == pytest.approx([0.0, 1 / (1 + math.e), 0.5, 1 / (1 + math.exp(-2)), 1.0])
    assert [r[0] for r in values.select(scoring.clip(F.col("x"))).collect()] == [0.5, 0.5, 0.5, 2.0, 5.0]


def projection(ratings, rank):
    plain = Plain(ratings)
    seen = (~np.isnan(plain.r)).astype(float)
    _, _, vt = np.linalg.svd(seen, full_matrices=False)
    return plain, seen, vt[:rank].T


@pytest.mark.parametrize("small_catalogue", [4096, 1])
def test_factor_scores(spark, small_catalogue):
    ratings = make_ratings(21, users=30, items=12, share=0.4)
    # Two blocks of taste, so that the second singular value stands apart from the third.
    ratings = {
        (u, i): r for (u, i), r in make_ratings(21, 30, 12, 0.95).items() if (u <= 15) == (i <= 5)
    } | {(1, 9): 3.0, (20, 2): 1.0}
    plain, seen, v = projection(ratings, 2)
    df = frame(spark, ratings)
    factors = latent.item_factors(df, 2, small_catalogue)
    asked = [(u, i) for u in (1, 2, 20) for i in (1, 6, 11)] + [(99, 1), (1, 99)]
    found = {
        tuple(r)[:2]: r[2] for r in latent.factor_scores(df, requests(spark, asked), factors).collect()
    }
    for u, i in asked:
        if u == 99 or i == 99:
            assert found[u, i] == 1.0
        else:
            dot = seen[plain.users.index(u)] @ v @ v[plain.items.index(i)]
            assert found[u, i] == pytest.approx(1 / (1 + math.exp(-dot)), abs=1e-6)


@pytest.mark.parametrize("rank", [16, 64])
def test_large_catalogues_have_the_same_scores(spark, rank):
    ratings = stage(bindings.ratings(spark, "/root/testdata/sf0.01").select("user_id", "item_id"))
    asked = ratings.where("pmod(user_id * 7 + item_id, 400) = 0")
    cells = ratings.toPandas()
    users, items = np.unique(cells["user_id"]), np.unique(cells["item_id"])
    seen = np.zeros((len(users), len(items)))
    seen[np.searchsorted(users, cells["user_id"]), np.searchsorted(items, cells["item_id"])] = 1
    v = np.linalg.svd(seen, full_matrices=False)[2][:rank].T
    factors = latent.item_factors(ratings, rank, small_catalogue=1)
    rows = latent.factor_scores(ratings, asked, factors).collect()
    assert len(rows) > 50
    for row in rows:
        dot = seen[np.searchsorted(users, row["user_id"])] @ v @ v[np.searchsorted(items, row["item_id"])]
        assert row["factor_score"] == pytest.approx(1 / (1 + math.exp(-dot)), abs=1e-6)


def test_rows_keep_their_width_over_restarts(spark, monkeypatch):
    """150 items at rank 3: the whole space would take 150 columns, a row holds 30."""
    rng, widths, restarts = np.random.default_rng(5), [], []
    seen = rng.random((200, 150)) < np.linspace(0.6, 0.05, 150)
    seen[:80, :20] = seen[80:140, 30:45] = seen[140:, 60:70] = True
    cells = [(int(u), int(i)) for u, i in zip(*np.nonzero(seen))]
    df = stage(spark.createDataFrame(cells, "user_id long, item_id long"))
    plain_turned = latent._turned

    def turned(rows, along, turn, kept=None):
        widths.append(sum(rows.select(F.size("basis"), F.size("block")).first()))
        restarts.append(kept is not None)
        return plain_turned(rows, along, turn, kept)

    monkeypatch.setattr(latent, "_turned", turned)
    monkeypatch.setattr(latent, "LEAST_RANK", 10)
    found = {r[0]: r[1] for r in latent.item_factors(df, 3, small_catalogue=1).collect()}
    v = np.linalg.svd(seen.astype(float), full_matrices=False)[2][:3].T
    ours = np.array([found[i] for i in range(150)])
    assert np.abs(ours @ ours.T - v @ v.T).max() < 1e-6
    assert max(widths) <= 30 and sum(restarts) > 1


def test_equal_singular_values_are_all_found(spark, monkeypatch):
    """24 equal groups of two users and items beside 30 single cells: more copies than a block."""
    cells = [(2 * g + u, 2 * g + i) for g in range(24) for u in (0, 1) for i in (0, 1)]
    cells += [(1000 + n, 1000 + n) for n in range(30)]
    monkeypatch.setattr(latent, "LEAST_RANK", 24)
    df = spark.createDataFrame(cells, "user_id long, item_id long")
    found = {r[0]: np.array(r[1]) for r in latent.item_factors(df, 24, small_catalogue=1).collect()}
    for g in range(24):
        assert found[2 * g] @ found[2 * g + 1] == pytest.approx(0.5, abs=1e-6)
        assert found[2 * g] @ found[2 * g] == pytest.approx(0.5, abs=1e-6)
    assert max(np.abs(found[1000 + n]).max() for n in range(30)) < 1e-6


def test_more_equal_singular_values_than_two_blocks_are_all_found(spark, monkeypatch):
    """20 equal groups, blocks of 4 columns: one random block beside those found is not enough."""
    cells = [(2 * g + u, 2 * g + i) for g in range(20) for u in (0, 1) for i in (0, 1)]
    cells += [(1000 + n, 1000 + n) for n in range(30)]
    monkeypatch.setattr(latent, "LEAST_RANK", 8)
    df = spark.createDataFrame(cells, "user_id long, item_id long")
    found = {r[0]: np.array(r[1]) for r in latent.item_factors(df, 8, small_catalogue=1).collect()}
    assert max(np.abs(found[1000 + n]).max() for n in range(30)) < 1e-6


def test_products_meet_packed_cells(spark, monkeypatch):
    """No row per cell is shuffled for a product, in chunks of users and columns of any size."""
    rng = np.random.default_rng(2)
    seen = rng.random((50, 40)) < 0.3
    seen[7], seen[:, 3] = True, True
    cells = [(int(u), int(i)) for u, i in zip(*np.nonzero(seen))]
    monkeypatch.setattr(latent, "CHUNK_CELLS", 30)
    monkeypatch.setattr(latent, "GATHERED_CELLS", 7)
    monkeypatch.setattr(latent, "TASK_NUMBERS", 80)
    monkeypatch.setattr(latent, "PART", 9)
    chunks, n = latent._chunks(spark.createDataFrame(cells, "user_id long, position long"))
    block = rng.random((40, 5))
    rows = [(i, i, [], row.tolist()) for i, row in enumerate(block)]
    kinds = "item_id long, position long, basis array<double>, block array<double>"
    product = latent._multiplied(chunks, n, spark.createDataFrame(rows, kinds), 40, 5).collect()
    assert n > 8 and chunks.count() <= n
    wanted = seen.T.astype(float) @ (seen @ block)
    assert len(product) == 40
    for row in product:
        assert row["block"] == pytest.approx(wanted[row["position"]].tolist())
        assert row["basis"] == pytest.approx(block[row["position"]].tolist())


def test_unreached_tolerance_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(latent, "MOST_BLOCKS", 1)
    with pytest.raises(ValueError, match="residual"):
        latent.item_factors(frame(spark, make_ratings(8, users=40, items=30)), 2, small_catalogue=1)


def test_rank_is_lowered(spark):
    factors = latent.item_factors(frame(spark, make_ratings(2, users=6, items=4)), 64)
    assert {len(r["factor"]) for r in factors.collect()} == {3}
    one = latent.item_factors(frame(spark, {(1, 1): 2.0, (2, 1): 3.0}), 64)
    assert {len(r["factor"]) for r in one.collect()} == {1}


def test_ensemble(spark):
    ratings = make_ratings(5, users=12, items=8)
    plain, seen, v = projection(ratings, 7)
    overall = np.mean(list(ratings.values()))
    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    asked = [(1, 1, 7), (2, 8, 8), (3, 50, 9), (60, 2, 10)]
    df = spark.createDataFrame(asked, "user_id long, item_id long, ts long")
    rows = latent.ensemble(frame(spark, ratings), df).collect()
    assert len(rows) == 4
    for row in rows:
        u, i = row["user_id"], row["item_id"]
        known = i in plain.items
        mean = plain.item_mean[plain.items.index(i)] if known else overall
        count = (~np.isnan(plain.r[:, plain.items.index(i)])).sum() if known else 0
        pop = 0.7 * mean + 0.3 * overall + 0.15 * math.log1p(count)
        factor = 1.0
        if known and u in plain.users:
            factor = sigmoid(seen[plain.users.index(u)] @ v @ v[plain.items.index(i)])
        wanted = (
            0.3 * sigmoid((plain.by_user(u, i, 30, 5) - 3) / 0.7)
            + 0.3 * sigmoid((plain.by_item(u, i, 30, 5) - 3) / 0.7)
            + 0.1 * sigmoid((pop - 3) / 0.9)
            + 0.3 * factor
        )
        assert row["score"] == pytest.approx(min(1.0, wanted))


def test_grid_search_uses_rank_and_weights(spark):
    ratings = make_ratings(8, users=20, items=10)
    rng = random.Random(0)
    sample = [(u, i, rng.randint(0, 1)) for u in range(1, 11) for i in (1, 4, 8)]
    df = spark.createDataFrame(sample, "user_id long, item_id long, label int")
    weights = ((0.3, 0.3, 0.1, 0.3), (0.0, 0.0, 0.0, 1.0))
    cells = latent.grid_search(frame(spark, ratings), df, (2, 5), weights).collect()
    assert {(r["rank"], r["cell"]) for r in cells} == {(2, 0), (2, 1), (5, 0), (5, 1)}
    for rank in (2, 5):
        scores = latent.factor_scores(
            frame(spark, ratings), df, latent.item_factors(frame(spark, ratings), rank)
        )
        from lodespark.operators import evaluate

        rows = df.join(scores, ["user_id", "item_id"]).select(
            F.round("factor_score", 9).alias("score"), "label"
        )
        alone = evaluate.roc_auc(rows).first()["auc"]
        assert [r["auc"] for r in cells if (r["rank"], r["cell"]) == (rank, 1)] == [
            pytest.approx(alone)
        ]
