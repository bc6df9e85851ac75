"""Pair counting, graph and basket operators against brute force."""

from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import pytest

from lodespark.operators import baskets, cooccurrence, graph
from lodespark.operators.cooccurrence import pair_counts


def members(spark, groups, weights=None):
    rows = [
        (g, item, (weights or {}).get(g, 1)) for g, items in groups.items() for item in sorted(items)
    ]
    return spark.createDataFrame(rows, "group_id long, item long, weight long")


def brute(groups, minimum, weights=None):
    counts = Counter()
    for g, items in groups.items():
        for pair in combinations(sorted(items), 2):
            counts[pair] += (weights or {}).get(g, 1)
    return {pair: n for pair, n in counts.items() if n >= minimum}


def as_dict(df):
    return {(r["item_a"], r["item_b"]): r["support"] for r in df.collect()}


@pytest.mark.parametrize("minimum", [1, 2, 3, 6])
def test_large_groups_give_the_same_counts(spark, minimum):
    rng = random.Random(minimum)
    groups = {g: set(rng.sample(range(40), rng.choice([3, 5, 25, 30]))) for g in range(30)}
    df = members(spark, groups)
    assert as_dict(pair_counts(df, minimum, large_group=8)) == brute(groups, minimum)
    assert as_dict(pair_counts(df, minimum)) == brute(groups, minimum)


def test_pairs_are_counted_at_their_first_item(spark, monkeypatch):
    """No row per pair is shuffled; lists cut into small pieces give the same counts."""
    monkeypatch.setattr(cooccurrence, "LISTED", 7)
    rng = random.Random(11)
    names = ["b", "a", "Z", "é", "aa", "", "z", "0", "ab"]
    groups = {g: set(rng.sample(names, rng.choice([1, 2, 6, 9]))) for g in range(40)}
    weights = {g: rng.choice([1, 3]) for g in groups}
    rows = [(g, item, weights[g]) for g, items in groups.items() for item in items]
    rows += [(None, "a", 1), (None, "b", 1), (1, None, 1)]
    df = spark.createDataFrame(rows, "group_id long, item string, weight int")
    found = pair_counts(df, 4)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan
    assert not [x for x in plan.splitlines() if "Aggregate [item_a" in x]
    assert as_dict(found) == brute(groups, 4, weights)
    assert as_dict(pair_counts(df.where("group_id = -1"), 1)) == {}


def test_summary_counts_given_rules(spark, monkeypatch):
    rows = [(n, ["a", "b"] if n % 3 else ["a", "c"]) for n in range(12)]
    df = spark.createDataFrame(rows, "basket_id long, items array<string>")
    found = baskets.rules(df, 2)
    wanted = baskets.summary(df, 2).collect()
    monkeypatch.setattr(baskets, "rules", None)
    assert baskets.summary(df, 2, rule_rows=found).collect() == wanted


def test_weights_count_in_the_minimum(spark):
    rng = random.Random(5)
    groups = {g: set(rng.sample(range(30), rng.choice([2, 4, 20]))) for g in range(25)}
    weights = {g: rng.choice([1, 1, 2, 7]) for g in groups}
    df = members(spark, groups, weights)
    for minimum in (2, 4, 9):
        assert as_dict(pair_counts(df, minimum, large_group=5)) == brute(groups, minimum, weights)


def test_hub_is_not_expanded(spark):
    """One group with a third of all rows: its pairs alone stay below the minimum."""
    groups = {0: set(range(3000))}
    groups |= {g: {g % 3000, (g * 7 + 1) % 3000} for g in range(1, 3001)}
    found = as_dict(pair_counts(members(spark, groups), 2, large_group=100))
    small = Counter()
    for g, items in groups.items():
        if g:
            small.update(combinations(sorted(items), 2))
    assert found == {pair: n + 1 for pair, n in small.items()}


def friends(spark, adjacency):
    return spark.createDataFrame(list(adjacency.items()), "user long, friends array<long>")


def undirected(adjacency):
    return {tuple(sorted((u, f))) for u, fs in adjacency.items() for f in fs if u != f}


def brute_recommend(edges, k):
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    counts = brute(near, 1)
    rows = [(a, b, n) for (a, b), n in counts.items() if (a, b) not in edges]
    return sorted(rows, key=lambda r: (-r[2], r[0], r[1]))[:k]


def test_graph_cases(spark):
    adjacency = {1: [2, 3, 3], 2: [1, 3, 4], 3: [1, 2], 4: [2], 5: []}
    edges = graph.edges(friends(spark, adjacency))
    assert {tuple(r) for r in edges.collect()} == {(1, 2), (1, 3), (2, 3), (2, 4)}
    top = [tuple(r) for r in graph.recommend(edges).collect()]
    assert top == [(1, 4, 1), (3, 4, 1)]


@pytest.mark.parametrize("pairs_per_edge", [0, 10**6])
def test_recommend_matches_brute_force(spark, pairs_per_edge):
    rng = random.Random(11)
    adjacency = {u: rng.sample(range(60), rng.randint(1, 9)) for u in range(60)}
    adjacency[0] = list(range(1, 50))
    edges = undirected(adjacency)
    df = graph.edges(friends(spark, adjacency))
    result = graph.recommend(df, 10, pairs_per_edge, large_group=10)
    assert [tuple(r) for r in result.collect()] == brute_recommend(edges, 10)


def test_star_needs_only_its_first_leaves(spark):
    """A hub with leaves: every pair of leaves has one mutual neighbour."""
    adjacency = {0: list(range(1, 3000)), 5000: [5001, 5002], 5003: [5001, 5002], 5001: [5002]}
    edges = graph.edges(friends(spark, adjacency))
    rows = [tuple(r) for r in graph.recommend(edges, 10, large_group=100).collect()]
    assert rows == brute_recommend_star(10)


def brute_recommend_star(k):
    return [(5000, 5003, 2)] + [(1, n, 1) for n in range(2, k + 1)]


def test_fewer_pairs_than_asked_for(spark):
    adjacency = {1: [2], 2: [3], 3: [4]}
    edges = graph.edges(friends(spark, adjacency))
    for pairs_per_edge in (0, 50):
        rows = [tuple(r) for r in graph.recommend(edges, 10, pairs_per_edge).collect()]
        assert rows == [(1, 3, 1), (2, 4, 1)]


def test_baskets_at_the_limits(spark):
    lists = [["a", "b", "a"], ["b", "a"], ["a", "b", "c"], ["a", "c"], ["d"], []]
    df = spark.createDataFrame(list(enumerate(lists)), "basket_id long, items array<string>")
    items = {r["item"]: r["support"] for r in baskets.frequent_items(df, 2).collect()}
    assert items == {"a": 4, "b": 3, "c": 2}
    assert as_dict(baskets.frequent_pairs(df, 2)) == {("a", "b"): 3, ("a", "c"): 2}
    rules = {tuple(r) for r in baskets.rules(df, 2, 0.5).collect()}
    assert rules == {
        ("a", "b", 0.75, 3), ("b", "a", 1.0, 3), ("a", "c", 0.5, 2), ("c", "a", 1.0, 2),
    }
    top = [tuple(r)[:2] for r in baskets.top_rules(baskets.rules(df, 2), 3).collect()]
    assert top == [("b", "a"), ("c", "a"), ("a", "b")]
    assert tuple(baskets.summary(df, 2).first()) == (3, 4)
    assert tuple(baskets.summary(df, 100).first()) == (0, 0)


def test_copied_baskets_count_each(spark):
    lists = [["x", "y", "z"]] * 50 + [["x", "y"]] * 3
    df = spark.createDataFrame(list(enumerate(lists)), "basket_id long, items array<string>")
    assert as_dict(baskets.frequent_pairs(df, 51)) == {("x", "y"): 53}
    assert baskets.weighted_baskets(df).count() == 2
