from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from lodespark.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, components=32):
    """Whitened rows by exact sums and a symmetric eigenvalue solver."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in kept]
    n, d = len(x), len(x[0])
    total = [sum(r[j] for r in x) for j in range(d)]
    centred = [[n * r[j] - total[j] for j in range(d)] for r in x]
    cov = np.array([[float(Fraction(sum(c[i] * c[j] for c in centred), n**3)) for j in range(d)] for i in range(d)])
    values, columns = np.linalg.eigh(cov)
    values, columns = values[::-1], columns[:, ::-1]
    rank = int((values > 1e-9 * values[0]).sum())
    use = min(components, rank)
    z = np.array(centred, float) / n
    white = z @ columns[:, :use] / np.sqrt(values[:use])
    return kept, n, [sum(c * c for c in r) for r in centred], white, values[:use] / np.trace(cov)


def check(found, rows, components=32):
    kept, n, deviations, white, explained = brute(rows, components)
    use = len(explained)
    assert len(found) == len(kept) * use
    by = {(r["vec_id"], r["component"]): r for r in found}
    for k in range(use):
        ours = np.array([by[i, k + 1]["whitened"] for i, _ in kept])
        theirs = white[:, k]
        sign = np.sign(ours @ theirs)
        assert np.abs(sign * ours - theirs).max() < 1e-6
    for (i, _), deviation in zip(kept, deviations):
        for k in range(use):
            row = by[i, k + 1]
            assert row["n"] == n and row["deviation"] == deviation
            assert abs(row["explained"] - explained[k]) < 1e-9 * explained[k]
            assert row["identity_error"] < 1e-9


def vectors(count, size, seed=1):
    rng = np.random.default_rng(seed)
    mixing = rng.normal(size=(size, size))
    return [(n, [float(np.float32(c)) for c in mixing @ rng.normal(size=size)]) for n in range(count)]


def test_against_an_eigenvalue_solver(frame):
    rows = vectors(300, 12) + [(1000, None), (1001, [1.0, None] * 6), (1002, [math.nan] * 12), (1003, [math.inf] * 12)]
    rows += [(1004, []), (1005, [0.0] * 12), (1006, [0.0] * 12)]
    df = frame(rows, SCHEMA).repartition(7)
    check(whitening.whiten(df).collect(), rows)
    check(whitening.whiten(df, components=5).collect(), rows, 5)


def test_the_components_end_at_the_rank(frame):
    rows = vectors(6, 10)
    check(whitening.whiten(frame(rows, SCHEMA)).collect(), rows)
    doubled = [(n, v + v) for n, v in vectors(50, 4)]
    check(whitening.whiten(frame(doubled, SCHEMA)).collect(), doubled)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(n, [1.0, 2.0]) for n in range(9)], [(1, [])]])
def test_rows_without_spread_give_none(frame, rows):
    assert whitening.whiten(frame(rows, SCHEMA)).collect() == []


def test_lengths_ids_and_further_columns(frame):
    rows = [(None, [1.0, 2.0], 1), (5, [3.0, 1.0], 2), (5, [0.0, 1.0], 3), (6, [1.0], 4), (7, [1.0, 2.0, 3.0], 5)]
    df = frame(rows, "vec_id long, embedding array<double>, whitened int")
    found = whitening.whiten(df).collect()
    assert sorted(str(r["vec_id"]) for r in found) == ["5"] * 4 + ["None"] * 2
    assert {r["n"] for r in found} == {3}
    ties = frame([(1, [1.0], 0), (2, [1.0, 5.0], 0), (3, [2.0, 9.0], 0), (4, [7.0], 0)], df.schema)
    assert {r["vec_id"] for r in whitening.whiten(ties).collect()} == {2, 3}


def test_huge_and_tiny_scales(frame):
    rng = np.random.default_rng(3)
    rows = [(n, [1e9 * rng.normal(), rng.normal(), 1e4 + rng.normal()]) for n in range(200)]
    found = whitening.whiten(frame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["component"] for r in found} == {1, 2, 3}
    assert found[0]["identity_error"] < 1e-6
    far = [(1, [1e38, 0.0]), (2, [-1e38, 1.0]), (3, [0.0, 3.0])]
    found = whitening.whiten(frame(far, SCHEMA)).collect()
    assert {r["deviation"] for r in found} >= {None} and all(math.isfinite(r["whitened"]) for r in found)


def test_exact_products():
    rng = np.random.default_rng(5)
    for largest in (3, 2**20, 2**23, 2**45, 2**61):
        x = rng.integers(-largest, largest, (700, 3))
        exact = [[sum(int(a) * int(b) for a, b in zip(x[:, i], x[:, j])) for j in range(3)] for i in range(3)]
        assert whitening.products(x).tolist() == exact


def test_factor_and_rotations():
    rng = np.random.default_rng(6)
    scales = 10.0 ** np.linspace(-6, 6, 9)
    a = scales[:, None] * np.corrcoef(rng.normal(size=(9, 40))) * scales
    factor = whitening.pivoted_cholesky(a)
    assert np.abs(factor @ factor.T - a).max() < 1e-14 * a.max()
    norms, directions = whitening.one_sided_jacobi(factor)
    assert np.abs(directions @ directions.T - np.eye(9)).max() < 1e-12
    # The smallest eigenvalue is right to many digits, twelve orders below the largest in each factor.
    inverse = np.linalg.eigvalsh(np.linalg.inv(a / np.outer(scales, scales)) / np.outer(scales, scales))
    assert abs(norms[-1] ** 2 * inverse[-1] - 1) < 1e-6


def test_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check(queries.QUERIES["op12_embedding_whitening"](spark, sf_dir).collect(), rows)
