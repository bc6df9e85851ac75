"""Readers and writers."""

from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from lodespark.operators import recommend
from lodespark.sources import readers, writers


def write(path, content):
    path.write_text(content, encoding="utf-8")
    return str(path)


def lines(folder):
    found = []
    for part in sorted(glob.glob(f"{folder}/part-*")):
        with open(part, encoding="utf-8") as handle:
            found += handle.read().splitlines()
    return found


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_adjacency(spark, tmp_path):
    path = write(tmp_path / "graph.txt", "1\t2,3,3\n\n2\t1\n4\n5\t\n  \n")
    assert sorted(rows(readers.read_adjacency(spark, path))) == [
        (1, [2, 3]), (2, [1]), (4, []), (5, []),
    ]


def test_baskets(spark, tmp_path):
    path = write(tmp_path / "baskets.txt", "b a  b\n\n \t\nc\ta\n")
    found = readers.read_baskets(spark, path).orderBy("basket_id")
    assert [r["items"] for r in found.collect()] == [["a", "b"], ["a", "c"]]


def test_articles(spark, tmp_path):
    path = write(tmp_path / "docs.txt", "t1 one two\n\nt2\nt3  spaced \n")
    assert sorted(rows(readers.read_articles(spark, path))) == [
        ("t1", "one two"), ("t2", ""), ("t3", " spaced "),
    ]
    twice = write(tmp_path / "twice.txt", "t1 one\nt1 two\n")
    with pytest.raises(ValueError):
        readers.read_articles(spark, twice)


def test_points(spark, tmp_path):
    path = write(tmp_path / "points.txt", "1 2.5\n\n -3\t4e1 \n5 6\n")
    found = readers.read_points(spark, path).orderBy("point_id")
    assert [r["coords"] for r in found.collect()] == [[1.0, 2.5], [-3.0, 40.0], [5.0, 6.0]]
    some = readers.read_points(spark, path, max_lines=3).orderBy("point_id")
    assert [r["coords"] for r in some.collect()] == [[1.0, 2.5], [-3.0, 40.0]]


def test_lines_of_several_files_follow_their_names(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write(tmp_path / "in" / "a.csv", "1,2,1.0,5\n")
    write(tmp_path / "in" / "b.csv", "".join(f"{n},9,3.0,5\n" for n in range(2000)) + "1,2,4.0,5\n")
    found = readers.read_ratings(spark, str(tmp_path / "in"))
    (last,) = recommend.dedupe(found, ["ts", "line_id"]).where("user_id = 1 and item_id = 2").collect()
    assert last["rating"] == 4.0
    first = readers.read_points(spark, str(tmp_path / "in"), max_lines=1).count()
    assert first == 1


def test_first_lines_come_from_the_first_pieces(spark, tmp_path):
    """Four files of 500 lines in pieces of 1 KB: the first 700 lines need the first two files."""
    (tmp_path / "in").mkdir()
    for f in range(4):
        text = "".join(f"{f * 500 + n}\n" for n in range(500))
        (tmp_path / "in" / f"part {f}.txt").write_text(text)
    path, size = str(tmp_path / "in"), spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        for n, most in ((1, 300), (700, 1000), (2000, 2000), (5000, 2000)):
            kept = readers.first_pieces(spark.read.text(path), n).count()
            assert min(n, 2000) <= kept <= most
            values = [int(r["coords"][0]) for r in readers.read_points(spark, path, n).collect()]
            assert sorted(values) == list(range(min(n, 2000)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_ratings_and_requests(spark, tmp_path):
    path = write(tmp_path / "ratings.csv", "1,2,3.5,77\n1,2,4.0,60\n")
    found = rows(readers.read_ratings(spark, path).orderBy("line_id").drop("line_id"))
    assert found == [(1, 2, 3.5, 77), (1, 2, 4.0, 60)]
    path = write(tmp_path / "requests.csv", "1,2,77\n")
    assert rows(readers.read_requests(spark, path)) == [(1, 2, 77)]
    bad = write(tmp_path / "bad.csv", "1,x,77\n")
    with pytest.raises(Exception):
        readers.read_requests(spark, bad).collect()


def test_centroids_round_trip(spark, tmp_path):
    centroids = spark.createDataFrame(
        [(1, [0.1, -2.0]), (0, [1e-7, 3.0])], "cluster_id int, center array<double>"
    )
    path = str(tmp_path / "centroids")
    writers.write_centroids(centroids, path)
    assert [line.split("\t")[0] for line in lines(path)] == ["0", "1"]
    back = readers.read_centroids(spark, path)
    assert rows(back) == [(0, [1e-7, 3.0]), (1, [0.1, -2.0])]


def test_scores_and_labels_round_trip(spark, tmp_path):
    sample = spark.createDataFrame(
        [(1, 2, 0.25, 7, 1), (3, 4, 0.5, 8, 0)],
        "user_id long, item_id long, score double, ts long, label int",
    )
    writers.write_scores(sample, str(tmp_path / "scores"))
    writers.write_labels(sample, str(tmp_path / "labels"))
    writers.write_requests(sample, str(tmp_path / "requests"))
    assert sorted(rows(readers.read_predictions(spark, str(tmp_path / "scores")))) == [
        (1, 2, 0.25, 7), (3, 4, 0.5, 8),
    ]
    assert sorted(rows(readers.read_labels(spark, str(tmp_path / "labels")))) == [
        (1, 2, 1, 7), (3, 4, 0, 8),
    ]
    assert sorted(rows(readers.read_requests(spark, str(tmp_path / "requests")))) == [
        (1, 2, 7), (3, 4, 8),
    ]


def test_tables(spark, tmp_path):
    pairs = spark.createDataFrame([(1, 5, 3)], "a long, b long, mutual long")
    writers.write_pair_counts(pairs, str(tmp_path / "pairs"))
    assert lines(tmp_path / "pairs") == ["1\t5\t3"]

    similar = spark.createDataFrame(
        [("t2", "t3", 0.5), ("t1", "t9", 1.0)], "doc_a string, doc_b string, jaccard double"
    )
    writers.write_similar_pairs(similar, str(tmp_path / "similar"), "jaccard")
    assert lines(tmp_path / "similar") == ["t1\tt9\t1.000000", "t2\tt3\t0.500000"]

    best = spark.createDataFrame(
        [(1, 9, 4.25), (1, 4, 5.0), (1, 3, 5.0)], "user_id long, item_id long, prediction double"
    )
    writers.write_recommendations(best, str(tmp_path / "best"))
    assert lines(tmp_path / "best") == ["3\t5.000000", "4\t5.000000", "9\t4.250000"]

    curve = spark.createDataFrame([(3, 1.5), (2, 2.5)], "k int, wcss double")
    writers.write_elbow(curve, str(tmp_path / "elbow"))
    assert lines(tmp_path / "elbow") == ["2 2.5", "3 1.5"]
    writers.write_wcss(curve.limit(1).select(F.lit(2.5).alias("wcss")), str(tmp_path / "wcss"))
    assert lines(tmp_path / "wcss") == ["2.5"]


def test_rules(spark, tmp_path):
    summary = spark.createDataFrame([(7, 2)], "frequent_items long, rules long")
    top = spark.createDataFrame(
        [("b", "c", 0.75, 3), ("a", "c", 1.0, 2)],
        "antecedent string, consequent string, confidence double, support long",
    )
    writers.write_rules(summary, top, str(tmp_path / "rules"))
    assert lines(tmp_path / "rules") == [
        "7",
        "2",
        "Rule: a -> c, Confidence: 1.0000, Support: 2",
        "Rule: b -> c, Confidence: 0.7500, Support: 3",
    ]
