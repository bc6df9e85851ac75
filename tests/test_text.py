"""Text functions, near-duplicates and cosine pairs against plain Python."""

from __future__ import annotations

import math
import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodespark.functions import text
from lodespark.operators import neardup, tfidf

LINES = [
    "A small Cat sat on the mat, twice.",
    "a small cat  sat on the mat twice",
    "A small cat sat on the mat -- TWICE!",
    "Entirely other words 123 stand here",
    "",
    "  ",
    "12 34",
    "ab",
    "ÀÉÎ Œuvre ΣΑΣ straße",
    "tab\tnew\nline nbsp",
]


def normal(value):
    return "".join(" " if c.isspace() else c.lower() for c in value if c.isalpha() or c.isspace())


def shingle_set(value):
    value = normal(value)
    return {value[i : i + 3] for i in range(len(value) - 2)}


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def check_text(spark, texts):
    col = F.col("text")
    rows = docs(spark, texts).select(
        "text",
        text.normalize(col).alias("normal"),
        text.shingles(text.normalize(col)).alias("shingles"),
        text.tokens(col).alias("tokens"),
        text.term_counts(F.sort_array(text.tokens(col))).alias("counts"),
    )
    for row in rows.collect():
        assert row["normal"] == normal(row["text"])
        assert row["shingles"] == sorted(shingle_set(row["text"]))
        assert row["tokens"] == row["text"].lower().split()
        counts = {c["term"]: c["tf"] for c in row["counts"] or []}
        assert counts == dict(Counter(row["text"].lower().split()))


def test_fixed_lines(spark):
    check_text(spark, LINES)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.text(alphabet="aZé ß\t\nΣб漢0,.- 𝒳", max_size=40), min_size=1, max_size=30
    )
)
def test_generated_lines(spark, texts):
    check_text(spark, texts)


def test_jaccard_and_agreement(spark):
    rows = spark.createDataFrame(
        [([], []), (["a"], []), (["a", "b"], ["b", "c"]), (["a"], ["a"])],
        "x array<string>, y array<string>",
    )
    values = [r[0] for r in rows.select(text.jaccard(F.col("x"), F.col("y"))).collect()]
    assert values == [1.0, 0.0, 1 / 3, 1.0]
    swapped = [r[0] for r in rows.select(text.jaccard(F.col("y"), F.col("x"))).collect()]
    assert swapped == values
    signed = spark.createDataFrame([([1, 2, 3, 4], [1, 2, 0, 4])], "x array<long>, y array<long>")
    assert signed.select(text.agreement(F.col("x"), F.col("y"))).first()[0] == 0.75


def test_amplify(spark):
    s = spark.createDataFrame([(0.8,)], "s double")
    steps = [("and", 2), ("or", 3)]
    assert s.select(text.amplify(F.col("s"), steps)).first()[0] == pytest.approx(
        1 - (1 - 0.8**2) ** 3
    )
    with pytest.raises(ValueError):
        text.amplify(F.col("s"), [("xor", 2)])


def test_shingle_index_is_the_sorted_position(spark):
    sets = neardup.shingle_sets(docs(spark, LINES * 2 + ["другое слово", "漢字漢字漢"]))
    found = {r["shingle"]: r["row"] for r in neardup.shingle_index(sets).collect()}
    assert found == {s: n for n, s in enumerate(sorted(found))}


def test_next_prime():
    assert [neardup.next_prime(n) for n in (0, 2, 8, 13, 90)] == [2, 2, 11, 13, 97]


def plain_signatures(sets, hashes):
    order = {s: n for n, s in enumerate(sorted(set().union(*sets)))}
    c = neardup.next_prime(len(order))
    pairs = neardup.draw_coefficients(hashes, c)
    return [
        [min([(a * order[s] + b) % c for s in values], default=c) for a, b in pairs]
        for values in sets
    ]


@pytest.mark.parametrize("looked_up", [0, 1 << 20])
def test_every_document_is_signed(spark, looked_up):
    """Copies too, rows with one id each by their own text, and texts that are null or too short."""
    texts = ["one text here", "other words", "one text here", "", None, "ab", "Other words!"]
    ids = [4, 2, 1, 3, 7, 6, 2]
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    signed = plain_signatures([shingle_set(t or "") for t in texts], 120)
    wanted = sorted((i, ",".join(map(str, one))) for i, one in zip(ids, signed))
    assert sorted(map(tuple, neardup.document_signatures(df).collect())) == wanted

    placed = neardup.placed_sets(df)
    rows = neardup.signed_sets(placed, looked_up=looked_up).join(placed, "place").collect()
    found = [(r["doc_id"], ",".join(map(str, neardup.unpacked_signature(r["signature"])))) for r in rows]
    assert sorted(found) == wanted


@given(st.sets(st.one_of(st.integers(0, 600), st.integers(0, 2_999_999_999))))
def test_packed_positions(rows):
    rows = np.array(sorted(rows), dtype=np.int64)
    assert neardup._unpack(neardup._pack(rows)).tolist() == rows.tolist()


def variants(seed, families=8, copies=9):
    """Families of near copies, some of them equal, and some empty texts."""
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz "
    texts = ["", "", "7"]
    for _ in range(families):
        base = [rng.choice(letters) for _ in range(300)]
        for _ in range(copies):
            one = base[:]
            for _ in range(rng.choice([0, 0, 1, 3, 12])):
                one[rng.randrange(300)] = rng.choice(letters)
            texts.append("".join(one))
    return texts


@pytest.mark.parametrize("large_bucket", [1, 1000])
@pytest.mark.parametrize("shape", [(6, 20), (10, 4)])
def test_near_duplicates_hold_every_pair(spark, large_bucket, shape):
    bands, per_band = shape
    texts = variants(bands)
    sets = [shingle_set(t) for t in texts]
    signed = plain_signatures(sets, bands * per_band)
    wanted = {}
    for a, b in combinations(range(len(texts)), 2):
        x, y = signed[a], signed[b]
        shared = any(
            x[n : n + per_band] == y[n : n + per_band]
            for n in range(0, bands * per_band, per_band)
        )
        if shared and np.mean(np.array(x) == np.array(y)) >= 0.9:
            either = len(sets[a] | sets[b])
            wanted[a, b] = len(sets[a] & sets[b]) / either if either else 1.0

    df = docs(spark, texts)
    pairs = neardup.near_duplicates(df, bands, per_band, large_bucket=large_bucket).collect()
    classes = {}
    for row in neardup.copies(neardup.shingle_sets(df)).collect():
        classes.setdefault(row["class_id"], []).append(row["doc_id"])
    found = {}
    for row in pairs:
        left, right = classes[row["doc_a"]], classes[row["doc_b"]]
        assert (len(left), len(right)) == (row["copies_a"], row["copies_b"])
        both = combinations(sorted(left), 2) if row["doc_a"] == row["doc_b"] else (
            (x, y) for x in left for y in right
        )
        for a, b in both:
            found[min(a, b), max(a, b)] = row["jaccard"]
    assert found == pytest.approx(wanted)
    assert len(wanted) > 30


def test_pairs_are_compared_where_their_bucket_meets(spark):
    """No pair is joined with signatures or sets; without a least agreement no bucket is cut."""
    texts = variants(7)
    pairs = neardup.near_duplicates(docs(spark, texts), 10, 4, min_agreement=0.0, large_bucket=5)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Join" in line and "doc_a" in line]
    assert "Aggregate" not in plan.split("FlatMapGroupsInArrow")[0]

    sets = {}
    for n, text in enumerate(texts):
        sets.setdefault(frozenset(shingle_set(text)), n)
    signed = plain_signatures([set(s) for s in sets], 40)
    wanted = {}
    for (x, one, a), (y, two, b) in combinations(zip(signed, sets, sets.values()), 2):
        if any(list(x[n : n + 4]) == list(y[n : n + 4]) for n in range(0, 40, 4)):
            wanted[min(a, b), max(a, b)] = len(one & two) / len(one | two)
    found = {(r["doc_a"], r["doc_b"]): r["jaccard"] for r in pairs.where("doc_a < doc_b").collect()}
    assert found == pytest.approx(wanted)
    assert pairs.where("doc_a < doc_b").count() == len(wanted) > 30


def test_a_pair_of_a_large_bucket_is_found_in_one_segment(spark):
    """Found pairs are not made distinct by a shuffle, though they share several segments."""
    pairs = neardup.near_duplicates(docs(spark, variants(3)), large_bucket=1)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan.split("FlatMapGroupsInArrow")[0]
    found = [(r["doc_a"], r["doc_b"]) for r in pairs.collect()]
    assert len(found) == len(set(found)) > 30


def plain_cosines(texts, limit):
    tfs = [Counter(t.lower().split()) for t in texts]
    df = Counter(term for tf in tfs for term in tf)
    vectors = [{t: n * math.log(len(texts) / df[t]) for t, n in tf.items()} for tf in tfs]
    norms = [math.sqrt(sum(w * w for w in v.values())) for v in vectors]
    wanted = {}
    for a, b in combinations(range(len(texts)), 2):
        if norms[a] == 0 or norms[b] == 0:
            continue
        dot = sum(w * vectors[b].get(t, 0.0) for t, w in vectors[a].items())
        if 1 - dot / (norms[a] * norms[b]) < limit:
            wanted[a, b] = dot / (norms[a] * norms[b])
    return wanted


def word_texts(seed):
    rng = random.Random(seed)
    common = ["the", "of", "and"]
    vocabulary = [f"w{n}" for n in range(120)]
    texts = ["the", "the", ""]
    for _ in range(10):
        base = rng.choices(vocabulary, k=25) + common
        for _ in range(6):
            one = base[:]
            for _ in range(rng.choice([0, 1, 2, 6])):
                one[rng.randrange(len(one))] = rng.choice(vocabulary + common)
            rng.shuffle(one)
            texts.append(" ".join(one))
    return texts


def expand(pairs, members):
    classes = {}
    for row in members:
        classes.setdefault(row["class_id"], []).append(row["doc_id"])
    found = {}
    for row in pairs:
        left, right = classes[row["doc_a"]], classes[row["doc_b"]]
        both = combinations(left, 2) if row["doc_a"] == row["doc_b"] else (
            (x, y) for x in left for y in right
        )
        for a, b in both:
            found[min(a, b), max(a, b)] = row["similarity"]
    return found


@pytest.mark.parametrize("limit", [0.1, 0.4, 0.9])
def test_cosine_pairs_hold_every_pair(spark, limit):
    texts = word_texts(3)
    lists = tfidf.token_lists(docs(spark, texts))
    weights = tfidf.weights(tfidf.classes(lists))
    found = expand(tfidf.cosine_pairs(weights, limit).collect(), tfidf.copies(lists).collect())
    assert found == pytest.approx(plain_cosines(texts, limit))


@pytest.mark.parametrize("block", [1, 5])
def test_cosine_pairs_are_found_across_blocks(spark, block):
    texts = word_texts(5)
    lists = tfidf.token_lists(docs(spark, texts))
    weights = tfidf.weights(tfidf.classes(lists))
    found = tfidf.cosine_pairs(weights, 0.4, block=block).collect()
    assert len({tuple(r)[:2] for r in found}) == len(found)
    assert expand(found, tfidf.copies(lists).collect()) == pytest.approx(plain_cosines(texts, 0.4))


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**62))))
def test_packed_numbers(numbers):
    numbers = np.array(numbers, dtype=np.int64)
    for kind in ("u1", "<u2"):
        assert tfidf._unpack(tfidf._pack(numbers, kind), len(numbers), kind).tolist() == numbers.tolist()


def test_vectors_travel_in_a_few_bytes_a_term(spark):
    """Term numbers rise with the frequency; terms in any order come back with their weights."""
    weights = tfidf.weights(tfidf.token_lists(docs(spark, word_texts(5)))).where("weight > 0")
    rows = weights.select("term_id", "df").distinct().orderBy("term_id").collect()
    assert [r["df"] for r in rows] == sorted(r["df"] for r in rows)
    turned = weights.withColumn("term_id", F.lit(10**12) - F.col("term_id"))
    found = {tuple(r)[:2]: r["similarity"] for r in tfidf.cosine_pairs(weights, 0.4).collect()}
    other = {tuple(r)[:2]: r["similarity"] for r in tfidf.cosine_pairs(turned, 0.4).collect()}
    assert found == pytest.approx(other) and len(found) > 30
    plan = tfidf.cosine_pairs(weights, 0.4)._jdf.queryExecution().analyzed().toString()
    groups = [line for line in plan.splitlines() if "FlatMapGroupsInArrow" in line]
    assert groups and "unit" not in groups[0]


def test_a_family_is_sent_to_blocks_and_not_to_pairs(spark):
    rows = [(n, 0, t, 0.5, 0.9) for n in range(60) for t in range(20)]
    joined = spark.createDataFrame(
        rows, "doc_id long, bucket long, term_id long, unit double, after double"
    )
    lengths = joined.groupBy("doc_id").agg(F.lit(1).cast("long").alias("places"))
    meeting = tfidf._meeting(joined, lengths, 0.9, 20).collect()
    # 1,770 pairs share 20 terms; each document meets three blocks.
    assert len(meeting) == 180
    assert {(r["low"], r["high"]) for r in meeting} == {(a, b) for a in range(3) for b in range(a, 3)}


@pytest.mark.parametrize("kind", ["sign", "gaussian"])
def test_bucket_pairs_are_the_exact_pairs_in_one_bucket(spark, kind):
    texts = word_texts(4)
    weights = tfidf.weights(tfidf.classes(tfidf.token_lists(docs(spark, texts))))
    keys = tfidf.hyperplane_keys(weights, 4, kind)
    bucket = {r["doc_id"]: r["bucket"] for r in keys.collect()}
    exact = {tuple(r)[:4]: r["similarity"] for r in tfidf.cosine_pairs(weights).collect()}
    found = {tuple(r)[:4]: r["similarity"] for r in tfidf.cosine_pairs(weights, keys=keys).collect()}
    inside = {p: s for p, s in exact.items() if bucket[p[0]] == bucket[p[1]]}
    assert found == pytest.approx(inside)


def test_zero_vector_sets_every_bit(spark):
    weights = tfidf.weights(tfidf.token_lists(docs(spark, ["same", "same"])))
    assert {r["bucket"] for r in tfidf.hyperplane_keys(weights, 10).collect()} == {1023}
    assert tfidf.cosine_pairs(weights).count() == 0


def test_gaussian_components_look_normal(spark):
    terms = spark.range(4000).select(F.col("id").cast("string").alias("term"))
    values = terms.select(*tfidf.gaussian_planes(tfidf.digest(F.col("term")), 2)).toPandas().to_numpy()
    assert abs(values.mean()) < 0.05 and abs(values.std() - 1) < 0.05
    assert abs(np.corrcoef(values.T)[0, 1]) < 0.05


def test_plain_spaces_are_not_replaced(spark):
    """Only other white space costs a match; what the words and letters are stays the same."""
    other = [*range(9, 14), *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    raw = "  a1 B" + "".join(f"{chr(c)}x{chr(c)}{chr(c)} " for c in other) + "é-f ​ g  "
    df = spark.createDataFrame([(raw,), ("",), ("  ",), (None,), (" a  b ",)], "text string")
    col = F.col("text")
    rows = df.select(
        F.regexp_replace(col, f"[{text.OTHER_WHITESPACE}]", "|").alias("marked"),
        text.words(col).alias("words"),
        text.normalize(col).alias("letters"),
    ).collect()
    assert rows[4]["marked"] == " a  b "
    assert [r["words"] for r in rows] == [["a1", "B", *["x"] * len(other), "é-f", "​", "g"], [], [], None, ["a", "b"]]
    assert rows[0]["letters"] == "  a b" + " x   " * len(other) + "éf  g  "
    assert [r["letters"] for r in rows[1:]] == ["", "  ", None, " a  b "]
