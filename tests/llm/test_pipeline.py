from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lodespark.llm import queries
from lodespark.staging import stage
from tests.llm import test_decontaminate, test_minhash, test_mixing, test_tokenfile

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def test_stages_follow_each_other(spark, documents):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "decontamination", "source_mix", "token_files"]
    docs = documents
    for name, step in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(step(spark, docs, SF_DIR))
        assert docs.columns == COLUMNS
        assert docs.join(before, COLUMNS, "left_anti").isEmpty()  # only whole rows of the stage before
        assert 0 < docs.count() <= (3 if name == "source_mix" else 1) * before.count()


def test_decisions_take_effect(spark, documents):
    model_says = queries.op7_quality_rules(spark, SF_DIR).where("kept").select("doc_id")
    kept = corpus_pipeline.quality_rules(spark, documents, SF_DIR)
    assert {r[0] for r in kept.select("doc_id").collect()} == {r[0] for r in model_says.collect()}
    dirty = queries.op9_decontamination(spark, SF_DIR).where("contaminated").select("doc_id")
    clean = corpus_pipeline.decontamination(spark, documents, SF_DIR)
    assert clean.join(dirty, "doc_id").count() == 0 and dirty.count() > 0
    assert clean.count() == documents.count() - dirty.count()
    mix = queries.op8_source_mix(spark, SF_DIR).selectExpr("sum(taken)").first()[0]
    mixed = corpus_pipeline.source_mix(spark, documents, SF_DIR)
    assert mixed.selectExpr(r"sum(regexp_count(text, '[^\\x20\\x09-\\x0D]+'))").first()[0] == mix


@pytest.mark.parametrize("number", range(5))
def test_odd_documents(spark, frame, number):
    text = " ".join(f"word{n}" for n in range(80))
    rows = [
        (1, text, "en", "a", 5, "x", 1), (1, text, "en", "a", 5, "x", 1), (2, text, None, None, None, None, None),
        (None, text + " more", "en", "b", 5, "x", 1), (3, None, "en", "b", 0, "x", 1), (4, "", "en", "b", 0, "x", 1),
        (5, "long " * 30_000, "en", "b", 0, "x", 1),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, size int"
    docs = frame(rows, schema)
    name, step = corpus_pipeline.STAGES[number]
    found = step(spark, docs, SF_DIR).collect()
    empty = step(spark, docs.limit(0), SF_DIR).collect()
    assert empty == []
    if number < 4:
        assert all(r.asDict().keys() == set(docs.columns) for r in found)
    ids = [r["doc_id"] for r in found]
    if name == "near_duplicates":
        assert sorted(map(str, ids)) == sorted(map(str, [1, 3, 4, 5, None]))
        other = docs.where("doc_id = 1").withColumn("text", F.lit("another text of the same id"))
        both = step(spark, docs.unionByName(other), SF_DIR).where("doc_id = 1").collect()
        assert len(both) == 2 and len({r["text"] for r in both}) == 2
    if name == "token_files":
        assert len(ids) == len(rows)


def mixed(rows):
    """Copies that the mix takes, given (doc_id, text, source)."""
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(text.encode().split())
    found = {}
    for source, target in test_mixing.wanted(sizes).items():
        rounds = int(target // sizes[source]) if sizes[source] else 0
        budget, end = target - rounds * sizes[source], 0
        own = []
        for doc_id, text, of in rows:
            name = f"{doc_id}:{hashlib.md5(text.encode()).hexdigest()}"
            ticket = int(hashlib.md5(name.encode()).hexdigest()[:15], 16)
            own += [(ticket, doc_id, len(text.encode().split()))] if of == source else []
        over = False
        for _, doc_id, size in sorted(own):
            end += size
            nearer = end <= budget or end - budget < budget - end + size
            found[doc_id] = rounds + (not over and nearer)
            over = over or end > budget
    return found


def test_run_like_brute_force(spark, documents):
    """The model's verdicts are taken from its query; all other stages are restated."""
    good = {r["doc_id"] for r in queries.op7_quality_rules(spark, SF_DIR).where("kept").collect()}
    rows = [(d["doc_id"], d["text"], d["source"]) for d in documents.collect() if d["doc_id"] in good]
    single = test_minhash.brute_force([r[:2] for r in rows], 5, 80)
    kept = {doc_id for doc_id, _, _, first in single if first}
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    clean = []
    for doc_id, text, source in rows:
        n_words, hit, _ = test_decontaminate.brute_force(text, items, 13)
        if doc_id in kept and not (hit and 20 * len(hit) >= n_words):
            clean.append((doc_id, text, source))
    copies = mixed(clean)
    taken = [(doc_id, text) for doc_id, text, _ in clean for _ in range(copies[doc_id])]
    tokenizer = Tokenizer.from_str(test_tokenfile.DEFINITION)
    result = sorted((tuple(r)[:4] for r in corpus_pipeline.run(spark, SF_DIR).collect()), key=lambda r: r[1])
    assert len(clean) < len(kept) < len(rows) and len(taken) != len(clean)
    assert result == test_tokenfile.expected(taken, tokenizer)
