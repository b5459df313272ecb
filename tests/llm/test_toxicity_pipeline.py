from __future__ import annotations

import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from caseloom.llm import decontamination, near_dedup, toxicity
from caseloom.llm.queries import op9_toxicity, toxicity_model
from caseloom.llm.words import Tokens

from .conftest import ODD, prose
from .test_text_dedup import brute_lines

SF_DIR, LARGE_DIR = "/root/testdata/sf0.001", "/root/testdata/sf0.1"
BAD = ["grobzak", "vuxhead", "zwerkling"]


def written(seed, toxic):
    draw = random.Random(seed)
    words = [w for k in range(draw.randint(5, 40)) for w in prose(draw.randint(0, 40), 3)]
    for _ in range(2 if toxic else 0):
        words.insert(draw.randint(0, len(words)), draw.choice(BAD) + draw.choice(["", ".", ","]))
    return " ".join(words)


def test_held_out_documents(spark, table):
    rows = [(k, written(k, k % 5 == 0)) for k in range(600)]
    labels = spark.createDataFrame(
        [(k, int(k % 5 == 0)) for k in range(400)] + [(None, 1), (3, None)], "doc_id long, label int"
    )
    docs = table(rows + ODD)
    model = toxicity.train(docs, labels)
    found = {r.doc_id: r for r in toxicity.score(docs.where("doc_id >= 400"), model).collect()}
    right = sum((found[k].score >= 0.7) == (k % 5 == 0) for k in range(400, 600))
    assert right >= 196
    assert all(0 <= r.score <= 1 for r in found.values())
    left = toxicity.clean_rows(docs, model)
    assert left.columns == docs.columns
    kept = [r.doc_id for r in left.collect()]
    assert {3, 4, 5} <= set(kept) and sum(k is not None and k % 5 == 0 and k >= 400 for k in kept) <= 2


@pytest.mark.skipif(not os.path.isdir(LARGE_DIR), reason="no test tables")
def test_held_out_labels_in_every_language(spark):
    docs = spark.read.parquet(f"{LARGE_DIR}/documents.parquet").select("doc_id", "lang")
    labels = spark.read.parquet(f"{LARGE_DIR}/labels.parquet").select("doc_id", "toxic").where("toxic is not null")
    judged = op9_toxicity(spark, LARGE_DIR).where("held_out").join(labels, "doc_id").join(docs, "doc_id")
    found = {(r.lang, r.toxic): (r.n, r.flagged) for r in judged.groupBy("lang", "toxic").agg(
        F.count("*").alias("n"), F.sum("predicted").alias("flagged")).collect()}
    print(found)
    for (_, toxic), (n, flagged) in found.items():
        assert flagged >= 0.6 * n if toxic else flagged <= 0.03 * n


def test_ordinary_dictionary_reads_every_script():
    latin = [f"a{k} " + " ".join(prose(k, 30)) for k in range(1600)]
    cyrillic = [f"я{k} привет здравствуйте" for k in range(1600)]
    toxic = [(f"{text} moron", 1, k % 2) for k, text in enumerate(latin[:40])]
    model = toxicity.fit([(text, 0, k % 9) for k, text in enumerate(latin + cyrillic)] + toxic)
    assert "приве".encode() in model.base


def test_last_stretch_of_the_dictionary_is_found():
    model = toxicity.ToxicityModel(" ".join(prose(1, 300)).encode(), b" moron achlich")
    distance = model.meter()
    plain = distance(b" odruvaty ")
    assert distance(b" achlichzu ") > plain and distance(b" moron ") > plain


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 0), (2, 0)]])
def test_nothing_to_learn(spark, table, labels):
    model = toxicity.train(table(ODD), spark.createDataFrame(labels, "doc_id long, label int"))
    found = toxicity.score(table(ODD), model).collect()
    assert len(found) == len(ODD) and all(r.score < 0.01 for r in found)
    assert toxicity.score(table([]), model).collect() == []


def test_long_words_are_read_to_the_end():
    pieces = toxicity._pieces(b"x" * 200 + b"end")
    assert b"end " in pieces[-1] and all(len(p) <= toxicity.PIECE + 2 for p in pieces)
    joined = pieces[0][1:-1]
    for piece in pieces[1:]:
        joined += piece[1 + toxicity.PIECE - toxicity.STEP : -1]
    assert joined == b"x" * 200 + b"end"


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_pipeline_against_brute_force(spark):
    """Every stage's decisions, made again in plain Python on what it was given."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    before = {r.doc_id: r for r in docs.collect()}
    frames = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF_DIR).persist()
        frames[name] = ([r.asDict() for r in docs.collect()], [r.asDict() for r in after.collect()])
        if name != "packing":
            assert after.columns == docs.columns
            docs = after

    given, left = frames["toxicity"]
    model = toxicity_model(spark, SF_DIR, spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    scores = model.scores(toxicity.features(pa.array([r["text"] for r in given]), model.meter()))
    assert {r["doc_id"] for r in left} == {r["doc_id"] for r, s in zip(given, scores) if s < 0.7}

    import hashlib

    given, left = frames["line_dedup"]
    want = {(key, sha) for key, _, _, sha in brute_lines([(r["doc_id"], r["text"]) for r in given])}
    assert {(r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in left} == want
    assert all(r["n_chars"] == len(r["text"]) and r["source"] == before[r["doc_id"]].source for r in left)

    given, left = frames["near_dedup"]
    bags = near_dedup._elements(pa.array([r["text"] for r in given]))
    parent = list(range(len(given)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(given)):
        for b in range(a):
            if near_dedup.probability_jaccard(*bags[a], *bags[b]) >= 0.8:
                parent[root(a)] = root(b)
    first = {}
    for k, r in enumerate(given):
        first[root(k)] = min(first.get(root(k), r["doc_id"]), r["doc_id"])
    assert {r["doc_id"] for r in left} == set(first.values())

    given, left = frames["decontamination"]
    texts = Tokens(pa.array([r["text"] for r in given]))
    items = [Tokens(pa.array([text])).hashes for _, text in bench]
    clean = set()
    for k, r in enumerate(given):
        own = texts.hashes[texts.first[k] : texts.first[k + 1]]
        found = any(
            decontamination.best_window(own, item, shift)
            for item in items for shift in range(-len(item) + 1, len(own))
        )
        if not found:
            clean.add(r["doc_id"])
    assert {r["doc_id"] for r in left} == clean

    given, left = frames["packing"]
    assert {r["doc_id"] for r in left} == {r["doc_id"] for r in given}
    result = corpus_pipeline.run(spark, SF_DIR)
    assert result.count() == len(left)
    assert result.agg(F.sum("length")).first()[0] == sum(r["length"] for r in left)
