import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import classifier as C
from tidemark.llm.queries import QUERIES


def rows():
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randrange(2, 9)))
    good = lambda: " ".join(word() for _ in range(60)).capitalize() + "."
    bad = lambda: rng.choice([lambda: (word() + " ") * 60, lambda: " | ".join(word() for _ in range(40)), lambda: "!! ".join(word().upper() for _ in range(50))])()
    return [(i, bad() if i % 4 == 0 else good(), int(i % 4 != 0)) for i in range(400)]


def test_votes_equal_plain_neighbours():
    sample = rows()
    counts = np.array([C.terms(t.encode()) for _, t, _ in sample])
    labels = np.array([y for *_, y in sample])
    model = C.fit_vectors(counts, labels, {0: 900, 1: 100})
    new = counts[:30]
    got = model.scores(new, neighbours=7, block=4)
    cosines = model.project(new) @ model.vectors.T
    for row, score in zip(cosines, got):
        near = sorted(range(len(row)), key=lambda j: -row[j])[:7]
        votes = [max(row[j], 1e-3) ** C.SHARPNESS * model.weights[j] for j in near]
        assert abs(sum(v for v, j in zip(votes, near) if labels[j]) / sum(votes) - score) < 1e-3


def test_held_out_accuracy_and_odd_rows(spark):
    data = spark.createDataFrame(rows(), "doc_id bigint, text string, quality int")
    odd = spark.createDataFrame([(1000, None, None), (1001, "", None), (None, "x", 1), (1002, "a " * 300_000, None), (0, None, 1)], data.schema)
    docs = data.unionByName(odd).withColumn("label", F.lit("clash")).withColumn("id", F.lit(1))
    labels = docs.select("doc_id", "quality", F.lit(0).alias("text"))
    learn = F.expr("crc32(cast(doc_id AS string)) % 5 <> 0")
    model = C.fit(docs.drop("quality"), labels, learn, per_class=100)
    assert len(model.labels) == 161 or len(model.labels) <= 200
    scores = {r.id: r.score for r in C.score(docs, model).collect()}
    held = [(i, y) for i, _, y in rows() if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((scores[i] >= 0.3) == bool(y) for i, y in held if i) / len(held) > 0.95
    assert all(0 <= s <= 1 for s in scores.values()) and len(scores) == 404
    kept = C.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.score >= 0.3 for r in C.score(docs, model).collect())


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    model = C.fit(docs, labels, F.lit(True))
    assert C.score(docs, model).first().score == 0.5
    assert C.score(docs.limit(0), model).count() == 0


def test_query_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op1_quality_classifier"](spark, sf).collect()}
    assert len(got) == 1000
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [i for i in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out for i in held) and sum(r.held_out for r in got.values()) < 300
    assert sum(got[i].predicted == labels[i] for i in held) / len(held) > 0.95
