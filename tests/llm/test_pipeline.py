"""The pipeline stage by stage against plain versions of its operators."""

import struct

import public_tokenizers
from pyspark.sql import functions as F
from test_decontaminate import brute as held_items
from test_line_spread import brute as cut_lines
from test_near_copies import groups as near_groups
from test_packing import direct

import corpus_pipeline as P
from tidemark.llm import classifier, line_spread

SF = "/root/testdata/sf0.001"


def test_pipeline_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    model = classifier.fit(table, spark.read.parquet(f"{SF}/labels.parquet"), F.expr(P.LEARNS))
    import numpy as np

    rows = [(r.doc_id, r.text, r.source) for r in table.collect()]
    rows = [r for r in rows if model.scores(np.array([classifier.terms((r[1] or "").encode())]))[0] >= classifier.THRESHOLD]
    sites = {r[0]: r[2] for r in rows}
    rows = [(key, text) for key, text, _ in cut_lines(rows, line_spread.MIN_SITES)]
    best = {key: component for key, _, component in near_groups(rows)}
    rows = [(key, text) for key, text in rows if best[key] == key]
    dirty = {key for key, *_ in held_items(rows, items)}
    rows = [(key, text) for key, text in rows if key not in dirty]
    assert 0 < len(rows) < len(sites) and dirty
    found = {}
    for r in P.run(spark, SF).collect():
        found.setdefault(r.doc_id, []).append(r)
    assert found.keys() == {key for key, _ in rows}
    for key, text in rows:
        ids = b"".join(r.ids for r in sorted(found[key], key=lambda r: r.start))
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == direct(text)


def test_stages_keep_the_columns_and_stand_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert P.pack(spark, docs.limit(0), SF).count() == 0


def test_first_of_repeated_rows_and_nulls_pass(spark):
    docs = spark.createDataFrame([(1, None, "en", "a", 0), (1, None, "en", "a", 0), (None, "x y z " * 40, None, None, None), (3, "", "en", "b", 0)],
                                 spark.read.parquet(f"{SF}/documents.parquet").schema)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() > 0 and public_tokenizers.path(P.TOKENIZER)
