"""Exact deduplication against a dictionary of texts."""

import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import fingerprints as E


def brute(rows):
    own = {}
    for key, text in rows:
        own.setdefault(text or "", []).append(key)
    out = []
    for text, ids in own.items():
        keep = max((i for i in ids if i is not None), default=None)
        rest = list(ids)
        rest.remove(keep)
        for key, kept in [(keep, True), *((i, False) for i in rest)]:
            out.append((key, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def make():
    rng = random.Random(6)
    rows = [(i, "hot") for i in range(500)] + [(1000 + i, "t%d" % rng.randrange(200)) for i in range(400)] + [(3000 + i, "u%d" % i) for i in range(300)]
    rows += [(1, None), (2, ""), (2, ""), (None, "hot"), (None, "solo"), (None, "solo"), (7, "long " * 100_000), (8, "long " * 100_000), (9, "Hot"), (9, "hot ")]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id bigint, text string, fp string, id int").repartition(6)


@pytest.mark.parametrize("chunk,slack", [(1 << 17, 12), (16, 1)])  # short chunks and fingerprints: many packets, false suspects
def test_groups_equal_brute_force(spark, monkeypatch, chunk, slack):
    monkeypatch.setattr(E, "CHUNK", chunk)
    monkeypatch.setattr(E, "SLACK", slack)
    rows = make()
    assert sorted(map(tuple, E.groups(frame(spark, rows)).collect()), key=repr) == brute(rows)


def test_one_row_of_each_text_stays(spark):
    rows = make()
    kept = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in E.keep_one(frame(spark, rows)).collect())
    assert kept == sorted((k is None, k or 0, t) for k, t in {(r[1], text) for text in {t or "" for _, t in rows} for r in brute([x for x in rows if (x[1] or "") == text])})


def test_codes_are_read_back():
    rng = np.random.default_rng(1)
    for n, top in ((0, 10), (1, 10), (5, 6), (300, 1 << 20), (1000, 1 << 60)):
        values = np.unique(rng.integers(0, top, n, dtype=np.uint64))
        bits, code = E.golomb(values)
        assert (E.degolomb(len(values), bits, code) == values).all()
    dense = np.sort(rng.choice(1 << 24, 1 << 12, replace=False)).astype(np.uint64)
    assert len(E.golomb(dense)[1]) * 8 < 15 * len(dense)  # twelve bits of gap and about 1.5 more


def test_empty_table(spark):
    assert E.groups(frame(spark, make()).limit(0)).count() == 0 and E.keep_one(frame(spark, make()).limit(0)).count() == 0
