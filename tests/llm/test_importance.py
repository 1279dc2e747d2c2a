"""Importance resampling against a plain version."""

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest

from tidemark.llm import importance as I


def features(text, width=1):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return words, [crc32(" ".join(words[i:i + n]).encode()) % I.BUCKETS for n in range(1, width + 1) for i in range(len(words) - n + 1)]


def brute(rows, target, percent=I.PERCENT, width=1):
    own = [(key, *features(text, width)) for key, text in rows]
    s, t = Counter(b for _, _, f in own for b in f), Counter(b for text in target for b in features(text, width)[1])
    big_s, big_t = sum(s.values()) + I.BUCKETS, sum(t.values()) + I.BUCKETS
    gain = [math.floor(1000 * math.log((t[b] + 1) * float(big_s) / ((s[b] + 1) * float(big_t)))) for b in range(I.BUCKETS)]
    out = []
    for key, words, found in own:
        h = int(hashlib.sha256(f"{I.SEED}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        out.append((key, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= I.MIN_WORDS), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    rank = {r[0]: i + 1 for i, r in enumerate(able[:percent * len(able) // 100])}
    return sorted(((*r, rank.get(r[0])) for r in out), key=repr)


def make(n):
    rng = random.Random(3)
    words = ["alpha", "Beta", "é", "γ1", "x-y", "the", "THE", "42", "日本"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 60)))) for i in range(n)]
    return rows + [(-5, None), (10 ** 12, ""), (None, "alpha " * 30), (77_777, "beta\x00" * 100_000)]


@pytest.mark.parametrize("width,percent", [(1, 10), (2, 55)])
def test_equals_brute_force(spark, width, percent):
    rows, target = make(300), ["alpha beta gamma", None, "the 42"]
    docs = spark.createDataFrame([(k, t, 1, 2) for k, t in rows], "doc_id bigint, text string, score int, rank int").repartition(4)
    items = spark.createDataFrame([(str(i), t) for i, t in enumerate(target)], "item_id string, text string")
    out = I.resample(docs, items, width=width, percent=percent)
    assert sorted(map(tuple, out.collect()), key=repr) == brute(rows, target, percent, width)


def test_ties_go_to_smaller_ids(spark, monkeypatch):
    monkeypatch.setattr(I, "noise", lambda ids, seed: ids * 0)
    docs = spark.createDataFrame([(i, "same " * 25) for i in range(200)], "doc_id bigint, text string").repartition(7)
    out = I.resample(docs, docs.limit(0))
    assert sorted((r.rank, r.id) for r in out.where("rank IS NOT NULL").collect()) == [(i + 1, i) for i in range(20)]


def test_repeated_ids_empty_tables_and_refused_ids(spark):
    docs = spark.createDataFrame([(1, "same " * 25)] * 40, "doc_id bigint, text string")
    out = I.resample(docs, docs).collect()
    assert len(out) == 40 and sorted(r.rank for r in out if r.rank) == [1, 2, 3, 4]
    assert I.resample(docs.limit(0), docs).count() == 0
    with pytest.raises(ValueError):
        I.resample(docs.selectExpr("cast(doc_id AS string) AS doc_id", "text"), docs)
