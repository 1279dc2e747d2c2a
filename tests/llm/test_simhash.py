import random
import re

import pytest
import xxhash

from tidemark.llm import simhash as S


def brute(rows):
    """Fingerprints and components by comparing all pairs."""
    def fingerprint(text):
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        if not words:
            return 0
        shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    fps = [fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group] if old != new else group
    ids = {g: min((rows[j][0] for j in range(len(rows)) if group[j] == g and rows[j][0] is not None), default=None) for g in set(group)}
    return {(key, fps[i], ids[group[i]]) for i, (key, _) in enumerate(rows)}


def result(df):
    return {(r.id, r.fp % (1 << 64), r.component) for r in df.collect()}


def texts():
    rng = random.Random(7)
    words = ["w%d" % i for i in range(300)]
    rows, key = [], 0
    for _ in range(12):
        base = rng.choices(words, k=rng.choice([4, 60, 300]))
        for _ in range(rng.choice([1, 4, 9])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((key, " ".join(copy)))
            key += 1
    return rows + [(key, None), (key + 1, ""), (key + 2, " \t\n"), (key + 3, "ONE two"), (key + 4, "one  Two"),
                   (None, "one two"), (None, None), (key, None), (key + 5, "É\x1cx y " * 20), (key + 6, "é\x1cx y " * 20),
                   (key + 7, "long text " * 40_000)]


def test_components_equal_brute_force(spark):
    rows = texts()
    assert result(S.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))) == brute(rows)


def test_links_of_all_error_patterns(spark):
    rng = random.Random(3)
    base = rng.getrandbits(64)
    fps = {base} | {base ^ sum(1 << b for b in rng.sample(range(64), n)) for n in (1, 2, 3, 4) for _ in range(60)}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    found = [(r.u % (1 << 64), r.v % (1 << 64)) for r in S.links(spark.createDataFrame([(signed(f),) for f in fps], "fp bigint")).collect()]
    wanted = {frozenset((a, b)) for a in fps for b in fps if 0 < bin(a ^ b).count("1") <= 3}
    assert {frozenset(p) for p in found} == wanted and len(found) == len(wanted)


def test_keep_one_and_edge_tables(spark):
    rows = [(5, "a b c d", "x"), (2, "a b c d", "y"), (2, "a b c d", "y"), (9, None, None), (None, "", "z"), (7, "q r s t u", "k")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, id string")
    assert sorted((r.doc_id, r.id) for r in S.keep_one(docs).collect()) == [(2, "y"), (7, "k"), (9, None)]
    assert S.keep_one(docs.limit(0)).count() == 0
    assert S.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_equals_brute_force(spark, sf):
    from tidemark.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {(r.doc_id, int(r.fingerprint, 16), r.component_id) for r in QUERIES["op8_simhash_near_duplicates"](spark, sf).collect()}
    assert got == brute(rows)
