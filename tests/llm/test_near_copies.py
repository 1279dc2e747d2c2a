"""The near-duplicate stage against the Jaccard similarity of all pairs."""

import random

import pytest

import corpus_pipeline as P
from tidemark.llm import near_copies as N
from tidemark.llm import simhash


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def groups(rows):
    """``id, None, smallest id of its group`` per row, from all pairs of texts."""
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if group[i] != group[j] and (a == b or len(a & b) >= 0.8 * len(a | b)):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {g: min(rows[j][0] for j in range(len(rows)) if group[j] == g) for g in set(group)}
    return {(key, None, least[group[i]]) for i, (key, _) in enumerate(rows)}


def brute(rows):
    """The ids that stay."""
    return {least for *_, least in groups(rows)}


def edited():
    rng = random.Random(11)
    words = ["w%d" % i for i in range(400)]
    rows = []
    for size in [1, 3, 5, 8, 9, 30] + [150] * 8 + [900] * 4:
        base = rng.choices(words, k=size)
        rows.append(base)
        for _ in range(7):
            copy = list(rng.choice(rows[-3:]))
            for _ in range(rng.randrange(1, 2 + len(copy) // 40)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append(copy)
    texts = [" ".join(r) for r in rows] + [None, "", " \n", "One Two", "one two", "one three"]
    return list(enumerate(rng.sample(texts, len(texts))))


def stage(spark, rows):
    docs = spark.createDataFrame([(key, text, "en", "s", 0) for key, text in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return P.near_dedup(spark, docs.repartition(3), "")


def test_stage_equals_brute_force(spark):
    rows = edited()
    found = [r.doc_id for r in stage(spark, rows).collect()]
    assert sorted(found) == sorted(brute(rows)) and len(found) < len(rows) * 3 / 4


def test_few_changed_words_are_a_near_copy(spark):
    base = ["w%d" % i for i in range(400)]
    copy = list(base)
    for at in (50, 150, 250, 350):
        copy[at] = "other"
    assert [r.doc_id for r in stage(spark, [(1, " ".join(base)), (2, " ".join(copy))]).collect()] == [1]


def test_a_group_beyond_the_smallest_node_of_a_band(spark):
    # steps of 0.9 make a long chain whose ends share next to nothing
    words = ["w%d" % i for i in range(2_000)]
    chain = [(n, " ".join(words[20 * n:20 * n + 400])) for n in range(60)]
    assert [r.doc_id for r in stage(spark, chain).collect()] == [0]


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    assert {r.doc_id for r in stage(spark, rows).collect()} == brute(rows)


def unlike_hubs(n):
    """Copies of one text with four edits each, without the text itself: most pairs of copies are below 0.8."""
    rng = random.Random(4)
    base = ["w%d" % i for i in range(300)]
    rows = []
    for _ in range(n):
        copy = list(base)
        for at in rng.sample(range(300), 4):
            copy[at] = "x%d" % rng.randrange(10 ** 9)
        rows.append(" ".join(copy))
    return list(enumerate(rows))


def test_pairs_of_a_large_group_grow_with_its_members(spark, monkeypatch):
    compared = []
    plain = N._distances

    def counted(pairs, sets):
        compared.append(pairs.count())
        return plain(pairs, sets)

    monkeypatch.setattr(N, "_distances", counted)
    totals = []
    for n in (200, 400):
        compared.clear()
        rows = unlike_hubs(n)
        assert {r.doc_id for r in stage(spark, rows).collect()} == brute(rows)
        totals.append(sum(compared))
    assert totals[1] <= 2.4 * totals[0] and totals[1] < 400 * 399 / 2 / 3, totals


def test_what_a_hub_alone_lost_costs_no_pairs(spark, monkeypatch):
    """Unlike copies of one text: each lacks words of it that nearly all others hold, the hub too."""
    met, plain = [], N._meet

    def counted(beside):
        out = plain(beside)
        met.append((out.count(), beside.count()))
        return out

    monkeypatch.setattr(N, "_meet", counted)
    rng, base, rows = random.Random(9), ["w%d" % i for i in range(300)], []
    for n in range(200):
        copy = list(base)
        for at in rng.sample(range(300), 12):
            copy[at] = "x%d" % rng.randrange(10 ** 9)
        rows.append((n, " ".join(copy)))
    # near copies of two of them, by words that no other text holds
    rows += [(200 + n, rows[n][1] + " end of it %d" % n) for n in (3, 150)]
    assert {r.doc_id for r in stage(spark, rows).collect()} == brute(rows)
    assert len(met) == 1 and met[0][0] <= N.OFTEN * met[0][1] and met[0][0] < 100_000, met


def test_lower_similarity_is_refused(spark):
    with pytest.raises(ValueError):
        N.groups(spark.createDataFrame([], "doc_id int, text string"), similarity=0.7)


@pytest.mark.parametrize("keep_one", [N.keep_one, simhash.keep_one])
def test_ids_that_repeat_with_unlike_texts(spark, keep_one):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(5, a), (5, b), (3, b), (8, a), (9, a), (6, c), (6, a + " " + c), (6, c)]
    kept = sorted((r.doc_id, r.text) for r in keep_one(spark.createDataFrame(rows, "doc_id int, text string")).collect())
    assert kept == sorted([(5, a), (3, b), (6, c), (6, a + " " + c)])


def test_sizes_that_fit_meet_by_two_classes_at_most(spark):
    sizes = [*range(1, 60), 99, 100, 124, 125, 126, 799, 800, 1000, 1250, 1251, 15_624, 15_625, 19_999, 20_000]
    fitting = spark.createDataFrame([(n, -(-4 * n // 5), 5 * n // 4, True) for n in sizes], "n int, least int, most int, apart boolean")
    reached = N._reaching(fitting.withColumn("grade", N._grade("n"))).select("n", "grade").collect()
    grades = {r.n: r.grade for r in fitting.select("n", N._grade("n").alias("grade")).collect()}
    met = {(r.n, other) for r in reached for other in sizes if grades[other] == r.grade}
    assert len(reached) <= 2 * len(sizes)
    assert met >= {(a, b) for a in sizes for b in sizes if -(-4 * a // 5) <= b <= 5 * a // 4}


def test_rows_by_band_are_written_twice_at_most(spark, monkeypatch):
    """A node has up to TABLES * PROBES bands: rounds and regrouping go by leads."""
    written, plain = [], N.materialise

    def counted(df, name):
        out = plain(df, name)
        if "band" in out.columns and name not in ("wide", "spread"):
            written.append((name, out.count()))
        return out

    monkeypatch.setattr(N, "materialise", counted)
    rows = unlike_hubs(100)
    assert {r.doc_id for r in stage(spark, rows).collect()} == brute(rows)
    assert written[0][0] == "shared" and sum(n for _, n in written) <= 2 * written[0][1], written
