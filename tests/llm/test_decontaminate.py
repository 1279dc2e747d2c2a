import random

from pyspark.sql import functions as F

from tidemark.llm import decontaminate as D


def runs(words, n):
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def brute(docs, items, threshold=0.8):
    out, wanted = set(), []
    for item, text in items:
        words = D.words_of((text or "").encode())
        if words:
            wanted.append((item, min(5, len(words)), runs(words, min(5, len(words)))))
    for key, text in docs:
        words = D.words_of((text or "").encode())
        own = {n: runs(words, n) for n in range(1, 6)}
        for item, n, need in wanted:
            share = len(need & own[n]) / len(need)
            if share >= threshold:
                out.add((key, item, share))
    return out


def data():
    rng = random.Random(9)
    word = lambda: rng.choice("bcdfgklmn") + rng.choice("aeiou") + rng.choice("strnl") + rng.choice("aeiouéß")
    text = lambda n: [word() for _ in range(n)]
    items = [(i, text(n)) for i, n in enumerate([1, 3, 4, 5, 6, 9, 13, 14, 15, 20, 29, 30, 31, 40, 61, 62, 63, 90, 200, 700])]
    docs = []
    for i in range(150):
        body = text(rng.choice([0, 3, 40, 400, 3000]))
        for _ in range(rng.randrange(3)):
            passage = list(rng.choice(items)[1])
            if rng.random() < 0.4:
                passage[rng.randrange(len(passage))] = "changed"
            at = rng.randrange(len(body) + 1)
            body[at:at] = passage
        joined = rng.choice([" ", "\n", ", "]).join(body)
        docs.append((i, joined.upper() if i % 7 == 0 else joined))
    shown = [(i, " ".join(w).capitalize() + ".") for i, w in items]
    return docs, shown + [(90, None), (91, "  !"), (3, shown[3][1]), (None, shown[12][1])]


def test_search_equals_brute_force(spark):
    docs, items = data()
    docs += [(200, None), (201, ""), (None, items[9][1]), (5, docs[5][1]), (300, ("x y z " * 30_000) + items[10][1])]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("item_id", F.lit(1)).withColumn("id", F.lit("a"))
    found = D.search(frame, spark.createDataFrame(items, "item_id int, text string")).collect()
    assert {(r.id, r.item, r.containment) for r in found} == brute(docs, items)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs, items = data()
    frame, wanted = spark.createDataFrame(docs[:60], "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(D, "BLOCK_ITEMS", 9)
    assert {(r.id, r.item, r.containment) for r in D.search(frame, wanted).collect()} == brute(docs[:60], items)


def test_drop_and_empty_tables(spark):
    docs, items = data()
    frame, wanted = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    kept = D.drop_contaminated(frame, wanted)
    dirty = {key for key, *_ in brute(docs, items)}
    assert kept.columns == frame.columns and sorted(r.doc_id for r in kept.collect()) == [k for k, _ in docs if k not in dirty]
    assert D.search(frame.limit(0), wanted).count() == 0 and D.search(frame, wanted.limit(0)).count() == 0
    assert D.drop_contaminated(frame, wanted.limit(0)).count() == len(docs)
