from collections import defaultdict

from pyspark.sql import functions as F

from tidemark.llm import line_spread as L


def brute(rows, least):
    bare = lambda x: x.strip(" \t\r\x0b\x0c")
    sites, first = defaultdict(set), {}
    order = lambda key, pos: (key is not None, key or 0, pos)
    for key, text, site in rows:
        for pos, line in enumerate((text or "").split("\n")):
            if bare(line):
                sites[bare(line)].add(site)
                first[bare(line)] = min(first.get(bare(line), order(key, pos)), order(key, pos))
    out = []
    for key, text, site in rows:
        if text is None:
            out.append((key, None, 0))
            continue
        lines = text.split("\n")
        kept = [x for pos, x in enumerate(lines) if not (bare(x) and len(sites[bare(x)]) >= least and first[bare(x)] != order(key, pos))]
        out.append((key, "\n".join(kept), len(lines) - len(kept)))
    return sorted(out, key=str)


def rows():
    out = [(i, f"own {i}\n Menu \n\nshared {i % 6}\nMenu\nfooter {i % 3}", f"site{i % 17}") for i in range(60)]
    return out + [(100, None, "a"), (101, "", "b"), (102, "Menu\nMenu", None), (None, "Menu\nx", "c"), (None, "Menu\nx", "c"),
                  (5, "other text\nMenu", "d"), (5, "other text\nMenu", "d"), (103, "\n".join(f"l{i % 50_000}" for i in range(100_000)), "e")]


def test_equals_exact_counts(spark):
    docs = spark.createDataFrame(rows(), "doc_id bigint, text string, source string").withColumn("n_removed", F.lit(1)).withColumn("pos", F.lit(2))
    for least in (3, 10, 18, 19):
        out = L.strip_boilerplate(docs, min_sites=least)
        assert out.columns == [*docs.columns, "_n_removed"]
        assert sorted(((r.doc_id, r.text, r._n_removed) for r in out.collect()), key=str) == brute(rows(), least)


def test_near_threshold_lines_are_counted_exactly(spark):
    # more sites than a sketch counts exactly, and lines just below and at the threshold
    base = spark.range(3000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("source"),
                                    F.concat(F.lit("all"), F.when(F.col("id") < 2500, F.lit("\nat")).otherwise(F.lit("")),
                                             F.when(F.col("id") < 2499, F.lit("\nbelow")).otherwise(F.lit(""))).alias("text"))
    out = {r.doc_id: r.text for r in L.strip_boilerplate(base, min_sites=2500).collect()}
    assert out[0] == "all\nat\nbelow" and out[7] == "below" and out[2999] == ""


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert L.strip_boilerplate(docs).count() == 0
