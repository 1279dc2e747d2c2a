import math
import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from tidemark.llm import quality_rules as Q
from tidemark.llm.queries import QUERIES


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


def test_counts_equal_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choices(["a", "b", "É", "🙂", " ", "\n", "\t", "\x1c", "\x85", "#", "|", "ab ", "\n\n"], k=rng.randrange(80)))
        assert Q.measure(text.encode())[:5] == brute(text), repr(text)


def test_allowed_failures_is_the_exact_binomial_bound():
    cdf = lambda k, n, p: sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
    for n in (0, 1, 50, 400, 1500):
        for risk, level in ((0.01, 0.05), (0.1, 0.001)):
            k = Q.allowed_failures(n, risk, level)
            assert k == -1 or cdf(k, n, risk) <= level
            assert k == n or cdf(k + 1, n, risk) > level


def docs(spark):
    rng = random.Random(2)
    rows = []
    for i in range(900):
        words = [rng.choice("abcdefgh") * rng.randrange(2, 6) for _ in range(80)]
        bad = i % 3 == 0
        rows.append((i, " ".join(w + "#" * 3 if bad else w for w in words), "xx" if i % 2 else None, 0 if bad else 1))
    rows += [(900, None, "xx", None), (901, "", None, None), (902, "w " * 200_000, "xx", None), (None, "#$ " * 60, "xx", None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, quality int")


def test_cutoffs_catch_bad_rows_and_keep_the_risk(spark):
    df = docs(spark)
    labels = df.where("quality IS NOT NULL").select("doc_id", "quality")
    out = Q.judge(df.drop("quality"), labels, F.lit(True), risk=0.3).collect()
    assert len(out) == 904
    good = [r for r in out if r.id is not None and r.id < 900 and r.id % 3]
    bad = [r for r in out if r.id is not None and r.id < 900 and r.id % 3 == 0]
    assert sum(not r.kept for r in good) <= 0.3 * len(good)
    assert all("symbols" in r.failed_rules for r in bad)
    rest = {r.id: r for r in out if r.id is None or r.id >= 900}
    assert not rest[900].kept and rest[900].n_words == 0 and rest[902].base_failed and rest[None].base_failed


def plain_judge(rows, good, risk, level):
    """Kept ids by going up the ladder stratum by stratum; ``rows`` are judged rows, ``good`` ids of (laying, testing) rows."""
    values = {r.id: [int(x) for x in (1000 * r.n_symbols // max(1, r.word_chars), 1000 * r.n_repeat_words // max(1, r.n_words), 1000 * r.n_dup_lines // max(1, r.n_lines),
                                      1000 * r.n_capitals // max(1, r.word_chars), 10 * r.word_chars // max(1, r.n_words), -(10 * r.word_chars // max(1, r.n_words)))] for r in rows}
    strata, kept, rungs = {r.stratum for r in rows}, set(), {}
    for stratum in strata:
        own = [r for r in rows if r.stratum == stratum and not r.base_failed]
        lay, test = ([values[r.id] for r in own if r.id in part] for part in good)
        best = None
        if lay and test:
            def cut(k, column):
                column = sorted(column)
                share = lambda v: sum(x > v for x in column) / len(column)
                middle = next(v for v in column if share(v) <= 0.5)
                if k < len(Q.MARGINS):
                    return column[-1] + math.ceil(Q.MARGINS[k] * (column[-1] - middle))
                return next(v for v in column if share(v) <= Q.QUANTILES[k - len(Q.MARGINS)])
            for k in range(Q.RUNGS):
                cuts = [cut(k, c) for c in zip(*lay)]
                if sum(any(x > c for x, c in zip(v, cuts)) for v in test) > Q.allowed_failures(len(test), risk, level / len(strata)):
                    break
                best, rungs[stratum] = cuts, k
        kept |= {r.id for r in own if best is None or not any(x > c for x, c in zip(values[r.id], best))}
    return kept, rungs


def test_verdicts_of_a_whole_table_equal_the_plain_ladder(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = QUERIES["op3_quality_rules"](spark, sf)
    counts = Q.judge(spark.read.parquet(f"{sf}/documents.parquet"), labels, F.expr("crc32(cast(doc_id AS string)) % 5 <> 0"))
    judged = counts.collect()
    marked = labels.where("quality = 1 AND crc32(cast(doc_id AS string)) % 5 <> 0").selectExpr("doc_id", "pmod(xxhash64(doc_id), 4) = 0 AS lays").collect()
    kept, rungs = plain_judge(judged, ({r.doc_id for r in marked if r.lays}, {r.doc_id for r in marked if not r.lays}), Q.RISK, Q.LEVEL)
    assert {r.doc_id for r in rows.where("kept").collect()} == kept == {r.id for r in judged if r.kept}
    assert "en" in rungs and len(rungs) >= 2
    quality = {r.doc_id: r.quality for r in labels.collect()}
    beyond = [quality[r.id] for r in judged if not r.base_failed and not r.kept and r.id in quality]
    fold = [r.id for r in judged if quality.get(r.id) == 1 and not r.base_failed and zlib.crc32(str(r.id).encode()) % 5 == 0]
    wrong = len([i for i in fold if i not in kept])
    print("label 0 beyond the base rules:", beyond.count(0), "good rejected:", beyond.count(1), "fold:", wrong, len(fold), rungs)
    assert beyond.count(0) > 0
    assert wrong <= Q.RISK * len(fold) + 3 * math.sqrt(Q.RISK * len(fold))


def test_too_few_labels_reject_nothing_and_empty_tables(spark):
    df = docs(spark).drop("quality").withColumn("id", F.lit(1)).withColumn("stratum", F.lit(2))
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert all(r.kept != r.base_failed for r in Q.judge(df, none, F.lit(True)).collect())
    assert Q.judge(df.limit(0), none, F.lit(True)).count() == 0


def test_query_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = {r.doc_id: r for r in QUERIES["op3_quality_rules"](spark, sf).collect()}
    assert out.keys() == texts.keys()
    for key, text in texts.items():
        r = out[key]
        n = brute(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 50 or 100 * n[4] > 50 * n[0]) and not (r.base_failed and r.kept)
