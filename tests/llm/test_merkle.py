"""The manifest against a plain tree."""

import hashlib
import random

from pyspark.sql import functions as F

from tidemark.llm import merkle as M

FIELDS = ["doc_id", "source", "text"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(leaves):
    """Root and, per leaf, the (left, right) siblings of every level."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + 3])) for i in range(0, len(levels[-1]), 3)])
    paths = []
    for at in range(len(leaves)):
        path = []
        for level in levels[:-1]:
            first = at - at % 3
            path.append(("".join(level[first:at]), "".join(level[at + 1:first + 3])))
            at //= 3
        paths.append(path)
    return levels[-1][0], paths


def brute(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    subs, out = [], []
    for name in names:
        own = sorted(by_source[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        subs.append((own, *tree([leaf(r) for r in own])))
    root, upper = tree([s[1] for s in subs])
    for (own, sub, paths), above in zip(subs, upper):
        out += [(r[0], leaf(r), sub, root, tuple(path + above)) for r, path in zip(own, paths)]
    return sorted(out, key=repr)


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string").repartition(5)
    df = df.withColumn("leaf", F.lit(1)).withColumn("hex", F.lit(2)).withColumn("grp", F.lit(3))  # names the operator uses itself
    return M.manifest(df, FIELDS, **more)


def found(df):
    return sorted(((r.id, r.leaf, r.subroot, r.root, tuple((s.left, s.right) for s in r.proof)) for r in df.collect()), key=repr)


def test_trees_of_many_sizes_and_odd_rows(spark):
    rng = random.Random(2)
    rows = [(i, "hot", "t%d" % i) for i in range(81 * 81 // 9 + 5)]  # three tiers of blocks would be 81 * 81
    for n in (1, 2, 3, 4, 9, 10, 80, 81, 82, 244):
        rows += [(rng.randrange(10 ** 6), "s%d" % n, rng.choice(["", "a\nb", "é", "x" * 50_000 if n == 4 else "y"])) for _ in range(n)]
    rows += [(None, "hot", None), (7, None, "n"), (7, None, "n"), (7, None, "m"), (8, "", None), (9, "é", "z")]
    assert found(run(spark, rows)) == brute(rows)


def test_three_tiers(spark):
    rows = [(i, "only", "") for i in range(81 * 81 + 1)]
    assert found(run(spark, rows)) == brute(rows)


def test_tampering_shows_and_proofs_fold(spark):
    rows = [(i, "s%d" % (i % 3), "line\n%d" % i) for i in range(100)]
    changed = M.leaf([F.col("doc_id"), F.col("source"), F.when(F.col("doc_id") % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))])
    out = run(spark, rows, claimed=changed).withColumn("folded", M.fold(F.col("claimed"), F.col("proof"))).collect()
    assert all((r.folded == r.root) == (r.id % 2 == 1) for r in out) and len(out) == 100


def test_empty_and_single(spark):
    assert run(spark, [(1, "a", "b")]).count() == 1 and found(run(spark, [(1, None, None)])) == brute([(1, None, None)])
    assert run(spark, [(1, "a", "b")]).where("root <> leaf").count() == 0
    empty = spark.createDataFrame([], "doc_id bigint, source string, text string")
    assert M.manifest(empty, FIELDS).count() == 0
