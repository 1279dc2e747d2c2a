"""Quality rules with risk-controlled cutoffs.

Each rule compares one number of a text with a cutoff. A configuration holds a cutoff for every rule; configurations
form a ladder from loose to strict, whose rungs are laid by a quarter of the labelled good rows: first beyond their
largest value, then at their upper quantiles. On the other good rows, per stratum, an exact binomial test of one rung after
the other rejects "the rules together reject more than ``risk`` of the good rows", up to the first rung that fails it.
Going through a fixed sequence needs no correction over the rungs, and testing the rules together none over
the rules; the level is divided by the number of strata (Bonferroni). So, with probability ``1 - level``, in no stratum do the
rules reject more than ``risk`` of the good rows that pass the base rules. A stratum with too few
labelled rows (217 for no rejection at all, with four strata) gets no cutoffs: it rejects nothing beyond the base rules.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import materialise, small_batches, texts

RISK = 0.02
LEVEL = 0.05
MIN_WORDS = 50
#: Numbers a rule tests, each a whole number; high values speak against a text.
RULES = {
    "symbols": "1000 * n_symbols DIV word_chars",
    "repeats": "1000 * n_repeat_words DIV n_words",
    "dup_lines": "1000 * n_dup_lines DIV n_lines",
    "capitals": "1000 * n_capitals DIV word_chars",
    "long_words": "10 * word_chars DIV n_words",
    "short_words": "-(10 * word_chars DIV n_words)",
}
#: Rungs of the ladder: beyond the largest good value, by its distance from the middle one; then shares of good rows above.
MARGINS = [8, 4, 2, 1, 0.5, 0.25, 0.1, 0]
QUANTILES = [0.001, 0.002, 0.003, 0.005, 0.007, 0.01, 0.015, 0.02]
RUNGS = len(MARGINS) + len(QUANTILES)

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals"]
_BYTES = np.arange(256)
_SPACE = np.isin(_BYTES, list(b" \t\n\x0b\x0c\r"))
_CHARS = (_BYTES & 0xC0) != 0x80  # one byte of each code point
_SYMBOLS = np.isin(_BYTES, list(b"#*$%&|<>"))
_CAPITALS = (_BYTES >= ord("A")) & (_BYTES <= ord("Z"))


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a 3-word window found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    size = len(seen)
    pairs = ids[:-1] * size + ids[1:]
    if size > 2_000_000:  # the third factor would overflow
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, kind, counts = np.unique(pairs[:-1] * size + ids[2:], return_inverse=True, return_counts=True)
    twice = counts[kind] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift:n - 2 + shift] |= twice
    return int(covered.sum())


def measure(text: bytes) -> tuple[int, ...]:
    """The counts of one UTF-8 text, in the order of the columns."""
    per_byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (len(words), int(per_byte[_CHARS & ~_SPACE].sum()), int(per_byte[_SYMBOLS].sum()), len(lines) - len(set(lines)),
            repeated_words(words), len(lines), int(per_byte[_CAPITALS].sum()))


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang") -> DataFrame:
    """``id, stratum`` and the counts per row; NULL texts count as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            counts = np.array([measure(t) for t in texts(batch.column(2))], np.int64).reshape(-1, len(_COUNTS))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c) for c in counts.T)], ["id", "stratum", *_COUNTS])

    stratum = docs[stratum_col].cast("string") if stratum_col else F.lit("all")
    shaped = docs.select(docs[id_col].alias("id"), stratum.alias("stratum"), docs[text_col].cast("string").alias("text"))
    kind = shaped.schema["id"].dataType.simpleString()
    return shaped.mapInArrow(run, f"id {kind}, stratum string, " + ", ".join(f"{c} bigint" for c in _COUNTS))


def base_failed() -> Column:
    return F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words")


def allowed_failures(n: int, risk: float, level: float) -> int:
    """The largest k with P(Binomial(n, risk) <= k) <= level; -1 when not even 0 has that."""
    total, k = 0.0, -1
    while k < n:
        log = (math.lgamma(n + 1) - math.lgamma(k + 2) - math.lgamma(n - k) + (k + 1) * math.log(risk)
               + (n - k - 1) * math.log1p(-risk))
        total += math.exp(log)
        if total > level:
            break
        k += 1
    return k


def _values() -> dict[str, Column]:
    return {name: F.expr(sql) for name, sql in RULES.items()}


def ladder(laying: DataFrame) -> DataFrame:
    """``stratum, rungs``: a map from rule to its cutoffs, loose to strict, from the counts of some good rows.

    Only counts per stratum, rule and value leave the tasks.
    """
    each = F.explode(F.create_map(*[x for name, value in _values().items() for x in (F.lit(name), value)])).alias("rule", "value")
    counts = laying.select("stratum", each).groupBy("stratum", "rule", "value").count()
    own = Window.partitionBy("stratum", "rule")
    n, above = F.sum("count").over(own), F.coalesce(F.sum("count").over(own.orderBy(F.desc("value")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shares = counts.withColumn("above", above / n)
    top, middle = F.max("value"), F.min(F.when(F.col("above") <= 0.5, F.col("value")))
    rungs = [top + F.ceil(m * (top - middle)) for m in MARGINS] + [F.min(F.when(F.col("above") <= q, F.col("value"))) for q in QUANTILES]
    per_rule = shares.groupBy("stratum", "rule").agg(F.array(*rungs).alias("cutoffs"))
    return per_rule.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoffs"))).alias("rungs"))


def _beyond(rung: Column | int) -> list[Column]:
    """Names of the rules that reject a row at a rung, NULL for the others."""
    return [F.when(value > F.get(F.col("rungs")[name], F.lit(rung) if isinstance(rung, int) else rung), F.lit(name)) for name, value in _values().items()]


def choose(testing: DataFrame, strata: int, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """``stratum, n, rung``: the strictest rung of each stratum that holds the risk on its good rows; none gives no row."""
    rejects = [F.count_if(F.coalesce(*_beyond(k)).isNotNull()).alias(f"fails{k}") for k in range(RUNGS)]
    counted = testing.groupBy("stratum").agg(F.count("*").alias("n"), *rejects)

    @F.pandas_udf(T.LongType())
    def allowed(n: pd.Series) -> pd.Series:
        return n.map({x: allowed_failures(int(x), risk, level / max(1, strata)) for x in n.unique()})

    # rejections only grow along the ladder, so the last rung that holds has none failing before it
    held = counted.withColumn("allowed", allowed("n"))
    rung = F.coalesce(*[F.when(F.col(f"fails{k}") <= F.col("allowed"), F.lit(k)) for k in range(RUNGS - 1, -1, -1)])
    return held.select("stratum", "n", rung.alias("rung")).where("rung IS NOT NULL")


def judge(docs: DataFrame, labels: DataFrame, holdout: Column, id_col: str = "doc_id", text_col: str = "text",
          stratum_col: str | None = "lang", label_col: str = "quality", risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """Counts of every row with ``base_failed``, ``failed_rules`` and ``kept``.

    ``labels`` (``id_col``, ``label_col``) marks good rows with 1; those for which ``holdout`` (over the
    columns of ``labels``) holds set the cutoffs. NULL strata are a stratum of their own; an id labelled
    twice counts as good when any label says so. Rows that repeat are judged each; no rows give no rows.
    """
    counts = materialise(text_counts(docs, id_col, text_col, stratum_col), "counts").withColumn("base_failed", base_failed())
    marked = labels.where(holdout & (labels[label_col] == 1)).select(labels[id_col].alias("good")).distinct()
    good = materialise(counts.where(~F.col("base_failed")).join(marked, F.col("id") == F.col("good"), "left_semi"), "good")
    lays = F.pmod(F.xxhash64("id"), F.lit(4)) == 0
    rungs = materialise(ladder(good.where(lays)), "ladder").withColumnRenamed("stratum", "__stratum")  # a row per stratum
    same = F.col("stratum").eqNullSafe(F.col("__stratum"))
    strata = counts.select("stratum").distinct().count()
    chosen = choose(good.where(~lays).join(rungs, same), strata, risk, level).select(F.col("stratum").alias("__own"), "rung")
    limits = materialise(rungs.join(chosen, F.col("__stratum").eqNullSafe(F.col("__own"))).drop("__own"), "cutoffs")
    joined = counts.join(limits, same, "left")
    failed = F.when(F.col("base_failed") | F.col("rung").isNull(), F.array().cast("array<string>")).otherwise(F.array_compact(F.array(*_beyond(F.col("rung")))))
    return (joined.withColumn("failed_rules", failed).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
            .select(*counts.columns, "failed_rules", "kept"))
