"""Importance resampling towards a target distribution.

Texts become arrays of hashed word runs. A bucket's gain is the logarithm of how much more often the target uses it than
the corpus does, both smoothed; a text's weight is the sum of the gains at its array's entries. Gumbel noise drawn
from the id turns weights into scores whose largest are a sample without replacement (Gumbel top-k). The cutoff
is found by bisection: each job counts exactly how many persisted scores reach each of a few probes, then ids decide ties.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, small_batches, texts
from .ranks import positions

BUCKETS = 10_000
WIDTH = 1
SEED = 2024
PERCENT = 10
MIN_WORDS = 20
#: Probes of one counting job; the interval shrinks by this factor plus one.
PROBES = 31
#: Runs a task remembers the buckets of; beyond it starts anew, which costs time only.
REMEMBERED = 200_000
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # over lower-cased UTF-8: every byte of a code point beyond ASCII
_LAST = (1 << 63) - 1


def runs(words: list[bytes], width: int) -> list[bytes]:
    """All runs of 1 to ``width`` words joined by a space."""
    out = list(words)
    for n in range(2, width + 1):
        out += [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)]
    return out


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, buckets: int = BUCKETS) -> DataFrame:
    """``id, n_words, features`` per row: the bucket of every run of words, repeats included; NULL texts have none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in small_batches(batches):
            n_words, found = [], []
            for text in texts(batch.column(1)):
                words = _WORD.findall(text.lower())
                own = runs(words, width)
                known.update((x, crc32(x) % buckets) for x in set(own) if x not in known)
                n_words.append(len(words))
                found.append(np.fromiter(map(known.__getitem__, own), np.int32, len(own)))
                if len(known) > REMEMBERED:
                    known.clear()
            ends = np.cumsum([0, *map(len, found)], dtype=np.int64)
            lists = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *found])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), lists.cast(pa.list_(pa.int32()))], ["id", "n_words", "features"])

    shaped = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    return shaped.mapInArrow(run, f"id {shaped.schema['id'].dataType.simpleString()}, n_words bigint, features array<int>")


def bucket_counts(found: DataFrame) -> DataFrame:
    """``bucket, n``: occurrences over all rows; at most as many rows as there are buckets."""
    return found.select(F.explode("features").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """A whole number per bucket from the counts of corpus and target; the only thing that goes to the driver, of fixed size."""
    totals = [side.agg(F.coalesce(F.sum("n"), F.lit(0)) + buckets).scalar().cast("double") for side in (corpus, target)]
    both = (corpus.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
            .join(F.broadcast(corpus.withColumnRenamed("n", "s")), "bucket", "left").join(F.broadcast(target.withColumnRenamed("n", "t")), "bucket", "left"))
    s, t = F.coalesce("s", F.lit(0)), F.coalesce("t", F.lit(0))
    found = both.select("bucket", F.floor(1000 * F.ln((t + 1) * totals[0] / ((s + 1) * totals[1]))).alias("gain")).collect()
    return [r.gain for r in sorted(found)]


def weights(found: DataFrame, gain: list[int]) -> DataFrame:
    """``id, n_words, n_features, weight`` per row of ``features``: the sum of the gains at its entries, by array look-up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array(gain, np.int64)
        for batch in batches:
            ends = batch.column(2).offsets.to_numpy().astype(np.int64)
            upto = np.cumsum(np.append(0, table[batch.column(2).values.to_numpy()[ends[0]:ends[-1]]]))
            ends -= ends[0]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.diff(ends)), pa.array(np.diff(upto[ends]))],
                                             ["id", "n_words", "n_features", "weight"])

    return found.mapInArrow(run, f"id {found.schema['id'].dataType.simpleString()}, n_words bigint, n_features bigint, weight bigint")


def noise(ids: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, the same for an id whenever it is drawn; a NULL id is the empty text."""
    head = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ids.cast("string"), F.lit(""))), 256), 1, 8)
    h = F.conv(head, 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def _reach(rows: DataFrame, value: str, low: int, high: int, wanted: int) -> int:
    """The largest whole number that at least ``wanted`` values of ``rows`` reach; it lies in ``low .. high``."""
    while low < high:  # at least `wanted` reach `low`
        step = max(1, -(-(high - low) // (PROBES + 1)))
        probes = list(range(low + step, high + 1, step))
        counts = rows.agg(*[F.count_if(F.col(value) >= p) for p in probes]).first()
        passed = [p for p, n in zip(probes, counts) if n >= wanted]
        failed = [p for p, n in zip(probes, counts) if n < wanted]
        low, high = max([low, *passed]), min([high, *(p - 1 for p in failed)])
    return low


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             percent: int = PERCENT, min_words: int = MIN_WORDS, width: int = WIDTH, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """``id, n_words, n_features, weight, score, rank`` per row of ``docs``; ``rank`` counts drawn rows from 1, NULL is undrawn.

    Drawn are ``percent`` of the rows of at least ``min_words`` words, rounded down, by score; of equal scores smaller ids go first
    and NULL ids last. Ids must be whole numbers. Rows that repeat an id are rows of their own; where a cutoff falls
    between such rows, any of them may go. NULL and empty texts have no features and weight 0, long texts count whole. Without rows nothing is
    returned; an empty target is the smoothing alone. Other columns are not looked at.
    """
    if docs.schema[id_col].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError("ids must be whole numbers")
    found = materialise(features(docs, id_col, text_col, width, buckets), "features")
    counts = [materialise(bucket_counts(side), "counts") for side in (found, features(target, target.columns[0], target_col, width, buckets))]
    scored = weights(found, gains(*counts, buckets))
    scored = materialise(scored.withColumn("score", F.col("weight") + noise(F.col("id"), seed)), "scores")

    able = F.col("n_words") >= min_words
    eligible = scored.where(able)
    n, low, high = eligible.agg(F.count("*"), F.min("score"), F.max("score")).first()
    wanted = percent * n // 100
    if not wanted:
        return scored.withColumn("rank", F.lit(None).cast("bigint"))
    cutoff = _reach(eligible, "score", low, high, wanted)
    last = F.coalesce("id", F.lit(_LAST)).cast("bigint")
    tied = eligible.where(F.col("score") == cutoff).select((-last).alias("turned"))
    above = eligible.agg(F.count_if(F.col("score") > cutoff)).first()[0]
    low, high = tied.agg(F.min("turned"), F.max("turned")).first()
    bound = -_reach(tied, "turned", low, high, wanted - above)
    drawn = able & ((F.col("score") > cutoff) | ((F.col("score") == cutoff) & (last <= bound)))
    # only rows that repeat the id of the bound can make more than were wanted
    ranked = positions(scored.where(drawn), [F.col("score").desc(), F.col("id").asc_nulls_last()], "at").drop("part")
    ranked = ranked.withColumn("rank", F.when(F.col("at") < wanted, F.col("at") + 1)).drop("at")
    return scored.where(~drawn).withColumn("rank", F.lit(None).cast("bigint")).unionByName(ranked)
