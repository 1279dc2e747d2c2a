"""Small helpers the text operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and go on from the written copy.

    This cuts the lineage: a lost executor costs the tasks after the copy, not those before it.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """A string column as UTF-8 bytes; NULL is the empty text."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``rows``, so that per-batch work arrays stay small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def spans(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word in ``b" ".join(words)``."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    return ends - lengths, ends


def shingle_hashes(words: list[bytes], width: int, seed: int) -> np.ndarray:
    """XXH64 of every run of ``width`` words joined by spaces; of all words when there are fewer."""
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(joined, seed)] if words else [], np.uint64)
    starts, ends = spans(words)
    last = len(words) - width + 1
    return np.fromiter((digest(joined[s:e], seed) for s, e in zip(starts[:last].tolist(), ends[width - 1:].tolist())), np.uint64, last)


def row_key(df: DataFrame, id_col: str, text_col: str) -> Column:
    """A key that tells rows apart which repeat an id with another text."""
    return F.xxhash64(df[id_col].isNull(), df[id_col], df[text_col].isNull(), df[text_col])


def first_rows(docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` with one row per group of ``found(id, key, root)``, that of the smallest (id, key).

    ``key`` is the row's ``row_key``. NULL ids come last; of rows that repeat id and text one stays.
    """
    best = materialise(found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("best")), "best")
    stays = F.col("id").eqNullSafe(F.col("best.id")) & (F.col("key") == F.col("best.key"))
    losers = found.join(best, "root").where(~stays).select(F.col("id").alias("__loser"), F.col("key").alias("__key")).distinct()
    match = docs[id_col].eqNullSafe(F.col("__loser")) & (row_key(docs, id_col, text_col) == F.col("__key"))
    kept = docs.join(losers, match, "left_anti")
    again = materialise(found.groupBy(F.col("id").alias("__loser"), F.col("key").alias("__key")).count().where("count > 1").drop("count"), "repeated")
    if again.isEmpty():
        return kept
    # only rows that repeat are dealt out by their texts
    once = kept.join(again, match, "left_anti")
    return once.unionByName(kept.join(again, match, "left_semi").dropDuplicates([id_col, text_col]))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it while a column of ``df`` is called that."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
