"""SimHash near-duplicates found by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments A (23 bits), B (23) and C (18). Up to three differing
bits leave one of two cases:

* some two segments differ by one bit at most together: one of them, X, is equal, the other, Y, is
  within one bit. Key: all bits of X and the codeword index of Y (six ordered pairs X, Y);
* each segment differs by exactly one bit: half of B and half of C are equal, A is within one bit.
  Key: those halves and the codeword index of A (four choices of halves).

One side of the join carries the index its segment decodes to, the other the indices of all words
within one bit, so both meet. A pair is emitted under the first rule that fits it only, after its
distance is verified, so each link comes out once. Keys hold 33 to 35 bits; work per fingerprint is
constant (10 index rows, about 57 probe rows).
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import golay
from .common import first_rows, materialise, row_key, shingle_hashes, small_batches, texts
from .components import components

SEED = 42
DISTANCE = 3
_A, _B, _C = (1 << 23) - 1, ((1 << 23) - 1) << 23, ((1 << 18) - 1) << 46
_SEGMENTS = [(0, 23), (23, 23), (46, 18)]  # shift and bits of A, B, C
_PAIRS = [(x, y) for x in range(3) for y in range(3) if x != y]
_HALVES = [((23, 12), (46, 9)), ((23, 12), (55, 9)), ((35, 11), (46, 9)), ((35, 11), (55, 9))]
_RULE = 40  # a key holds its rule above this bit


def _mask(shift: int, bits: int) -> int:
    return ((1 << bits) - 1) << shift


def simhash(text: bytes, words_per_shingle: int = 3) -> int:
    """Fingerprint of a UTF-8 text: majority bits of the XXH64 of its word shingles, A-Z lower-cased."""
    words = text.lower().split()
    if not words:
        return 0
    hashes = shingle_hashes(words, words_per_shingle, SEED)
    last = len(hashes)
    ones = np.zeros(64, np.int64)
    for at in range(0, last, 1 << 16):
        part = hashes[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << int(b) for b in np.flatnonzero(ones * 2 > last))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3) -> DataFrame:
    """``id, fp`` per row (``fp`` as a signed long). NULL and wordless texts have fingerprint zero."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found = np.array([simhash(t, words_per_shingle) for t in texts(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["id", "fp"])

    ids = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    return ids.mapInArrow(run, f"id {ids.schema['id'].dataType.simpleString()}, fp bigint")


def _keys(fp: np.ndarray, probe: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Key and fingerprint rows of unsigned fingerprints."""
    cut = [((fp >> np.uint64(s)) & np.uint64(_mask(0, n))).astype(np.int64) for s, n in _SEGMENTS]
    part = lambda shift, bits: ((fp >> np.uint64(shift)) & np.uint64(_mask(0, bits))).astype(np.int64)
    near = [golay.near_indices(c, n) if probe else (np.arange(len(fp)), golay.index(c))
            for c, (_, n) in zip(cut, _SEGMENTS)]
    for rule, (x, y) in enumerate(_PAIRS):
        rows, codes = near[y]
        yield (rule << _RULE) | (cut[x][rows] << 12) | codes, fp[rows]
    rows, codes = near[0]
    for rule, (b, c) in enumerate(_HALVES, len(_PAIRS)):
        yield (rule << _RULE) | (part(*b)[rows] << 21) | (part(*c)[rows] << 12) | codes, fp[rows]


def _key_rows(fps: DataFrame, probe: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 4096):
            fp = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for keys, owners in _keys(fp, probe):
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(owners.view(np.int64))], ["key", "fp"])

    return fps.select("fp").mapInArrow(run, "key bigint, fp bigint")


def _first_rule(x: str) -> str:
    """SQL for the first rule under which fingerprints that differ by ``x`` share a key."""
    masks = [_A, _B, _C - (1 << 64)]  # as signed longs
    cases = [f"WHEN ({x} & {masks[a]}L) = 0 AND bit_count({x} & {masks[b]}L) <= 1 THEN {rule}L"
             for rule, (a, b) in enumerate(_PAIRS)]
    for rule, (b, c) in enumerate(_HALVES, len(_PAIRS)):
        both = _mask(*b) | _mask(*c)
        both -= (1 << 64) if both >> 63 else 0
        cases.append(f"WHEN ({x} & {both}L) = 0 AND bit_count({x} & {_A}L) <= 1 THEN {rule}L")
    return f"CASE {' '.join(cases)} END"


def links(fps: DataFrame) -> DataFrame:
    """``u, v`` (u < v) for every two distinct fingerprints in ``fps(fp)`` that differ by 1 to 3 bits."""
    probe = _key_rows(fps, True).withColumnRenamed("fp", "u")
    index = _key_rows(fps, False).withColumnRenamed("fp", "v")
    linked = f"p.u < i.v AND bit_count(p.u ^ i.v) <= {DISTANCE} AND {_first_rule('(p.u ^ i.v)')} = shiftright(p.key, {_RULE})"
    return probe.alias("p").join(index.alias("i"), (F.col("p.key") == F.col("i.key")) & F.expr(linked)).select("u", "v")


def _owners(rows: DataFrame) -> DataFrame:
    """``fp, id, root`` per distinct fingerprint of ``rows(id, fp)``: its smallest id and the name of its component."""
    # partial minima before the shuffle: a group of copies travels as one row per task
    nodes = materialise(rows.groupBy("fp").agg(F.min("id").alias("id")), "nodes")
    roots = components(links(nodes))
    return nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "id", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words_per_shingle: int = 3) -> DataFrame:
    """``id, fp, component`` per row: ``component`` is the smallest id reachable over links.

    Rows with equal fingerprints are one node, so copies are never paired with each other. Rows with
    a NULL id take part; a component of such rows only has component NULL. An empty table gives no rows.
    """
    rows = materialise(fingerprints(docs, id_col, text_col, words_per_shingle), "fingerprints")
    owner = _owners(rows)
    best = owner.groupBy("root").agg(F.min("id").alias("component"))
    named = owner.join(best, "root").select(F.col("fp").alias("node"), "component")
    return rows.join(named, rows.fp == named.node, "left").select("id", "fp", "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3) -> DataFrame:
    """The rows of ``docs`` with one row per component: that of the smallest id.

    Rows with a NULL id go when their component has an id; of a component without ids one row stays.
    Rows that repeat an id with another text are rows of their own; of rows that repeat id and text one stays.
    Columns are unchanged.
    """
    keyed = docs.select(F.struct(docs[id_col].alias("id"), row_key(docs, id_col, text_col).alias("key")).alias("row"), docs[text_col].alias("text"))
    rows = materialise(fingerprints(keyed, "row", "text", words_per_shingle), "fingerprints")
    named = _owners(rows).select(F.col("fp").alias("node"), "root")
    found = rows.join(named, rows.fp == named.node).select("id.id", "id.key", "root")
    return first_rows(docs, materialise(found, "components"), id_col, text_col)
