"""Quality classifier: votes of the nearest labelled latent-semantic vectors.

A text becomes counts of terms of its form (triples of character classes, word lengths, repeats of
words and word triples, size), weighted by their rate and rarity and projected on the leading
singular vectors of a labelled sample. The sample's vectors are broadcast; the cosines of every text
to all of them are exact products in blocks, and the nearest vote with a weight that falls with
distance and undoes the balancing of the sample.

The sample has at most ``per_class`` rows of each label, those with the smallest hash of their id;
with ``DIMENSIONS`` numbers each that bounds the model to a few MB at any table size. Score and sample
do not depend on how rows are partitioned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, texts

PER_CLASS = 2048
DIMENSIONS = 64
NEIGHBOURS = 25
SHARPNESS = 8  # weight of a vote: cosine to this power
THRESHOLD = 0.3

# character classes: blank, newline, lower, upper, digit, full stop, comma, !?, bar, symbol, other, not ASCII
_CLASS = np.full(256, 10, np.int64)
for _number, _members in ((0, b" \t\x0b\x0c\r"), (1, b"\n"), (5, b"."), (6, b","), (7, b"!?"), (8, b"|"), (9, b"#*$%&<>"),
                          (4, b"0123456789"), (2, bytes(range(97, 123))), (3, bytes(range(65, 91))), (11, bytes(range(128, 256)))):
    _CLASS[list(_members)] = _number
_TRIPLES, _LENGTHS, _STEPS = 12 ** 3, 31, (1, 2, 4, 8, 16)
TERMS = _TRIPLES + _LENGTHS + len(_STEPS) + 1 + 40


def terms(text: bytes) -> np.ndarray:
    """Term counts of one UTF-8 text."""
    kinds = _CLASS[np.frombuffer(b" " + text + b" ", np.uint8)]
    triples = np.bincount(kinds[:-2] * 144 + kinds[1:-1] * 12 + kinds[2:], minlength=_TRIPLES)
    words = text.split()
    n, seen = len(words), {}
    lengths = np.bincount(np.minimum(np.fromiter(map(len, words), np.int64, n), _LENGTHS - 1), minlength=_LENGTHS)
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    repeats = [np.count_nonzero(ids[step:] == ids[:-step]) for step in _STEPS]
    again = 0
    if n > 3:
        pairs = np.unique(ids[:-1] * len(seen) + ids[1:], return_inverse=True)[1]
        again = n - 2 - len(np.unique(pairs[:-1] * len(seen) + ids[2:]))
    size = np.bincount([min(39, int(2 * np.log2(n + 1)))], minlength=40)
    return np.concatenate([triples, lengths, repeats, [again], size]).astype(np.float32)


def _rates(counts: np.ndarray) -> np.ndarray:
    return np.log1p(1000 * counts / (counts.sum(axis=1, keepdims=True) + 1))


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


@dataclass
class Model:
    """``vectors`` of the sample with their ``labels`` and vote ``weights``; empty without labelled rows."""

    rarity: np.ndarray
    centre: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    weights: np.ndarray

    def project(self, counts: np.ndarray) -> np.ndarray:
        return _unit((_unit(_rates(counts) * self.rarity) - self.centre) @ self.basis)

    def scores(self, counts: np.ndarray, neighbours: int = NEIGHBOURS, block: int = 256) -> np.ndarray:
        """Share of the votes for label 1, 0 to 1; 0.5 without labelled rows."""
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        k, out = min(neighbours, len(self.labels)), []
        for at in range(0, len(counts), block):
            cosines = self.project(counts[at:at + block]) @ self.vectors.T
            nearest = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            close = np.maximum(np.take_along_axis(cosines, nearest, axis=1), 1e-3).astype(float) ** SHARPNESS
            votes = close * self.weights[nearest]
            out.append((votes * self.labels[nearest]).sum(axis=1) / votes.sum(axis=1))
        return np.round(np.clip(np.concatenate(out), 0, 1), 6) if out else np.zeros(0)


def fit_vectors(counts: np.ndarray, labels: np.ndarray, totals: dict[int, int], dimensions: int = DIMENSIONS) -> Model:
    """Model from the sample's counts; ``totals`` are the labelled rows of each label in the whole table."""
    rarity = (np.log((len(counts) + 1) / ((counts > 0).sum(axis=0) + 1)) + 1).astype(np.float32)
    rows = _unit(_rates(counts) * rarity)
    centre = rows.mean(axis=0) if len(rows) else np.zeros(TERMS, np.float32)
    centred = rows - centre
    values, vectors = np.linalg.eigh((centred.T @ centred).astype(np.float64))
    basis = vectors[:, ::-1][:, :dimensions].astype(np.float32)
    weights = np.array([totals[int(y)] / (labels == y).sum() for y in labels], float)
    model = Model(rarity, centre, basis, np.zeros((0, dimensions), np.float32), labels.astype(float), weights)
    if len(counts):
        model.vectors = model.project(counts)
    return model


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", per_class: int = PER_CLASS, dimensions: int = DIMENSIONS) -> Model:
    """Fit on the labelled rows for which ``learn`` (over the columns of ``labels``) holds.

    An id labelled both ways counts as 0; of documents that repeat an id the smallest text is taken.
    """
    known = (labels.where(learn & labels[label_col].isin(0, 1) & labels[id_col].isNotNull())
             .groupBy(labels[id_col].alias("id")).agg(F.min(label_col).cast("int").alias("label")))
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    wanted = None
    for label in sorted(totals):
        part = known.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(per_class)
        wanted = part if wanted is None else wanted.unionByName(part)
    if wanted is None:
        return fit_vectors(np.zeros((0, TERMS), np.float32), np.zeros(0), {})
    rows = docs.select(docs[id_col].alias("doc"), docs[text_col].cast("string").alias("text"))
    # at most two times per_class ids, so the sample is a bounded lookup
    sample = (rows.join(F.broadcast(wanted), F.col("doc") == F.col("id")).groupBy("id", "label").agg(F.min("text").alias("text")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            counts = [terms(t).astype("<f4").tobytes() for t in texts(batch.column(2))]
            yield pa.RecordBatch.from_arrays([pa.array(batch.column(0).cast(pa.string())), batch.column(1), pa.array(counts, pa.binary())],
                                             ["id", "label", "counts"])

    found = sorted(sample.mapInArrow(count, "id string, label int, counts binary").collect(), key=lambda r: r.id)
    counts = np.array([np.frombuffer(r.counts, "<f4") for r in found], np.float32).reshape(-1, TERMS)
    return fit_vectors(counts, np.array([r.label for r in found]), totals, dimensions)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score`` of every row; NULL texts score as empty ones. One pass, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 256):
            counts = np.array([terms(t) for t in texts(batch.column(1))], np.float32).reshape(-1, TERMS)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.scores(counts))], ["id", "score"])

    shaped = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    return shaped.mapInArrow(run, f"id {shaped.schema['id'].dataType.simpleString()}, score double")


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose text scores ``threshold`` or more, columns unchanged. One pass, no shuffle."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 256):
            counts = np.array([terms(t) for t in texts(batch.column(at))], np.float32).reshape(-1, TERMS)
            yield batch.filter(pa.array(shared.value.scores(counts) >= threshold))

    return docs.mapInArrow(run, docs.schema)
