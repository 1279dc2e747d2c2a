"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

Texts are lower-cased, ASCII punctuation and blanks separate words, and shingles have five words (an
item of fewer words is one shingle of its own length). An item is found in a document that holds at
least ``CONTAINMENT`` of its distinct shingles.

Items are partitioned by their number of shingles. For the partition of size L a document is read in
windows of L shingles that start at every eighth shingle, so an item lies whole in some window and
makes up a fixed share of it. Each window has ``PERMUTATIONS`` MinHash values, a band of one row each:
a random window shares a value only when it shares a shingle, so bands of one row stay selective, and
an item's window is missed with a probability below ``(1 - J) ** PERMUTATIONS``, 1e-7 for the lowest
similarity J (0.235) that a partition leaves. Items of fewer than ten shingles have windows of one
shingle. A passage whose shingles are scattered over a document is found when one window holds enough.
Candidates are verified by exact containment of the shingle texts in the whole document.

The items are a query set: they are broadcast in blocks of bounded size, each met by all documents in
one pass without a shuffle.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import shingle_hashes, small_batches, spans, texts

WIDTH = 5
CONTAINMENT = 0.8
PERMUTATIONS = 64
STEP = 8  # shingles between the starts of two windows
SMALL = 10  # items with fewer shingles
#: Bounds of one broadcast block of items.
BLOCK_ITEMS, BLOCK_CHARS = 4096, 16 << 20

_SEED = 42
_ODD = np.random.default_rng(11).integers(0, 1 << 63, (2, PERMUTATIONS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LAST = np.uint64((1 << 64) - 1)
_WORD = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.decode().lower().encode().translate(_WORD).split()


def shingles(words: list[bytes], width: int = WIDTH) -> set[bytes]:
    """The distinct shingles as text."""
    return {b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


class Items:
    """A block of items, ready for search."""

    def __init__(self, rows: list[Row]):
        self.ids = [r[0] for r in rows]
        words = [words_of((r[1] or "").encode()) for r in rows]
        self.shingles = [shingles(w) for w in words]
        self.hashes = [np.unique(shingle_hashes(w, WIDTH, _SEED)) for w in words]
        self.short = defaultdict(lambda: defaultdict(list))  # by words, by the text of the item
        self.small = defaultdict(list)  # by shingle hash
        self.large = defaultdict(lambda: defaultdict(list))  # by window blocks, by MinHash value
        for i, w in enumerate(words):
            if 0 < len(w) < WIDTH:
                self.short[len(w)][b" ".join(w)].append(i)
            elif 0 < len(self.hashes[i]) < SMALL:
                for h in self.hashes[i].tolist():
                    self.small[h].append(i)
            elif len(self.hashes[i]):
                blocks = 1
                while blocks * STEP < len(w) - WIDTH + STEP:
                    blocks *= 2
                for p, value in enumerate((self.hashes[i][:, None] * _ODD[0] + _ODD[1]).min(axis=0).tolist()):
                    self.large[blocks][p, value].append(i)
        self.short, self.small, self.large = ({k: dict(v) for k, v in self.short.items()}, dict(self.small),
                                              {k: dict(v) for k, v in self.large.items()})
        # bit tables let almost all window values pass by without a lookup
        self.masks = {}
        for blocks, keys in self.large.items():
            bits = max(16, min(24, (64 * len(keys)).bit_length()))
            self.masks[blocks] = np.zeros(1 << bits, bool)
            self.masks[blocks][np.array([v for _, v in keys], np.uint64) & np.uint64((1 << bits) - 1)] = True
        self.small_hashes = np.array(sorted(self.small), np.uint64)

    def _candidates(self, hashes: list[np.ndarray]) -> dict[int, set[int]]:
        """Items per document that share a MinHash value with a window of it."""
        found = defaultdict(set)
        if len(self.small_hashes):
            for doc, own in enumerate(hashes):
                for h in own[np.isin(own, self.small_hashes)].tolist():
                    found[doc].update(self.small[h])
        if not self.large:
            return found
        blocks = np.array([-(-len(h) // STEP) for h in hashes])
        total, ends = int(blocks.sum()), np.cumsum(blocks)
        if not total:
            return found
        owner = np.repeat(np.arange(len(hashes)), blocks)
        last = (ends - 1)[owner]
        grid = np.empty((total, STEP), np.uint64)
        flat = grid.reshape(-1)
        for doc, own in enumerate(hashes):
            if len(own):
                start = (ends[doc] - blocks[doc]) * STEP
                flat[start:start + len(own)] = own
                flat[start + len(own):ends[doc] * STEP] = own[-1]
        columns = np.ascontiguousarray(grid.T)
        at = np.arange(total)
        for p in range(PERMUTATIONS):
            low = columns[0] * _ODD[0, p] + _ODD[1, p]
            for column in columns[1:]:
                np.minimum(low, column * _ODD[0, p] + _ODD[1, p], out=low)
            size = 1
            while True:
                if size in self.large:
                    mask, keys = self.masks[size], self.large[size]
                    for i in np.flatnonzero(mask[low & np.uint64(len(mask) - 1)]).tolist():
                        found_here = keys.get((p, int(low[i])))
                        if found_here:
                            found[int(owner[i])].update(found_here)
                if size >= max(self.large):
                    break
                # a window that would pass the end of its document stays as it is
                low = np.minimum(low, low[np.where(at + size <= last, at + size, at)])
                size *= 2
        return found

    def search(self, documents: list[bytes], containment: float = CONTAINMENT) -> list[list[tuple[int, float]]]:
        """Per document the items it holds, with their containment."""
        words = [words_of(d) for d in documents]
        hashes = [shingle_hashes(w, WIDTH, _SEED) for w in words]
        out: list[list[tuple[int, float]]] = [[] for _ in documents]
        for doc, items in self._candidates(hashes).items():
            starts, ends = spans(words[doc])
            joined = b" ".join(words[doc])
            for i in sorted(items):
                at = np.flatnonzero(np.isin(hashes[doc], self.hashes[i]))
                if len(words[doc]) < WIDTH:
                    own = {joined}
                else:
                    own = {joined[starts[j]:ends[j + WIDTH - 1]] for j in at.tolist()}
                share = len(own & self.shingles[i]) / len(self.shingles[i])
                if share >= containment:
                    out[doc].append((i, share))
        for n, known in self.short.items():
            for doc, w in enumerate(words):
                runs = {b" ".join(w[i:i + n]) for i in range(len(w) - n + 1)}
                out[doc] += [(i, 1.0) for run in runs & known.keys() for i in known[run]]
        return out


def _blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[Items]:
    rows = items.select(items[id_col].alias("item"), items[text_col].cast("string").alias("text"))
    size = rows.agg(F.count("text").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    blocks = max(1, -(-size.n // BLOCK_ITEMS), -(-size.chars // BLOCK_CHARS))
    for block in range(blocks):
        part = rows.where(F.col("text").isNotNull() & (F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block))
        yield Items(sorted(part.collect(), key=lambda r: (r.item is None, r.item, r.text)))


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", containment: float = CONTAINMENT) -> DataFrame:
    """``id, item, containment`` for every document row and item it holds.

    Texts without words hold nothing and are held by nothing. Rows that repeat give a row each; ids may be NULL.
    """
    shaped = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kinds = [shaped.schema["id"].dataType.simpleString(), items.schema[item_col].dataType.simpleString()]
    item_type = to_arrow_type(items.schema[item_col].dataType)
    schema = f"id {kinds[0]}, item {kinds[1]}, containment double"
    found = None
    for block in _blocks(items, item_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in small_batches(batches, 256):
                hits = [(doc, shared.value.ids[i], share) for doc, own in enumerate(shared.value.search(texts(batch.column(1)), containment))
                        for i, share in own]
                if hits:
                    owners, item, share = zip(*hits)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owners)), pa.array(item, item_type), pa.array(share)], ["id", "item", "containment"])

        part = shaped.mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    return found


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text", containment: float = CONTAINMENT) -> DataFrame:
    """The rows that hold no item, columns unchanged. One pass per block of items, no shuffle."""
    at = docs.columns.index(text_col)
    for block in _blocks(items, item_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in small_batches(batches, 256):
                yield batch.filter(pa.array([not own for own in shared.value.search(texts(batch.column(at)), containment)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
