"""Packing by power-of-two decomposition: no sequence crosses documents and none is padded.

A document of n ids is cut into pieces of ``max_length`` ids and, for the rest, one piece per set
bit of its length, longest first. Every piece is a sequence of its own; pieces of equal length
belong to one bucket, from which a trainer draws batches without padding.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

END_ID = 2
MAX_LENGTH = 4096
#: Words a worker remembers; beyond it starts anew, which costs time only.
REMEMBERED = 800_000

#: Punctuation that may close a word.
_TAIL = ".,;:!?*#%&$|"


def _listed(column: pa.Array) -> list:
    return column.to_numpy(zero_copy_only=False).tolist()


def _coded(column: pa.Array) -> tuple[list[int], list[str]]:
    """Number of each value among the distinct ones, and these."""
    coded = column.dictionary_encode()
    return _listed(coded.indices), _listed(coded.dictionary)


class WordTokens:
    """Token ids of texts, by way of the distinct words of many texts at a time.

    For a tokenizer that drops white space and never merges across it, the ids of a text are those of
    its words in order. Words of letters, without a tail of punctuation (a token run of its own), are
    encoded many at a time and told apart by their ending tokens; whatever does not fit that is
    encoded on its own.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.closing = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closing[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        #: Ids of stems (None where a word must be encoded as it is), and of whole words and tails.
        self.stems: dict[str, bytes | None] = {}
        self.whole: dict[str, bytes] = {}

    def _each(self, words: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters."""
        out: list[bytes] = []
        for at in range(0, len(words), 500):
            part = words[at:at + 500]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.closing[ids]) + 1
            if len(ends) != len(part):
                out += self._each(part)
                continue
            raw, starts = ids.tobytes(), [0, *ends[:-1].tolist()]
            out += [raw[4 * s:4 * e] for s, e in zip(starts, ends.tolist())]
        return out

    def _stems(self, stems: list[str]) -> list[bytes | None]:
        new = [s for s in stems if s not in self.stems]
        # a letter may turn into a letter and a mark, which would join the tail
        letters = [s for s in new if s.isalpha() and (s.isascii() or unicodedata.normalize("NFC", s).lower().isalpha())]
        self.stems.update(dict.fromkeys(new))
        self.stems.update(zip(letters, self._letters(letters)))
        return [self.stems[s] for s in stems]

    def _wholes(self, words: list[str]) -> list[bytes]:
        new = [w for w in dict.fromkeys(words) if w not in self.whole]
        self.whole.update(zip(new, self._each(new)))
        return [self.whole[w] for w in words]

    def _words(self, words: pa.Array) -> list[bytes]:
        """Ids of each of some distinct words."""
        if len(self.stems) + len(self.whole) > REMEMBERED:
            self.stems.clear()
            self.whole.clear()
        # lower-casing first is safe for ASCII only; other letters may compose before it
        lowered = pc.if_else(pc.string_is_ascii(words), pc.ascii_lower(words), words)
        stem = pc.ascii_rtrim(lowered, _TAIL)
        stem_of, stems = _coded(stem)
        known = self._stems(stems)
        out = [known[i] for i in stem_of]
        # few words have a tail: what the stem lacks
        cut = np.flatnonzero(pc.not_equal(pc.binary_length(stem), pc.binary_length(lowered)).to_numpy(zero_copy_only=False))
        tail_of, tails = _coded(pc.extract_regex(lowered.take(pa.array(cut)), f"(?s)(?P<tail>[{_TAIL}]+)$").field("tail"))
        ends = self._wholes(tails)
        for i, end in zip(cut.tolist(), tail_of):
            if out[i] is not None:
                out[i] += ends[end]
        odd = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(odd, self._wholes(_listed(words.take(pa.array(odd, pa.int64()))))):
            out[i] = ids
        return out

    def encode_all(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a column in a row, and where those of each text end; NULL is the empty text."""
        split = pc.ascii_split_whitespace(pc.fill_null(column, ""))
        coded = split.flatten().dictionary_encode()
        known = self._words(coded.dictionary)
        flat, sizes = np.frombuffer(b"".join(known), "<u4"), np.fromiter(map(len, known), np.int64, len(known)) // 4
        starts, word = np.cumsum(sizes) - sizes, coded.indices.to_numpy()
        own = sizes[word]
        ends = np.cumsum(own)
        ids = flat[np.repeat(starts[word] - (ends - own), own) + np.arange(own.sum())]
        return ids, np.append(0, ends)[np.cumsum(pc.list_value_length(split).to_numpy())]

    def encode(self, text: bytes) -> bytes:
        return self.encode_all(pa.array([text.decode()]))[0].tobytes()


@cache
def _word_tokens(path: str) -> WordTokens:
    """One per worker process, kept between its tasks."""
    return WordTokens(path)


def cuts(tokens: int, max_length: int = MAX_LENGTH) -> list[int]:
    """Lengths of a document's pieces: whole sequences, then the set bits of the rest, longest first."""
    rest = tokens % max_length
    return [max_length] * (tokens // max_length) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def decompose(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
              max_length: int = MAX_LENGTH, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``id, start, length, ids, doc_tokens, bucket, sequence_id, offset``.

    ``ids`` are little-endian unsigned 32-bit numbers; ``bucket`` is the power of two of the length.
    A NULL or empty text is the end id alone. Rows that repeat an id are packed on their own, rows with
    a NULL id too; no rows give no pieces. ``max_length`` must be a power of two. Everything happens in
    one pass without a shuffle; sequence ids are unique and the same when a task is run again.
    """
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, next_id = _word_tokens(tokenizer_path), TaskContext.get().partitionId() << 33
        end = np.array([end_id], "<u4").tobytes()
        for batch in small_batches(batches):
            owners, rows, upto = [], [], 0
            all_ids, ends = tokens.encode_all(batch.column(1))
            for row, stop in enumerate(ends.tolist()):
                ids, start = all_ids[upto:stop].tobytes() + end, 0
                upto, total = stop, len(ids) // 4
                for length in cuts(total, max_length):
                    owners.append(row)
                    rows.append((start, length, ids[4 * start:4 * (start + length)], total, length.bit_length() - 1, next_id))
                    start, next_id = start + length, next_id + 1
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64()))]
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owners)), *columns],
                                                 ["id", "start", "length", "ids", "doc_tokens", "bucket", "sequence_id"])

    shaped = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kind = shaped.schema["id"].dataType.simpleString()
    found = shaped.mapInArrow(run, f"id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, bucket int, sequence_id bigint")
    return found.withColumn("offset", F.lit(0).cast("bigint"))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write the pieces as Parquet, one folder per bucket."""
    pieces.write.partitionBy("bucket").parquet(path)
