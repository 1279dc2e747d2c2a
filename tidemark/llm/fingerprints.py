"""Exact deduplication by an exchange of compressed fingerprints.

Tasks cut their rows into chunks and send each owner of a range of fingerprints one packet per chunk: its distinct
fingerprints in that range, sorted, as Golomb-Rice coded gaps. Owners send back one bitmap per packet that marks the fingerprints other
chunks hold too. Only texts with a marked fingerprint are suspects: they alone are shuffled, grouped by their bytes.

Fingerprints in packets are short (the row count's bits and ``SLACK`` more), so a few texts are suspected in vain;
the bytes decide. A fingerprint that stands often in a chunk is sent once, so an owner sees a group of copies once per chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Rows of a chunk at most, fingerprints an owner gets about, bits of a short fingerprint beyond those of the row count.
CHUNK, OWNED, SLACK = 1 << 17, 1 << 21, 12
#: Bits of the sieve that tells which texts to shuffle, and so the bound of its broadcast: 32 MB.
SIEVE_BITS = 1 << 28


def golomb(values: np.ndarray) -> tuple[int, bytes]:
    """Remainder bits and code of ascending numbers: gaps as low bits, all of them first, and unary quotients after them."""
    gaps = np.diff(values, prepend=np.uint64(0)).astype(np.uint64)
    bits = max(0, int(np.log2(max(1.0, 0.69 * float(gaps.mean()))))) if len(gaps) else 0
    low = (gaps[:, None] >> np.arange(bits, dtype=np.uint64) & np.uint64(1)).astype(np.uint8)
    quotients = (gaps >> np.uint64(bits)).astype(np.int64)
    unary = np.zeros(int(quotients.sum()) + len(gaps), np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 1
    return bits, np.packbits(low.ravel()).tobytes() + np.packbits(unary).tobytes()


def degolomb(n: int, bits: int, code: bytes) -> np.ndarray:
    """The numbers ``golomb`` was given."""
    raw, cut = np.frombuffer(code, np.uint8), -(-n * bits // 8)
    low = np.unpackbits(raw[:cut], count=n * bits).reshape(n, bits).astype(np.uint64) << np.arange(bits, dtype=np.uint64)
    ends = np.flatnonzero(np.unpackbits(raw[cut:]))[:n]
    gaps = (np.diff(ends, prepend=-1) - 1).astype(np.uint64) << np.uint64(bits)
    return np.cumsum(gaps + low.sum(axis=1, dtype=np.uint64), dtype=np.uint64)


def _layout(n: int) -> tuple[int, int]:
    """Bits of a short fingerprint and of an owner's number for ``n`` rows."""
    return min(62, n.bit_length() + SLACK), max(6, -(-n // OWNED).bit_length())


def _chunk(rows: pa.Table, number: int, short_bits: int, owner_bits: int) -> pa.RecordBatch:
    """The prints of a chunk, one row per distinct (fingerprint, digest) with its ids, and its packets.

    Prints and packets share one layout; a print has ``ids`` and a packet has ``code``.
    """
    rows = rows.take(pc.sort_indices(rows, sort_keys=[("fp", "ascending"), ("digest", "ascending"), ("id", "ascending")], null_placement="at_start"))
    fp = rows["fp"].to_numpy().view(np.uint64)
    digests = rows["digest"].combine_chunks()
    other = np.ones(len(fp), bool)
    other[1:] = (fp[1:] != fp[:-1]) | pc.not_equal(digests[1:], digests[:-1]).to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(other)
    order = np.argsort(fp[starts], kind="stable")  # ascending as unsigned numbers
    ends = np.append(starts[1:], len(fp))
    starts, ends = starts[order], ends[order]
    short = fp[starts] >> np.uint64(64 - short_bits)
    first = np.ones(len(short), bool)
    first[1:] = short[1:] != short[:-1]
    kind = np.cumsum(first) - 1  # the distinct short fingerprint of each print
    distinct = short[first]
    owner = (distinct >> np.uint64(short_bits - owner_bits)).astype(np.int64)
    owners, at, sizes = np.unique(owner, return_index=True, return_counts=True)
    place = np.arange(len(distinct)) - np.repeat(at, sizes)
    twice = (np.bincount(kind, minlength=len(distinct))[kind] > 1) | (ends - starts > 1)
    codes = [golomb(distinct[a:a + s] - (np.uint64(o) << np.uint64(short_bits - owner_bits))) for o, a, s in zip(owners.tolist(), at.tolist(), sizes.tolist())]

    picked = np.concatenate([np.empty(0, np.int64), *(np.arange(s, e) for s, e in zip(starts, ends))]) if len(starts) < len(fp) else starts
    ids = pa.ListArray.from_arrays(pa.array(np.cumsum(np.append(0, ends - starts)), pa.int32()), rows["id"].combine_chunks().take(pa.array(picked)))
    n, m = len(starts), len(owners)
    none = lambda k, t: pa.nulls(k, t)
    join = lambda a, b: pa.concat_arrays([a, b])
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(n + m, number, np.int64)), pa.array(np.concatenate([owner[kind], owners])),
        join(pa.array(place[kind].astype(np.int32)), none(m, pa.int32())), join(pa.array(twice), none(m, pa.bool_())),
        join(pa.array(fp[starts].view(np.int64)), none(m, pa.int64())), join(digests.take(pa.array(starts)), none(m, digests.type)), join(ids, none(m, ids.type)),
        join(none(n, pa.int32()), pa.array(sizes.astype(np.int32))), join(none(n, pa.int32()), pa.array([c[0] for c in codes], pa.int32())),
        join(none(n, pa.binary()), pa.array([c[1] for c in codes], pa.binary()))],
        ["chunk", "owner", "place", "twice", "fp", "digest", "ids", "size", "bits", "code"])


def _send(rows: DataFrame, n: int) -> DataFrame:
    """Prints and packets of ``rows(id, fp, digest)``."""
    short_bits, owner_bits = _layout(n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, count, number = [], 0, TaskContext.get().partitionId() << 31
        for batch in batches:
            waiting.append(batch)
            count += batch.num_rows
            if count >= CHUNK:
                yield _chunk(pa.Table.from_batches(waiting), number, short_bits, owner_bits)
                waiting, count, number = [], 0, number + 1
        if count:
            yield _chunk(pa.Table.from_batches(waiting), number, short_bits, owner_bits)

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"chunk bigint, owner bigint, place int, twice boolean, fp bigint, digest string, ids array<{kind}>, size int, bits int, code binary")


def _answer(packets: DataFrame) -> DataFrame:
    """``chunk, owner, bitmap`` per packet: a bit per fingerprint, set where another chunk sent it too."""
    def run(group: pa.Table) -> pa.Table:
        sizes = group["size"].to_numpy()
        values = np.concatenate([degolomb(n, b, c) for n, b, c in zip(sizes.tolist(), group["bits"].to_pylist(), group["code"].to_pylist())])
        order = np.argsort(values, kind="stable")
        same = values[order][1:] == values[order][:-1]
        shared = np.zeros(len(values), bool)
        shared[order[1:][same]] = True
        shared[order[:-1][same]] = True
        maps = [np.packbits(part).tobytes() for part in np.split(shared, np.cumsum(sizes)[:-1])]
        return pa.table({"chunk": group["chunk"], "owner": group["owner"], "bitmap": pa.array(maps, pa.binary())})

    return packets.groupBy("owner").applyInArrow(run, "chunk bigint, owner bigint, bitmap binary")


def _octet(bitmap: str, bit: str) -> Column:
    """The byte of a binary column that holds a bit."""
    return F.conv(F.hex(F.substring(F.col(bitmap), F.floor(F.col(bit) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")


def _sieve(suspects: DataFrame) -> DataFrame:
    """``bucket, bits``: which of SIEVE_BITS values the suspects' fingerprints take, 4 KB a row and 8,192 rows at most."""
    at = F.pmod("fp", F.lit(SIEVE_BITS))
    return suspects.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))


def _texts(rows: DataFrame, sieve: DataFrame) -> DataFrame:
    """``id, fp, text`` of the rows whose fingerprint is in the sieve; the others are not shuffled."""
    own = rows.withColumn("fp", F.xxhash64("text"))
    at = F.pmod("fp", F.lit(SIEVE_BITS))
    own = own.withColumn("bucket", F.bitmap_bucket_number(at)).withColumn("bit", F.bitmap_bit_position(at).cast("int"))
    found = own.join(F.broadcast(sieve), "bucket")
    return found.where(_octet("bits", "bit").bitwiseAND(F.expr("shiftleft(1, bit % 8)")) != 0).select("id", "fp", "text")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, keep_id, group_size, kept, text_sha256`` per row of ``docs``.

    Texts are equal when their bytes are; NULL is the empty text. The row with the largest id of equal texts stays; NULL ids come before
    all others, and of rows that repeat text and id one is ``kept``. Texts of any length are hashed and compared whole. No
    rows give no rows; other columns are not looked at.

    Equal digests of unlike texts would raise an error, never merge them.
    """
    rows = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    sent = materialise(_send(rows.select("id", F.xxhash64("text").alias("fp"), F.sha2("text", 256).alias("digest")), docs.count()), "prints")
    answers = materialise(_answer(sent.where("code IS NOT NULL").select("chunk", "owner", "size", "bits", "code")), "bitmaps")
    prints = sent.where("code IS NULL").select("chunk", "owner", "place", "twice", "fp", "digest", "ids")
    marked = F.col("twice") | (_octet("bitmap", "place").bitwiseAND(F.expr("shiftright(128, place % 8)")) != 0)
    prints = materialise(prints.join(answers, ["chunk", "owner"]).select("chunk", "fp", "digest", "ids", marked.alias("suspect")), "suspects")

    suspects = prints.where("suspect")
    held = _texts(rows, materialise(_sieve(suspects), "sieve"))
    # copies of a text become one row per task before they travel; grouping compares bytes
    same = held.groupBy("fp", "text").agg(F.count("*").alias("n"), F.max("id").alias("keep"))
    verified = same.select("fp", F.sha2("text", 256).alias("digest"), "n", "keep")
    verified = verified.groupBy("fp", "digest").agg(F.max("n").alias("n"), F.max("keep").alias("keep"), F.count("*").alias("unlike"))
    verified = materialise(verified.select("fp", "digest", F.when(F.col("unlike") > 1, F.raise_error("unlike texts of one digest")).otherwise(F.col("n")).cast("bigint").alias("n"),
                                           "keep"), "verified")
    # ids in a print ascend, so its last one is its largest; the first chunk with the largest id of all keeps its row
    holder = suspects.groupBy("fp", "digest").agg(F.max(F.struct(F.element_at("ids", -1).alias("id"), "chunk"))["chunk"].alias("holder"))
    known = verified.join(holder, ["fp", "digest"])
    joined = suspects.join(known, ["fp", "digest"]).select("chunk", "digest", "ids", "n", "keep", "holder")
    alone = prints.where("NOT suspect").select("chunk", "digest", "ids", F.lit(1).cast("bigint").alias("n"), F.element_at("ids", -1).alias("keep"), F.col("chunk").alias("holder"))
    each = joined.unionByName(alone).select("digest", "n", "keep", (F.col("chunk") == F.col("holder")).alias("here"), F.size("ids").alias("size"), F.posexplode("ids").alias("at", "id"))
    return each.select("id", F.col("keep").alias("keep_id"), F.col("n").alias("group_size"),
                       (F.col("here") & (F.col("at") == F.col("size") - 1)).alias("kept"), F.col("digest").alias("text_sha256"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without exact copies: of equal texts, that of the largest id; columns are unchanged.

    Of rows that repeat id and text one stays, rows with a NULL id only when no row of that text has an id.
    """
    lost = groups(docs, id_col, text_col).where("NOT kept").select(F.col("id").alias("__lost"), F.col("text_sha256").alias("__digest"), F.col("keep_id").eqNullSafe(F.col("id")).alias("__again"))
    lost = lost.groupBy("__lost", "__digest").agg(F.max("__again").alias("__again"))
    own = F.sha2(F.coalesce(docs[text_col].cast("string"), F.lit("")), 256)
    match = docs[id_col].eqNullSafe(F.col("__lost")) & (own == F.col("__digest"))
    lost = materialise(lost, "lost")
    kept = docs.join(lost, match, "left_anti")
    again = lost.where("__again")
    if again.isEmpty():
        return kept
    return kept.unionByName(docs.join(again, match, "left_semi").dropDuplicates([id_col, text_col]))
