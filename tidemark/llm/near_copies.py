"""Near copies by Jaccard similarity of word shingles, proposed by a wide SimHash under Golay keys.

A SimHash over the distinct five-word shingles of a text counts, per bit of their hashes, ones against zeros. At a
similarity of 0.8 some 0.15 of the bits differ, too many for the equal segments and single errors that `simhash` allows
for. So the hash has ``2 * TABLES`` segments of 23 bits, and each is decoded to Golay codewords by its counts, not by their
signs alone: a count near zero is the one an edit turns. Two segments make a table; its keys are the ``PROBES`` pairs of codewords
nearest to the counts. Two texts at 0.8 share no key of a table with probability 0.42 at most (simulated, sets of 4 to 270 shingles), of
``TABLES`` tables with 1e-6, less above it. Texts meet when they share a key, their first 128 bits differ in ``FAR`` at most, and, among
those left by that, their sizes fit and all bits differ in ``FAR_ALL`` at most; either bound loses 1e-6 of the pairs at 0.8 at worst. Who meets
nobody under a key leaves it before texts are compared; a band is what stays of a key. Candidates are confirmed by the exact
similarity of their sets of 64-bit shingle hashes, and confirmed pairs are closed to groups.

Texts of one set of shingles are one node. A node has up to ``TABLES * PROBES`` bands, so what need not be done by bands is done by leads: a band's lead is
its node of the smallest hash, and the bands of one lead are fewer rows together. Nodes are first compared with the ``FIRST`` leads that they share most bands with
and with a centre, which most leads of a group have in common: a node that shares most bands, in a group of edited copies most likely what they were made from. Links
found are closed to groups. Then, in rounds, members are compared with one of a group unlike theirs, at first their lead, then another member by lead, and a lead is done
when its members are one group. So a round costs one comparison per member and lead at most. Rounds end when the pairs left are few or no longer fall by half. What is left is
decided by what members share outside their centre: two members of sizes m and n are alike only when they share
``s / (1 + s) * (m + n)`` shingles, no more of them inside the centre than each shares with it. So a member unlike the centre can
only be alike to members that are small enough for that, or that share shingles with it which the centre lacks; the
former are found by band and size, the latter by centre and shingle. A centre is an edited copy itself, so what it alone lost all
others share: shingles that more than ``OFTEN`` members hold are counted as if the centre had them, since the bound above holds
for any set put in the centre's place. So a shingle that a member has beside that set meets at most ``OFTEN`` others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import golay
from .common import first_rows, materialise, row_key, shingle_hashes, small_batches, texts
from .components import components

WIDTH = 5
SIMILARITY = 0.8
TABLES, PROBES = 16, 8
#: Differing bits, of the first 128 and of all, up to which texts that share a key meet; sums over FEW shingles are often zero, and turn more bits.
FAR, FAR_ALL, FAR_FEW, FEW = 46, 168, 200, 8
#: Holders of a shingle beside a centre, up to which they are met with each other.
OFTEN = 16
#: Leads of a node, those of most bands with it, that it is compared with before the groups are known; with the others after that.
FIRST = 16
_SEED = 42
#: Slack for the last bits of a quotient: far below the difference of two unequal similarities of sets in memory.
_ROUNDING = 1e-12
_WORDS = -(-2 * TABLES * golay.BITS // 64)
_STEPS = np.arange(_WORDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
#: Added to the counts: decides between codewords that equal counts leave open, alike for all texts.
_TIES = np.random.default_rng(23).uniform(-0.01, 0.01, 64 * _WORDS)
#: Ranks of two codewords whose pair can be among the PROBES nearest.
_RANKS = np.array([(i, j) for i in range(PROBES) for j in range(PROBES) if (i + 1) * (j + 1) <= PROBES]).T


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted distinct XXH64 of the shingles of a UTF-8 text, A-Z lower-cased; fewer words are one shingle."""
    return np.unique(shingle_hashes(text.lower().split(), WIDTH, _SEED))


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """Ones less zeros per bit of the SimHash over a set of shingle hashes; its first 64 bits are those of the hashes themselves."""
    ones = np.zeros(64 * _WORDS, np.int64)
    for at in range(0, len(hashes), 255):  # as many as a byte counts
        words = hashes[at:at + 255, None] + _STEPS
        more = words[:, 1:]
        more ^= more >> np.uint64(30)
        more *= np.uint64(0xBF58476D1CE4E5B9)
        more ^= more >> np.uint64(27)
        more *= np.uint64(0x94D049BB133111EB)
        more ^= more >> np.uint64(31)
        bits = np.unpackbits(words.astype("<u8").view(np.uint8), axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.uint8)
    return 2 * ones - len(hashes)


def golay_keys(counts: np.ndarray) -> np.ndarray:
    """``TABLES * PROBES`` keys per row of ``bit_counts``: a table's number and two codeword indices."""
    values, keys = counts + _TIES, []
    rows = np.arange(len(values))[:, None]
    for table in range(TABLES):
        at = 2 * table * golay.BITS
        (x, near_x), (y, near_y) = (golay.nearest(values[:, s:s + golay.BITS], PROBES) for s in (at, at + golay.BITS))
        best = np.argpartition(near_x[:, _RANKS[0]] + near_y[:, _RANKS[1]], -PROBES, axis=1)[:, -PROBES:]
        keys.append(table << 24 | x[rows, _RANKS[0, best]] << 12 | y[rows, _RANKS[1, best]])
    return np.concatenate(keys, axis=1)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    values = np.concatenate([np.empty(0, np.int64), *parts])
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()), pa.array(values))


def _signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, key, node, n, bits, words`` per row: the row's key, its set of shingles by digest and size, its SimHash and its Golay keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            sets = [shingle_set(t) for t in texts(batch.column(2))]
            nodes = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
            counts = np.stack([bit_counts(s) for s in sets])
            bits = np.packbits(counts > 0, axis=1, bitorder="little").view("<i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), nodes, pa.array([len(s) for s in sets], pa.int64()),
                                              _lists(list(bits)), _lists(list(golay_keys(counts).astype(np.int64)))], ["id", "key", "node", "n", "bits", "words"])

    rows = docs.select(docs[id_col].alias("id"), row_key(docs, id_col, text_col).alias("key"), docs[text_col].cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, key bigint, node binary, n bigint, bits array<bigint>, words array<bigint>")


def _apart(bits: int) -> str:
    """SQL for the number of differing bits in the first ``bits`` of two SimHashes."""
    return " + ".join(f"bit_count(a.b{i} ^ b.b{i})" for i in range(bits // 64))


def _bands(nodes: DataFrame, similarity: float) -> DataFrame:
    """``band, node, n, members, lead``: nodes that meet others under a Golay key; keys under which the same ones meet are one band, its lead is one of them."""
    # nodes go by a short tag and two words of their bits here, so that the many rows of keys stay small
    named = nodes.select("node", "n", F.hash("node").alias("tag"), *[F.col("bits")[i].alias(f"b{i}") for i in range(_WORDS)])
    keys = nodes.select(F.explode(F.col("words").cast("array<int>")).alias("band"), F.hash("node").alias("tag"), *[F.col("bits")[i].alias(f"b{i}") for i in range(2)])
    meet = f"a.band = b.band AND a.tag <> b.tag AND {_apart(128)} <= {FAR}"
    met = keys.alias("a").join(keys.alias("b"), F.expr(meet), "left_semi")
    wide = materialise(met.join(named, ["tag", "b0", "b1"]), "wide")
    fit = f"least(a.n, b.n) >= {similarity!r}D * greatest(a.n, b.n) - 1e-9"
    near = f"{_apart(64 * _WORDS)} <= CASE WHEN least(a.n, b.n) < {FEW} THEN {FAR_FEW} ELSE {FAR_ALL} END"
    spread = materialise(wide.alias("a").join(wide.alias("b"), F.expr(f"a.band = b.band AND a.node <> b.node AND {fit} AND {near}"), "left_semi").select("band", "node", "n"), "spread")
    held = spread.groupBy("band").agg(F.count("*").alias("members"), F.bit_xor(F.xxhash64("node")).alias("one"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("two"),
                                      F.min(F.struct(F.xxhash64("node").alias("lot"), "node")).alias("lead"))
    keys = held.groupBy("members", "one", "two").agg(F.min("band").alias("band"), F.min("lead").alias("lead"))
    return spread.join(keys.select("band", "members", F.col("lead.node").alias("lead")), "band")


def _sets(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``node, hashes`` of ``nodes(node, row)``, from the text of the one row (id and key) they name."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists([shingle_set(t).view(np.int64) for t in texts(batch.column(1))])], ["node", "hashes"])

    owner = nodes.select("node", F.col("row.id").alias("__id"), F.col("row.key").alias("__key"))
    own = docs.join(owner, docs[id_col].eqNullSafe(owner["__id"]) & (row_key(docs, id_col, text_col) == owner["__key"]))
    return own.select(owner["node"], docs[text_col].cast("string").alias("text")).dropDuplicates(["node"]).mapInArrow(run, "node binary, hashes array<bigint>")


def _distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``u, v, shared, far``: common shingles and one minus the Jaccard similarity of each pair."""
    both = (pairs.join(sets.select(F.col("node").alias("v"), F.col("hashes").alias("b")), "v")
            .join(sets.select(F.col("node").alias("u"), F.col("hashes").alias("a")), "u"))
    counted = both.select("u", "v", F.size(F.array_intersect("a", "b")).alias("shared"), (F.size("a") + F.size("b")).alias("total"))
    return counted.select("u", "v", "shared", (1 - F.col("shared") / (F.col("total") - F.col("shared"))).alias("far"))


def _open_pairs(members: DataFrame) -> tuple[int, int]:
    """Members by lead, and their pairs of unlike roots."""
    own = members.groupBy("lead", "root").agg(F.count("*").alias("n")).groupBy("lead").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("same"))
    found = own.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum((F.col("n") * F.col("n") - F.col("same")) / 2), F.lit(0))).first()
    return int(found[0]), int(found[1])


def _centres(members: DataFrame) -> DataFrame:
    """``lead, hub``: from the member of most degree, twice on to the one of most degree it shares a lead with, so that most leads of a group agree."""
    tops = members.groupBy("lead").agg(F.max(F.struct("degree", "node")).alias("top"))
    above = materialise(members.join(tops, "lead").groupBy(F.col("node").alias("hub")).agg(F.max("top").alias("above")), "above")
    hubs = tops.select("lead", F.col("top.node").alias("hub"))
    for _ in range(2):
        hubs = hubs.join(above, "hub").select("lead", F.col("above.node").alias("hub"))
    return hubs


def _round(members: DataFrame, sets: DataFrame, number: int) -> DataFrame:
    """The distances of one comparison of members with another's group: at first with their leads, then with any member by lead, most likely one of its largest group."""
    if not number:
        return materialise(_distances(members.where("NOT first AND root <> lead_root").select(F.col("lead").alias("u"), F.col("node").alias("v")), sets), "distances")
    hubs = members.groupBy("lead").agg(F.max(F.struct(F.xxhash64("node", "lead", F.lit(number)).alias("lot"), "node", "root")).alias("u"))
    met = members.alias("a").join(hubs.alias("b"), F.expr("a.lead = b.lead AND a.root <> b.u.root"))
    return materialise(_distances(met.select("u.node", F.col("a.node").alias("v")).toDF("u", "v").distinct(), sets), "distances")


def _meet(beside: DataFrame) -> DataFrame:
    """Rows ``a, b`` of one shingle beside a centre: of unlike roots, one of them unlike the centre."""
    met = "a.hub = b.hub AND a.shingle = b.shingle AND a.root <> b.root AND (NOT b.apart OR a.node < b.node)"
    return beside.where("apart").alias("a").join(beside.alias("b"), F.expr(met))


def _grade(size: str) -> Column:
    """Class of a size; sizes that fit are of one class or of two that are next to each other."""
    return F.floor(F.log(F.greatest(F.col(size), F.lit(1))) / math.log(SIMILARITY ** -2))


def _reaching(fitting: DataFrame) -> DataFrame:
    """The members unlike their centre, once for each class of sizes between their bounds: twice at most, whatever their size."""
    return fitting.where("apart").withColumn("grade", F.explode(F.sequence(_grade("least"), _grade("most"))))


def _left(members: DataFrame, shared: DataFrame, sets: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """Pairs ``u, v`` of unlike roots that can still be alike, judged by what they share with their centre, the column ``hub``."""
    reach = (1 + similarity) / similarity
    hubs = roots.select(F.col("node").alias("hub"), F.col("root").alias("hub_root"))
    own = members.join(hubs, "hub", "left").withColumn("apart", F.col("root") != F.coalesce("hub_root", "hub")).drop("hub_root")
    own = materialise(own, "left")
    held = own.groupBy("hub", "node").agg(*[F.first(c).alias(c) for c in ("n", "root", "common")], F.max("apart").alias("apart"))
    both = held.join(sets.withColumnRenamed("hashes", "own"), "node").join(sets.select(F.col("node").alias("hub"), F.col("hashes").alias("its")), "hub")
    beside = materialise(both.select("hub", "node", "n", "root", "common", "apart", F.explode(F.array_except("own", "its")).alias("shingle")), "beside")
    kinds = beside.groupBy("hub", "shingle").agg(F.count("*").alias("held"), F.min("root").alias("low"), F.max("root").alias("high"), F.max("apart").alias("any"))
    mixed = kinds.where("low <> high AND any").select("hub", "shingle", (F.col("held") > OFTEN).alias("often"))
    beside = materialise(beside.join(mixed, ["hub", "shingle"]), "mixed")
    more = materialise(beside.where("often").groupBy("hub", "node").agg(F.count("*").alias("more")), "centre")

    common = F.col("common") + F.coalesce("more", F.lit(0))
    own = materialise(own.join(more, ["hub", "node"], "left").withColumn("common", common).drop("more")
                      .withColumn("most", F.floor(F.least(F.col("n") / similarity, F.col("common") * reach - F.col("n")) + 1e-9))
                      .withColumn("least", F.ceil(F.col("n") * similarity - 1e-9)), "bounds")
    pair = [F.least("a.node", "b.node").alias("u"), F.greatest("a.node", "b.node").alias("v")]
    # whoever can be alike fits its own bounds
    fitting = own.where("least <= most").select("lead", "node", "root", "apart", "least", "most", _grade("n").alias("grade"))
    fitting = materialise(shared.select("band", "node", "n", "lead").join(fitting, ["lead", "node"]), "fitting")
    fits = "a.band = b.band AND a.grade = b.grade AND b.n BETWEEN a.least AND a.most AND a.root <> b.root AND b.most >= a.n AND (NOT b.apart OR a.node < b.node)"
    small = _reaching(fitting).alias("a").join(fitting.alias("b"), F.expr(fits)).select(*pair)

    rare = beside.where("NOT often").join(more, ["hub", "node"], "left").withColumn("common", common)
    counted = _meet(rare).groupBy("a.hub", "a.node", "b.node").agg(F.count("*").alias("shared"), F.first(F.col("a.n") + F.col("b.n")).alias("total"),
                                                           F.first(F.least("a.common", "b.common")).alias("inside"))
    enough = counted.where(F.col("shared") + F.col("inside") >= F.col("total") / reach - 1e-9)
    return small.unionByName(enough.select(*pair)).distinct()


def _regroup(members: DataFrame, roots: DataFrame) -> DataFrame:
    """The members of leads that still hold several groups, each with its root."""
    own = members.drop("root", "lead_root").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    own = own.join(roots.select(F.col("node").alias("lead"), F.col("root").alias("lead_root")), "lead", "left").withColumn("lead_root", F.coalesce("lead_root", "lead"))
    own = materialise(own, "rooted")
    split = own.groupBy("lead").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("lead")
    return materialise(own.join(split, "lead", "left_semi"), "open")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``id, key, root`` per row: ``key`` tells rows of one id and other texts apart, ``root`` names the group.

    Rows of a group are linked by steps of at least ``similarity``, which must not be below SIMILARITY, the
    one the keys are laid out for. NULL and wordless texts are one group, long texts count whole. Without rows nothing is returned.
    """
    if similarity < SIMILARITY:
        raise ValueError(f"the keys are laid out for similarities from {SIMILARITY} on")
    near = F.col("far") <= 1 - similarity + _ROUNDING
    rows = materialise(_signatures(docs, id_col, text_col), "signatures")
    nodes = materialise(rows.groupBy("node").agg(*[F.first(c).alias(c) for c in ("n", "bits", "words")], F.min(F.struct("id", "key")).alias("row")), "nodes")
    shared = materialise(_bands(nodes, similarity), "shared")
    degrees = materialise(shared.groupBy("node").agg(F.sum("members").alias("degree")), "degrees")
    sets = materialise(_sets(docs, nodes.join(degrees, "node", "left_semi"), id_col, text_col), "sets")

    led = shared.groupBy("lead", "node").agg(F.first("n").alias("n"), F.count("*").alias("bands"))
    first = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("bands"), "lead")) <= FIRST
    members = materialise(led.withColumn("first", first).drop("bands").join(degrees, "node"), "led")
    members = materialise(members.drop("degree").join(_centres(members), "lead"), "members")
    pairs = members.select(F.col("hub").alias("u"), F.col("node").alias("v")).unionByName(members.where("first").select(F.col("lead").alias("u"), F.col("node").alias("v")))
    found = materialise(_distances(pairs.where("u <> v").distinct(), sets), "distances")
    links = found.where(near).select("u", "v")
    common = found.select(F.col("u").alias("hub"), F.col("v").alias("node"), "shared")
    members = materialise(members.join(common, ["hub", "node"], "left").withColumn("common", F.coalesce("shared", "n")).drop("shared"), "members")
    before, number = None, 0
    while True:
        roots = components(links)
        members = _regroup(members, roots)
        n, pairs = _open_pairs(members)
        if pairs <= 4 * n or before is not None and 2 * pairs > before:
            break
        links = links.unionByName(_round(members, sets, number).where(near).select("u", "v"))
        before, number = pairs, number + 1

    more = materialise(_distances(_left(members, shared, sets, roots, similarity), sets).where(near).select("u", "v"), "links")
    if not more.isEmpty():
        # only groups are linked further, not their members once more
        ends = [roots.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in "uv"]
        between = more.join(ends[0], "u", "left").join(ends[1], "v", "left").select(F.coalesce("u_root", "u").alias("u"), F.coalesce("v_root", "v").alias("v"))
        joined = components(between).select(F.col("node").alias("old"), F.col("root").alias("new"))
        named = rows.join(roots, "node", "left").withColumn("old", F.coalesce("root", "node")).drop("root")
        return named.join(joined, "old", "left").select("id", "key", F.coalesce("new", "old").alias("root"))
    return rows.join(roots, "node", "left").select("id", "key", F.coalesce("root", "node").alias("root"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` with one row per group of near copies: that of the smallest id.

    Rows with a NULL id go when their group has an id; of a group without ids one row stays. Rows that repeat an
    id with another text are rows of their own; of rows that repeat id and text one stays. Columns are unchanged.
    """
    return first_rows(docs, materialise(groups(docs, id_col, text_col, similarity), "groups"), id_col, text_col)
