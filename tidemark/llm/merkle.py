"""A Merkle manifest of a dataset: a tree of digests per group, and one over the groups' roots.

Nodes of a level are joined three at a time by SHA-256 over their concatenated hex digests until one is left.
The work is done in aligned blocks of ``BLOCK`` (3 ** BLOCK_LEVELS) neighbours: a block keeps each of its levels as
one string of 64 hex digits per node, fixed-width substrings of which are hashed to the parents; the substrings
beside a node are its siblings. Block roots are the nodes of the next, 81 times smaller tier, and so on up; paths are
put together on the way down. No task holds more than a block, however large a group is, and no text leaves its scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .ranks import positions

ARITY, WIDTH = 3, 64
BLOCK_LEVELS = 4
BLOCK = ARITY ** BLOCK_LEVELS
_PATH = "array<struct<left:string,right:string>>"


def digest(value: Column) -> Column:
    return F.sha2(value, 256)


def leaf(fields: list[Column]) -> Column:
    """Digest of a row: per field ``-`` for NULL, else its length in UTF-8 bytes, a colon and its text."""
    shown = [f.cast("string") for f in fields]
    return digest(F.concat(*[F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")) for s in shown]))


def fold(start: Column, proof: Column) -> Column:
    """The root that follows from a leaf and its proof."""
    return F.aggregate(proof, start, lambda node, step: digest(F.concat(step["left"], node, step["right"])))


def siblings(proof: Column) -> Column:
    """All sibling digests of a proof as one string, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), "")


def _parents(level: Column) -> Column:
    runs = F.sequence(F.lit(0), F.floor((F.octet_length(level) - 1) / (ARITY * WIDTH)).cast("int"))
    return F.array_join(F.transform(runs, lambda i: digest(F.substring(level, i * ARITY * WIDTH + 1, F.lit(ARITY * WIDTH)))), "")


def _depth(n: Column) -> Column:
    """Levels above ``n`` nodes inside a block."""
    out = F.lit(BLOCK_LEVELS)
    for level in range(BLOCK_LEVELS - 1, -1, -1):
        out = F.when(n <= ARITY ** level, level).otherwise(out)
    return out


def _blocks(nodes: DataFrame, carried: list[str]) -> DataFrame:
    """One row per block of ``nodes(grp, pos, n, hex)``: its members in order, its levels as strings, its root."""
    members = F.array_sort(F.collect_list(F.struct("pos", "hex", *carried)))
    own = nodes.groupBy("grp", F.floor(F.col("pos") / BLOCK).alias("block"), "n").agg(members.alias("members"))
    first = own.withColumn("level", F.array_join(F.transform("members", lambda m: m["hex"]), ""))
    steps = F.filter(F.sequence(F.lit(1), F.lit(BLOCK_LEVELS)), lambda i: i <= _depth(F.col("n")))
    levels = F.aggregate(steps, F.array("level").cast("array<string>"), lambda acc, _: F.concat(acc, F.array(_parents(F.element_at(acc, -1)))))
    kept = F.transform("members", lambda m: F.struct(m["pos"].alias("pos"), *[m[c].alias(c) for c in carried]))
    return first.select("grp", "block", "n", kept.alias("members"), levels.alias("levels")).withColumn("top", F.element_at("levels", -1))


def _climb(nodes: DataFrame, most: int, carried: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """The written tiers of blocks from the leaves up, and the one node left of every group."""
    tiers = []
    while not tiers or most > 1:
        blocks = materialise(_blocks(nodes, [] if tiers else carried), "blocks")
        tiers.append(blocks)
        nodes = blocks.select("grp", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("top").alias("hex"))
        most = -(-most // BLOCK)
    return tiers, nodes


def _steps(at: Column) -> Column:
    """Siblings of the member at place ``at`` of a block, from its lowest level up."""
    def step(level: Column, i: Column) -> Column:
        node = F.floor(at / F.element_at(F.array(*[F.lit(ARITY ** k) for k in range(BLOCK_LEVELS + 1)]), i + 1)).cast("int")
        left = node % ARITY
        return F.struct(F.substring(level, (node - left) * WIDTH + 1, left * WIDTH).alias("left"),
                        F.substring(level, (node + 1) * WIDTH + 1, (ARITY - 1 - left) * WIDTH).alias("right"))

    # the topmost level is the block's root alone
    return F.transform(F.slice("levels", F.lit(1), F.size("levels") - 1), step).cast(_PATH)


def _descend(tiers: list[DataFrame], tops: DataFrame, carried: list[str]) -> DataFrame:
    """The leaves with their paths and all further columns of ``tops(grp, pos, path, ..)``."""
    further = [c for c in tops.columns if c not in ("grp", "pos", "path")]
    for tier in range(len(tiers) - 1, -1, -1):
        own = tiers[tier].join(tops.withColumnRenamed("pos", "block"), ["grp", "block"])
        extra = carried if tier == 0 else []
        rows = F.transform("members", lambda m, i: F.struct(m["pos"].alias("pos"), *[m[c].alias(c) for c in extra],
                                                            F.concat(_steps(i), F.col("path")).alias("path")))
        tops = own.select("grp", *further, F.inline(rows))
    return tops


def manifest(docs: DataFrame, fields: list[str], id_col: str = "doc_id", group_col: str = "source", claimed: Column | None = None) -> DataFrame:
    """``id, leaf, claimed, proof, subroot, root`` per row of ``docs``.

    ``leaf`` is the digest of ``fields``; ``claimed`` is any other digest to hold against the tree (the leaf when none is
    given). In a group leaves ascend by id, NULL ids first, then by leaf, so rows that repeat are leaves of their own and
    the result does not depend on the order of reading. Groups ascend bytewise, the NULL group first. ``proof`` lists a
    leaf's siblings as strings to its left and right from the bottom up, through ``subroot`` of the group to ``root``.
    Empty and very long values are hashed whole. No rows give no rows; other columns are not looked at.
    """
    own = leaf([docs[f] for f in fields])
    rows = docs.select(docs[id_col].alias("id"), docs[group_col].cast("string").alias("name"), own.alias("hex"),
                       own.alias("claimed") if claimed is None else claimed.alias("claimed"))
    placed = materialise(positions(materialise(rows, "leaves"), [F.col("name").asc(), F.col("id").asc(), F.col("hex").asc()], "at"), "placed")
    # a group is known by range and name here, so that none is dealt out by its name alone
    runs = placed.groupBy("part", "name").agg(F.min("at").alias("at"), F.count("*").alias("n"))
    groups = materialise(runs.groupBy("name").agg(F.min("at").alias("start"), F.sum("n").alias("n")), "groups")
    named = materialise(positions(groups, [F.col("name").asc()], "grp").select("grp", "name", "start", "n"), "groups")
    sizes = named.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(1))).first()
    other = named.withColumnRenamed("name", "__name")
    own_runs = runs.select("part", "name").join(other, F.col("name").eqNullSafe(F.col("__name"))).drop("__name")
    own_runs = materialise(own_runs.select(F.col("part").alias("__part"), F.col("name").alias("__name"), "grp", "start", "n"), "runs")
    leaves = placed.join(own_runs, (F.col("part") == F.col("__part")) & F.col("name").eqNullSafe(F.col("__name")))
    leaves = leaves.select("grp", (F.col("at") - F.col("start")).alias("pos"), "n", "hex", "id", "claimed").withColumn("leaf", F.col("hex"))

    carried = ["id", "leaf", "claimed"]
    tiers, subroots = _climb(leaves, sizes[1], carried)
    over = subroots.select(F.lit(0).alias("grp"), F.col("grp").alias("pos"), F.lit(sizes[0]).cast("bigint").alias("n"), "hex").withColumn("subroot", F.col("hex"))
    upper, root = _climb(over, sizes[0], ["subroot"])
    top = root.select("grp", "pos", F.array().cast(_PATH).alias("path"), F.col("hex").alias("root"))
    ends = _descend(upper, top, ["subroot"]).select(F.col("pos").alias("grp"), F.lit(0).cast("bigint").alias("pos"), "path", "subroot", "root")
    found = _descend(tiers, materialise(ends, "roots"), carried)
    return found.select("id", "leaf", "claimed", F.col("path").alias("proof"), "subroot", "root")
