"""Line deduplication by distinct-site spread.

Each line has a HyperLogLog sketch of the sites it stands on; sketches merge by aggregation, so a very
common line travels as one sketch per task. A line well above ``min_sites`` is boilerplate, one well
below is not, and one within the sketch's error of the threshold is decided by its exact number of
distinct sites. Boilerplate lines are removed except for their first occurrence, the one of the smallest
id and position, so no line leaves the corpus altogether.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialise, row_key

MIN_SITES = 10
#: Size of a sketch (2 ** SKETCH_BITS buckets) and how many standard errors around the threshold are counted exactly.
SKETCH_BITS, ERRORS = 12, 5
BLANKS = " \t\r\x0b\x0c"


def lines_of(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """``id, key, site, pos, h1, h2`` per line that is not blank.

    A line is known by two 64-bit hashes of its text without surrounding blanks, a site by one.
    """
    text = docs[text_col].cast("string")
    rows = docs.select(docs[id_col].alias("id"), row_key(docs, id_col, text_col).alias("key"),
                       F.xxhash64(docs[site_col].isNull(), docs[site_col]).alias("site"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    line = F.btrim("line", F.lit(BLANKS))
    return rows.select("id", "key", "site", "pos", line.alias("line")).where("line <> ''").select(
        "id", "key", "site", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``h1, h2, first`` of every line on ``min_sites`` or more distinct sites; ``first`` is its smallest (id, pos)."""
    spread = lines.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", SKETCH_BITS).alias("sketch"), F.min(F.struct("id", "pos")).alias("first"))
    band = max(1.0, ERRORS * 1.04 / 2 ** (SKETCH_BITS / 2) * min_sites)
    seen = spread.select("h1", "h2", "first", F.hll_sketch_estimate("sketch").alias("about")).where(F.col("about") >= min_sites - band)
    seen = materialise(seen, "spread")
    near = seen.where(F.col("about") <= min_sites + band)
    exact = (lines.join(near.select("h1", "h2"), ["h1", "h2"], "left_semi").groupBy("h1", "h2", "site").agg(F.lit(1).alias("one"))
             .groupBy("h1", "h2").agg(F.count("one").alias("sites")).where(F.col("sites") >= min_sites))
    found = near.join(exact, ["h1", "h2"]).select("h1", "h2", "first")
    return found.unionByName(seen.where(F.col("about") > min_sites + band).select("h1", "h2", "first"))


def strip_boilerplate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
                      min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with boilerplate lines cut from the text, and the number of cut lines as ``n_removed``
    (with underscores before it when there is such a column).

    Blank lines stay. All rows stay, also when no text is left; NULL and empty texts are unchanged. NULL is
    a site of its own. Rows that repeat with the same id and text are treated alike. No rows give no rows.
    """
    lines = materialise(lines_of(docs, id_col, text_col, site_col), "lines")
    common = materialise(boilerplate(lines, min_sites), "boilerplate").select("h1", "h2", F.col("first.id").alias("first_id"), F.col("first.pos").alias("first_pos"))
    cut = lines.join(common, ["h1", "h2"]).where(~(F.col("id").eqNullSafe(F.col("first_id")) & (F.col("pos") == F.col("first_pos"))))
    # positions of one document, at most as many as it has lines
    removed = cut.groupBy(F.col("id").alias("__id"), F.col("key").alias("__key")).agg(F.collect_set("pos").alias("__removed"))
    joined = docs.join(removed, docs[id_col].eqNullSafe(removed["__id"]) & (row_key(docs, id_col, text_col) == removed["__key"]), "left")
    own = F.split(docs[text_col], "\n")
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size(own) - 1), "__removed"), lambda i: F.struct(i.alias("i")))
    # the text is split once per row, not once per line
    parts = F.transform(F.array(F.struct(own.alias("own"), left.alias("left"))), lambda x: F.array_join(F.transform(x["left"], lambda i: F.get(x["own"], i["i"])), "\n"))[0]
    text = F.when(F.col("__removed").isNull(), docs[text_col]).otherwise(parts)
    counted = free_name(docs, "n_removed")
    columns = [text.alias(c) if c == text_col else docs[c] for c in docs.columns]
    return joined.select(*columns, F.coalesce(F.size("__removed"), F.lit(0)).cast("bigint").alias(counted))
