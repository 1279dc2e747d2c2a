"""Type 2 history: change classes between snapshots, latest and history, and their checks.

A snapshot has one row per business key and partition date. ``one_per_key`` makes that true with an
aggregate, so joins and windows by key afterwards never meet more rows of a key than there are
partition dates, however often the key occurs in the input. That bound is what lets a window by key
stay one task per key.
"""

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN_END = dt.date(9999, 12, 31)


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the greatest by ``order``, ties broken by the remaining values."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    ranked = list(order) + [c for c in rest if c not in order]
    best = df.groupBy(*keys).agg(F.max(F.struct(*ranked)).alias("__best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"__best.{c}").alias(c) for c in df.columns])


def _values(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str) -> DataFrame:
    return df.select(*keys, F.struct(*columns).alias(name))


def _tracked(df: DataFrame, keys: Sequence[str], ignore: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in keys and c not in ignore]


def _change(old: str = "old", new: str = "new") -> Column:
    return (F.when(F.col(old).isNull(), "new").when(F.col(new).isNull(), "omitted")
            .when(F.col(old).eqNullSafe(F.col(new)), "unchanged").otherwise("updated"))


def classify_changes(prev: DataFrame, cur: DataFrame, keys: Sequence[str],
                     ignore: Sequence[str] = ("partition_dt",), order: Sequence[str] = ()) -> DataFrame:
    """Class of every key of two snapshots: new, updated, unchanged or omitted.

    Here and below, a key that repeats in a snapshot counts with its last row by ``order``. The
    aggregate that picks it also partitions both sides for the join.
    """
    prev, cur = one_per_key(prev, keys, order), one_per_key(cur, keys, order)
    tracked = _tracked(cur, keys, ignore)
    both = _values(prev, keys, tracked, "old").join(_values(cur, keys, tracked, "new"), list(keys), "full")
    return both.select(*keys, _change().alias("change"))


def classify_snapshots(snapshots: DataFrame, keys: Sequence[str], day: str = "partition_dt",
                       ignore: Sequence[str] = (), order: Sequence[str] = ()) -> DataFrame:
    """The same for each partition date against the one before it; all keys of the first are new.

    One shuffle by key: a row meets the row before and after it of its key, and the short list of dates
    tells whether those are of the dates next to its own.
    """
    tracked = _tracked(snapshots, [*keys, day], ignore)
    rows = _values(one_per_key(snapshots, [*keys, day], order), [*keys, day], tracked, "new")
    by_key = Window.partitionBy(*keys).orderBy(day)
    seen = rows.select(*keys, day, "new", F.lag(day).over(by_key).alias("__last"), F.lag("new").over(by_key).alias("__old"),
                       F.lead(day).over(by_key).alias("__next"))
    dated = seen.join(_neighbours(snapshots, day), day)
    same = F.col("__last").eqNullSafe(F.col("__day_before")) & F.col("__last").isNotNull()
    own = F.struct(F.col(day).alias("day"), F.when(~same, "new").when(F.col("__old").eqNullSafe(F.col("new")), "unchanged").otherwise("updated").alias("change"))
    gone = F.when(F.col("__day_after").isNotNull() & ~F.col("__day_after").eqNullSafe(F.col("__next")),
                  F.struct(F.col("__day_after").alias("day"), F.lit("omitted").alias("change")))
    changes = F.filter(F.array(own, gone), lambda c: c.isNotNull())
    return dated.select(*keys, F.inline(changes)).select(*keys, F.col("day").alias(day), "change")


def _neighbours(snapshots: DataFrame, day: str) -> DataFrame:
    """Every partition date with the one before and after it: at most one row per calendar date, so broadcast."""
    days = snapshots.select(F.col(day).alias("d")).where("d IS NOT NULL").distinct().agg(F.sort_array(F.collect_set("d")).alias("d"))
    near = F.transform("d", lambda d, i: F.struct(d.alias(day), F.when(i > 0, F.get("d", i - 1)).alias("__day_before"), F.get("d", i + 1).alias("__day_after")))
    return F.broadcast(days.select(F.inline(near)))


def column_diffs(prev: DataFrame, cur: DataFrame, keys: Sequence[str],
                 ignore: Sequence[str] = ("partition_dt",), order: Sequence[str] = ()) -> DataFrame:
    """One row per key and column that changed, with both values as text."""
    prev, cur = one_per_key(prev, keys, order), one_per_key(cur, keys, order)
    tracked = _tracked(cur, keys, ignore)
    both = _values(prev, keys, tracked, "old").join(_values(cur, keys, tracked, "new"), list(keys))
    old, new = (lambda c: F.col(f"old.`{c}`")), (lambda c: F.col(f"new.`{c}`"))
    diffs = F.array(*[
        F.when(~old(c).eqNullSafe(new(c)), F.struct(
            F.lit(c).alias("column_name"), old(c).cast("string").alias("old_value"),
            new(c).cast("string").alias("new_value")))
        for c in tracked])
    return both.select(*keys, F.explode(F.filter(diffs, lambda d: d.isNotNull())).alias("d")).select(*keys, "d.*")


def apply_scd2(latest: DataFrame, incoming: DataFrame, keys: Sequence[str], mode: str = "full",
               ignore: Sequence[str] = (), day: str = "partition_dt",
               history_day: dt.date | None = None, order: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Load one snapshot: the new latest rows, and the versions it moves to history.

    Every incoming row is in the new latest. The old version of an updated key goes to history. A
    key the snapshot lacks goes to history in ``full`` mode and stays active in ``delta`` mode.
    History rows keep their own partition date, so no partition holds a key in both tables;
    ``history_day`` stamps them with the load date instead.
    """
    if mode not in ("full", "delta"):
        raise ValueError(f"mode must be 'full' or 'delta', not {mode!r}")
    latest, incoming = one_per_key(latest, keys, order), one_per_key(incoming, keys, order)
    tracked = _tracked(incoming, keys, [day, *ignore])
    pack = lambda df, name: df.select(*keys, F.struct(*incoming.columns).alias(name))
    both = pack(latest, "o").join(pack(incoming, "n"), list(keys), "full")
    same = F.struct(*[F.col(f"o.`{c}`") for c in tracked]).eqNullSafe(F.struct(*[F.col(f"n.`{c}`") for c in tracked]))
    change = (F.when(F.col("o").isNull(), "new").when(F.col("n").isNull(), "omitted")
              .when(same, "unchanged").otherwise("updated"))
    both = both.withColumn("change", change)
    stays = F.col("n").isNotNull() | F.lit(mode == "delta")
    current = both.where(stays).select(F.coalesce("n", "o").alias("r")).select("r.*")
    leaves = ["updated", "omitted"] if mode == "full" else ["updated"]
    history = both.where(F.col("change").isin(leaves)).select("o.*")
    if history_day is not None:
        history = history.withColumn(day, F.lit(history_day))
    return current, history


def split_latest_history(snapshots: DataFrame, keys: Sequence[str], day: str = "partition_dt",
                         ignore: Sequence[str] = (), mode: str = "delta") -> tuple[DataFrame, DataFrame]:
    """Latest version per key and all replaced versions, from all snapshots; in ``full`` mode a key that the
    last snapshot lacks has no latest version."""
    versions = build_history(snapshots, keys, day, _tracked(snapshots, [*keys, day], ignore), mode=mode)
    columns = [*keys, *[c for c in snapshots.columns if c not in keys]]
    rows = versions.withColumnRenamed("effective_start_date", day)
    return (rows.where("is_current").select(*columns), rows.where("NOT is_current").select(*columns))


def build_history(snapshots: DataFrame, keys: Sequence[str], day: str = "partition_dt",
                  tracked: Sequence[str] | None = None, order: Sequence[str] = (), mode: str = "delta") -> DataFrame:
    """Versions per key with effective dates.

    Consecutive snapshots with equal tracked values are one version. It ends the day before the next
    version starts, the last one at 9999-12-31. In ``full`` mode a snapshot holds all keys: a version also
    ends the day before the first snapshot that lacks its key, and a key that returns starts a new one. The
    windows share one shuffle by key, and a key has at most one row per partition date in them.
    """
    if mode not in ("full", "delta"):
        raise ValueError(f"mode must be 'full' or 'delta', not {mode!r}")
    tracked = list(tracked or _tracked(snapshots, [*keys, day], ()))
    rows = one_per_key(snapshots.select(*keys, day, *tracked), [*keys, day], order)
    by_key = Window.partitionBy(*keys).orderBy(day)
    packed = rows.select(*keys, day, F.struct(*tracked).alias("v"))
    if mode == "full":
        return _full_history(packed, _neighbours(snapshots, day), keys, day)
    before = F.lag("v").over(by_key)
    starts = packed.withColumn("__before", before).where(
        F.col("__before").isNull() | ~F.col("v").eqNullSafe(F.col("__before")))
    following = F.lead(day).over(by_key)
    versions = starts.select(*keys, "v", F.col(day).alias("effective_start_date"),
                             following.alias("__next"), F.row_number().over(by_key).alias("version"))
    return versions.select(
        *keys, "v.*", "effective_start_date",
        F.coalesce(F.date_sub("__next", 1), F.lit(OPEN_END)).alias("effective_end_date"),
        "version", F.col("__next").isNull().alias("is_current"))


def _full_history(packed: DataFrame, days: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """Versions where a key that a snapshot lacks is closed."""
    by_key = Window.partitionBy(*keys).orderBy(day)
    seen = packed.select(*keys, day, "v", F.lag(day).over(by_key).alias("__last"), F.lag("v").over(by_key).alias("__old")).join(days, day)
    goes_on = (F.col("__last").isNotNull() & F.col("__last").eqNullSafe(F.col("__day_before")) & F.col("v").eqNullSafe(F.col("__old")))
    numbered = seen.withColumn("version", F.sum(F.when(goes_on, 0).otherwise(1)).over(by_key).cast("int"))
    # the date after the last snapshot of a version ends it
    versions = numbered.groupBy(*keys, "version").agg(
        F.min(F.struct(day, "v")).alias("first"), F.max(F.struct(day, "__day_after")).alias("last"))
    after = F.col("last.__day_after")
    return versions.select(*keys, "first.v.*", F.col(f"first.{day}").alias("effective_start_date"),
                           F.coalesce(F.date_sub(after, 1), F.lit(OPEN_END)).alias("effective_end_date"), "version", after.isNull().alias("is_current"))


def check_history(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Violations per key: not_one_current, overlap, gap. Empty for a sound history.

    Rows with the same key and start are merged before the window, so it sees one row per key and
    date even when a broken history repeats them.
    """
    starts = history.groupBy(*keys, "effective_start_date").agg(
        F.count(F.lit(1)).alias("n"), F.max("effective_end_date").alias("end"))
    by_key = Window.partitionBy(*keys).orderBy("effective_start_date")
    following = F.lead("effective_start_date").over(by_key)
    chained = starts.withColumn("__next", following)
    broken = (F.when((F.col("n") > 1) | (F.col("__next") <= F.col("end")), "overlap")
              .when(F.col("__next") > F.date_add("end", 1), "gap"))
    chain = chained.select(*keys, broken.alias("code")).where("code IS NOT NULL").distinct()
    current = (history.groupBy(*keys).agg(F.count_if(F.col("is_current")).alias("n")).where("n <> 1")
               .select(*keys, F.lit("not_one_current").alias("code")))
    return chain.unionByName(current)


def _on(df: DataFrame, day: dt.date, column: str) -> DataFrame:
    return df.where(F.col(column) == F.lit(day))


def source_not_in_latest(source: DataFrame, latest: DataFrame, day: dt.date, keys: Sequence[str] = ("id",),
                         column: str = "partition_dt") -> DataFrame:
    """Keys of the source partition that latest lacks; empty when the load is complete."""
    wanted = _on(source, day, column).select(*keys).distinct()
    return wanted.join(_on(latest, day, column).select(*keys).distinct(), list(keys), "left_anti")


def overlap(latest: DataFrame, history: DataFrame, day: dt.date, keys: Sequence[str] = ("id",),
            column: str = "partition_dt") -> DataFrame:
    """Keys that are in latest and in history of the same partition, with how often."""
    old = _on(history, day, column).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_history"))
    now = _on(latest, day, column).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_latest"))
    return now.join(old, list(keys)).select(*keys, (F.col("n_latest") * F.col("n_history")).alias("pairs"))


def unchanged_updates(latest: DataFrame, history: DataFrame, columns: Sequence[str], day: dt.date,
                      keys: Sequence[str] = ("id",), column: str = "partition_dt") -> DataFrame:
    """Keys whose replaced version has the same business values as the latest one; NULL equals NULL."""
    same = [*keys, *columns]
    old = _on(history, day, column).select(*same).distinct()
    # grouped together, equal values meet whether they are NULL or not
    both = _on(latest, day, column).select(*same).distinct().unionByName(old)
    return both.groupBy(*same).agg(F.count(F.lit(1)).alias("__n")).where("__n = 2").select(*same)


def update_vs_history(source: DataFrame, latest: DataFrame, history: DataFrame, columns: Sequence[str],
                      day: dt.date, keys: Sequence[str] = ("id",), flag: str | None = None,
                      column: str = "partition_dt") -> DataFrame:
    """One row with the number of updated source keys and of history entries; sound when equal.

    With ``flag`` (a boolean source column) flagged source rows and history rows are counted. A change
    from or to NULL is an update, as everywhere here; plain inequality would miss it.
    """
    src, old = _on(source, day, column), _on(history, day, column)
    if flag is not None:
        updates = src.agg(F.count_if(F.col(flag)).alias("source_update_count"))
        entries = old.agg(F.count(F.lit(1)).alias("history_record_count"))
    else:
        now = _on(latest, day, column).select(*keys, *columns).distinct()
        was = old.select(*keys, *[F.col(c).alias(f"__was_{c}") for c in columns]).distinct()
        differs = F.lit(False)
        for c in columns:
            differs = differs | ~F.col(c).eqNullSafe(F.col(f"__was_{c}"))
        changed = now.join(was, list(keys)).where(differs).select(*keys).distinct()
        updated = changed.join(src.select(*keys).distinct(), list(keys), "left_semi")
        updates = updated.agg(F.count(F.lit(1)).alias("source_update_count"))
        entries = old.select(*keys).distinct().agg(F.count(F.lit(1)).alias("history_record_count"))
    from .relational import scalars
    return scalars(source.sparkSession, {"source_update_count": updates, "history_record_count": entries})


def change_summary(classes: DataFrame, day: str = "partition_dt") -> DataFrame:
    """Keys per class and partition."""
    return classes.groupBy(day, "change").agg(F.count(F.lit(1)).alias("n"))


def change_keys(classes: DataFrame, keys: Sequence[str], day: str = "partition_dt") -> DataFrame:
    """The keys behind the counts, one row each, sorted by partition, class and key.

    They stay rows: a list per class would grow with the table.
    """
    return classes.select(day, "change", *keys).orderBy(day, "change", *keys)
