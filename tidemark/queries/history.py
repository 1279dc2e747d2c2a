"""Type 2 history, with the last event of a user per day as that day's snapshot."""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ..operators import scd2 as S
from ..operators import stored_history as H
from ..session import checkpoint
from .base import query, table

_D1, _D2 = dt.date(2024, 1, 20), dt.date(2024, 1, 21)

_SNAPSHOTS = ("snap AS (SELECT user_id AS id, CAST(ts AS DATE) AS partition_dt, event_type AS col1, CASE WHEN value < 20 THEN NULL ELSE CAST(floor(value / 40) AS BIGINT) END AS col2 "
              "FROM (SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_type DESC, value DESC) AS rn FROM events) WHERE rn = 1)")


def _snapshots(spark, sf, day="to_date(ts)"):
    events = table(spark, sf, "events").select(
        F.col("user_id").alias("id"), F.expr(day).alias("partition_dt"), F.col("event_type").alias("col1"), "ts", "value")
    last = S.one_per_key(events, ["id", "partition_dt"], ["ts", "col1", "value"])
    return last.select("id", "partition_dt", "col1", F.when(F.col("value") >= 20, F.floor(F.col("value") / 40)).alias("col2"))


def _day(df, day):
    return df.where(F.col("partition_dt") == F.lit(day))


def _text(df, *columns):
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


_P = "p AS (SELECT * FROM snap WHERE partition_dt = DATE '2024-01-20'), c AS (SELECT * FROM snap WHERE partition_dt = DATE '2024-01-21')"
_CLASS = ("CASE WHEN p.id IS NULL THEN 'new' WHEN c.id IS NULL THEN 'omitted' WHEN p.col1 IS NOT DISTINCT FROM c.col1 AND p.col2 IS NOT DISTINCT FROM c.col2 THEN 'unchanged' ELSE 'updated' END")
_BOTH = f"b AS (SELECT coalesce(p.id, c.id) AS id, {_CLASS} AS change FROM p FULL JOIN c ON p.id = c.id)"


@query("sc01_classify_changes", f"WITH {_SNAPSHOTS}, {_P}, {_BOTH} SELECT * FROM b")
def _(spark, sf):
    snaps = _snapshots(spark, sf)
    return S.classify_changes(_day(snaps, _D1), _day(snaps, _D2), ["id"])


_ALL = (f"WITH {_SNAPSHOTS}, days AS (SELECT partition_dt AS d, lead(partition_dt) OVER (ORDER BY partition_dt) AS nd FROM (SELECT DISTINCT partition_dt FROM snap)), "
        "p AS (SELECT snap.*, nd FROM snap JOIN days ON d = partition_dt WHERE nd IS NOT NULL), "
        f"classes AS (SELECT coalesce(p.id, c.id) AS id, strftime(coalesce(p.nd, c.partition_dt), '%Y-%m-%d') AS partition_dt, {_CLASS} AS change "
        "FROM p FULL JOIN snap c ON p.id = c.id AND p.nd = c.partition_dt)")


@query("sc01_classify_all_days", f"{_ALL} SELECT * FROM classes")
def _(spark, sf):
    return _text(S.classify_snapshots(_snapshots(spark, sf), ["id"]), "partition_dt")


@query("sc02_column_diffs",
       f"WITH {_SNAPSHOTS}, {_P} SELECT p.id, 'col1' AS column_name, p.col1 AS old_value, c.col1 AS new_value FROM p JOIN c ON p.id = c.id WHERE p.col1 IS DISTINCT FROM c.col1 "
       "UNION ALL SELECT p.id, 'col2', CAST(p.col2 AS VARCHAR), CAST(c.col2 AS VARCHAR) FROM p JOIN c ON p.id = c.id WHERE p.col2 IS DISTINCT FROM c.col2")
def _(spark, sf):
    snaps = _snapshots(spark, sf)
    return S.column_diffs(_day(snaps, _D1), _day(snaps, _D2), ["id"])


def _load(spark, sf, mode, history_day=None):
    snaps = _snapshots(spark, sf)
    return (_day(snaps, _D2), *S.apply_scd2(_day(snaps, _D1), _day(snaps, _D2), ["id"], mode, history_day=history_day))


def _apply_sql(mode: str) -> str:
    stays = " UNION ALL SELECT 'latest', id, strftime(partition_dt, '%Y-%m-%d'), col1, col2 FROM p WHERE id NOT IN (SELECT id FROM c)" if mode == "delta" else ""
    gone = "('updated', 'omitted')" if mode == "full" else "('updated')"
    return (f"WITH {_SNAPSHOTS}, {_P}, {_BOTH} SELECT 'latest' AS place, id, strftime(partition_dt, '%Y-%m-%d') AS partition_dt, col1, col2 FROM c{stays} "
            f"UNION ALL SELECT 'history', p.id, strftime(partition_dt, '%Y-%m-%d'), col1, col2 FROM p JOIN b ON b.id = p.id WHERE change IN {gone}")


def _both_places(latest, history):
    rows = latest.withColumn("place", F.lit("latest")).unionByName(history.withColumn("place", F.lit("history")))
    return _text(rows, "partition_dt")


@query("sc03_full_load", _apply_sql("full"))
def _(spark, sf):
    return _both_places(*_load(spark, sf, "full")[1:])


@query("sc04_delta_load", _apply_sql("delta"))
def _(spark, sf):
    return _both_places(*_load(spark, sf, "delta")[1:])


_HISTORY = (f"WITH {_SNAPSHOTS}, lagged AS (SELECT *, lag(col1) OVER w AS l1, lag(col2) OVER w AS l2, row_number() OVER w AS rn FROM snap WINDOW w AS (PARTITION BY id ORDER BY partition_dt)), "
            "starts AS (SELECT * FROM lagged WHERE rn = 1 OR col1 IS DISTINCT FROM l1 OR col2 IS DISTINCT FROM l2), "
            "hist AS (SELECT id, col1, col2, partition_dt AS s, lead(partition_dt) OVER w AS nx, row_number() OVER w AS version FROM starts WINDOW w AS (PARTITION BY id ORDER BY partition_dt))")


@query("sc05_latest_history_split",
       f"{_HISTORY} SELECT CASE WHEN nx IS NULL THEN 'latest' ELSE 'history' END AS place, id, strftime(s, '%Y-%m-%d') AS partition_dt, col1, col2 FROM hist")
def _(spark, sf):
    return _both_places(*S.split_latest_history(_snapshots(spark, sf), ["id"]))


@query("sc06_build_history",
       f"{_HISTORY} SELECT id, col1, col2, strftime(s, '%Y-%m-%d') AS effective_start_date, coalesce(strftime(nx - 1, '%Y-%m-%d'), '9999-12-31') AS effective_end_date, CAST(version AS INTEGER) AS version, nx IS NULL AS is_current FROM hist")
def _(spark, sf):
    return _text(S.build_history(_snapshots(spark, sf), ["id"]), "effective_start_date", "effective_end_date")


@query("sc06_loaded_by_week", (f"{_HISTORY} SELECT id, col1, col2, strftime(s, '%Y-%m-%d') AS effective_start_date, coalesce(strftime(nx - 1, '%Y-%m-%d'), '9999-12-31') AS effective_end_date, "
       "CAST(version AS INTEGER) AS version, nx IS NULL AS is_current FROM hist").replace("CAST(ts AS DATE)", "CAST(date_trunc('week', ts) AS DATE)"))
def _(spark, sf):
    snaps = checkpoint(_snapshots(spark, sf, "to_date(date_trunc('week', ts))"))
    place = f"tidemark_versions_{uuid.uuid4().hex}"
    try:
        for row in snaps.select("partition_dt").distinct().orderBy("partition_dt").collect():
            H.load_day(spark, place, snaps, ["id"], row.partition_dt, buckets=8)
        return checkpoint(_text(H.read_history(spark, place, ["id"]), "effective_start_date", "effective_end_date"))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {place}")


# break some histories: an end moved, and a current flag lost
_BROKEN = ("broken AS (SELECT id, s, CASE WHEN col1 = 'error' AND nx IS NOT NULL THEN CAST(nx - 2 AS DATE) WHEN col1 = 'signup' AND nx IS NOT NULL THEN CAST(nx + 2 AS DATE) ELSE coalesce(CAST(nx - 1 AS DATE), DATE '9999-12-31') END AS e, "
           "nx IS NULL AND col1 <> 'view' AS cur FROM hist), chained AS (SELECT *, lead(s) OVER (PARTITION BY id ORDER BY s) AS ns FROM broken)")


@query("sc07_check_history",
       f"{_HISTORY}, {_BROKEN} SELECT DISTINCT id, 'overlap' AS code FROM chained WHERE ns <= e UNION ALL SELECT DISTINCT id, 'gap' FROM chained WHERE ns > e + 1 "
       "UNION ALL SELECT id, 'not_one_current' FROM broken GROUP BY id HAVING count(*) FILTER (cur) <> 1")
def _(spark, sf):
    history = S.build_history(_snapshots(spark, sf), ["id"])
    end, closed = F.col("effective_end_date"), ~F.col("is_current")
    broken = history.withColumns({
        "effective_end_date": F.when((F.col("col1") == "error") & closed, F.date_sub(end, 1)).when((F.col("col1") == "signup") & closed, F.date_add(end, 3)).otherwise(end),
        "is_current": F.col("is_current") & (F.col("col1") != "view")})
    return S.check_history(broken, ["id"])


@query("sc07_sound_history", f"{_HISTORY} SELECT count(*) - count(*) AS violations, count(*) AS versions FROM hist")
def _(spark, sf):
    history = S.build_history(_snapshots(spark, sf), ["id"])
    bad = S.check_history(history, ["id"]).agg(F.count(F.lit(1)).alias("n"))
    return history.agg(F.count(F.lit(1)).alias("versions")).select(bad.scalar().alias("violations"), "versions")


@query("sc08_source_not_in_latest", f"WITH {_SNAPSHOTS}, {_P} SELECT id FROM c WHERE col1 = 'error'")
def _(spark, sf):
    source, latest, _ = _load(spark, sf, "full")
    return S.source_not_in_latest(source, latest.where("col1 <> 'error'"), _D2)


@query("sc09_overlap", f"WITH {_SNAPSHOTS}, {_P}, {_BOTH} SELECT b.id, 1::BIGINT AS pairs FROM b WHERE change = 'updated'")
def _(spark, sf):
    _, latest, history = _load(spark, sf, "full", history_day=_D2)
    return S.overlap(latest, history, _D2)


_GAPS = (f"WITH {_SNAPSHOTS}, days AS (SELECT partition_dt AS d, lag(partition_dt) OVER (ORDER BY partition_dt) AS pd, lead(partition_dt) OVER (ORDER BY partition_dt) AS nd FROM (SELECT DISTINCT partition_dt FROM snap)), "
         "r AS (SELECT snap.*, pd, nd, lag(partition_dt) OVER w AS lp, lag(col1) OVER w AS l1, lag(col2) OVER w AS l2 FROM snap JOIN days ON d = partition_dt WINDOW w AS (PARTITION BY id ORDER BY partition_dt)), "
         "n AS (SELECT *, sum(CASE WHEN lp = pd AND col1 IS NOT DISTINCT FROM l1 AND col2 IS NOT DISTINCT FROM l2 THEN 0 ELSE 1 END) OVER (PARTITION BY id ORDER BY partition_dt) AS version FROM r)")


@query("sc06_full_history",
       f"{_GAPS} SELECT id, min(col1) AS col1, min(col2) AS col2, strftime(min(partition_dt), '%Y-%m-%d') AS effective_start_date, CASE WHEN max(partition_dt) = (SELECT max(d) FROM days) THEN '9999-12-31' ELSE strftime(max(nd) - 1, '%Y-%m-%d') END AS effective_end_date, "
       "CAST(version AS INTEGER) AS version, max(partition_dt) = (SELECT max(d) FROM days) AS is_current FROM n GROUP BY id, version")
def _(spark, sf):
    return _text(S.build_history(_snapshots(spark, sf), ["id"], mode="full"), "effective_start_date", "effective_end_date")


@query("sc10_unchanged_updates", f"WITH {_SNAPSHOTS}, {_P} SELECT p.id, p.col1 FROM p JOIN c ON p.id = c.id AND p.col1 = c.col1 WHERE p.col2 IS DISTINCT FROM c.col2")
def _(spark, sf):
    _, latest, history = _load(spark, sf, "full", history_day=_D2)
    return S.unchanged_updates(latest, history, ["col1"], _D2)


@query("sc11_update_vs_history",
       f"WITH {_SNAPSHOTS}, {_P}, {_BOTH} SELECT (SELECT count(*) FROM p JOIN c ON p.id = c.id WHERE p.col1 IS DISTINCT FROM c.col1) AS source_update_count, (SELECT count(*) FROM b WHERE change = 'updated') AS history_record_count")
def _(spark, sf):
    source, latest, history = _load(spark, sf, "delta", history_day=_D2)
    return S.update_vs_history(source, latest, history, ["col1"], _D2)


@query("sc11_update_flag", f"WITH {_SNAPSHOTS}, {_P}, {_BOTH} SELECT (SELECT count(*) FROM c WHERE col1 = 'click') AS source_update_count, (SELECT count(*) FROM b WHERE change = 'updated') AS history_record_count")
def _(spark, sf):
    source, latest, history = _load(spark, sf, "delta", history_day=_D2)
    return S.update_vs_history(source.withColumn("is_updated", F.col("col1") == "click"), latest, history, ["col1"], _D2, flag="is_updated")


@query("sc12_change_summary", f"{_ALL} SELECT partition_dt, change, count(*) AS n FROM classes GROUP BY 1, 2")
def _(spark, sf):
    return _text(S.change_summary(S.classify_snapshots(_snapshots(spark, sf), ["id"])), "partition_dt")


@query("sc12_change_keys", f"{_ALL} SELECT partition_dt, change, id FROM classes")
def _(spark, sf):
    return _text(S.change_keys(S.classify_snapshots(_snapshots(spark, sf), ["id"]), ["id"]), "partition_dt")
