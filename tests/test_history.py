import datetime as dt
import random

import pytest

from tidemark.operators import scd2 as S

D = [dt.date(2024, 1, d) for d in range(1, 8)]


def snapshots(spark, seed=5):
    """Daily snapshots with gaps and repeated rows; key 1 is in a third of the input rows."""
    draw = random.Random(seed)
    data = []
    for day in D:
        for key in range(1, 9):
            if draw.random() < 0.75:
                data.append((key, draw.choice(["a", "b"]), draw.choice([None, 1]), day))
    data += [r for r in data if r[0] == 1] * 20
    return data, spark.createDataFrame(data, "id int, col1 string, col2 int, partition_dt date")


def brute_history(data):
    latest = {(k, d): (a, b) for k, a, b, d in data}
    out = []
    for key in sorted({k for k, _ in latest}):
        versions, last = [], None
        for day in sorted(d for k, d in latest if k == key):
            if latest[key, day] != last:
                last = latest[key, day]
                versions.append((day, last))
        for i, (day, value) in enumerate(versions):
            end = versions[i + 1][0] - dt.timedelta(days=1) if i + 1 < len(versions) else S.OPEN_END
            out.append((key, *value, day, end, i + 1, i + 1 == len(versions)))
    return out


def test_history_equals_brute_force_and_is_sound(spark):
    for seed in (5, 6):
        data, df = snapshots(spark, seed)
        history = S.build_history(df, ["id"])
        assert sorted((tuple(r) for r in history.collect()), key=lambda r: (r[0], r[5])) == brute_history(data)
        assert S.check_history(history, ["id"]).isEmpty()
        latest, old = S.split_latest_history(df, ["id"])
        assert latest.count() == latest.select("id").distinct().count() and latest.count() + old.count() == len(brute_history(data))


def test_history_flaws_are_named(spark):
    rows = [(1, D[0], D[2], False), (1, D[2], S.OPEN_END, True), (2, D[0], D[1], False), (2, D[3], S.OPEN_END, True), (3, D[0], D[1], False),
            (4, D[0], S.OPEN_END, True), (4, D[0], S.OPEN_END, True)]
    history = spark.createDataFrame(rows, "id int, effective_start_date date, effective_end_date date, is_current boolean")
    found = {tuple(r) for r in S.check_history(history, ["id"]).collect()}
    assert found == {(1, "overlap"), (2, "gap"), (3, "not_one_current"), (4, "overlap"), (4, "not_one_current")}


def test_classes_partition_the_keys(spark):
    data, df = snapshots(spark)
    one = S.one_per_key(df, ["id", "partition_dt"])
    prev, cur = one.where(one.partition_dt == D[1]), one.where(one.partition_dt == D[2])
    classes = {r.id: r.change for r in S.classify_changes(prev, cur, ["id"]).collect()}
    p = {k: (a, b) for k, a, b, d in data if d == D[1]}
    c = {k: (a, b) for k, a, b, d in data if d == D[2]}
    expected = {k: "new" if k not in p else "omitted" if k not in c else "unchanged" if p[k] == c[k] else "updated" for k in p | c}
    assert classes == expected
    diffs = {(r.id, r.column_name): (r.old_value, r.new_value) for r in S.column_diffs(prev, cur, ["id"]).collect()}
    text = lambda v: None if v is None else str(v)
    assert diffs == {(k, f"col{i + 1}"): (text(p[k][i]), text(c[k][i])) for k in p for i in (0, 1) if k in c and p[k][i] != c[k][i]}


@pytest.mark.parametrize("mode", ["full", "delta"])
def test_load_passes_its_checks(spark, mode):
    _, df = snapshots(spark)
    one = S.one_per_key(df, ["id", "partition_dt"])
    prev, cur = one.where(one.partition_dt == D[1]), one.where(one.partition_dt == D[2])
    latest, history = S.apply_scd2(prev, cur, ["id"], mode)
    assert S.source_not_in_latest(cur, latest, D[2]).isEmpty() and S.overlap(latest, history, D[2]).isEmpty()
    omitted = {r.id for r in prev.collect()} - {r.id for r in cur.collect()}
    assert {r.id for r in latest.collect()} & omitted == (omitted if mode == "delta" else set())
    latest, history = S.apply_scd2(prev, cur, ["id"], mode, history_day=D[2])
    assert S.unchanged_updates(latest, history, ["col1", "col2"], D[2]).count() == 0
    counts = S.update_vs_history(cur, latest, history, ["col1"], D[2]).first()
    assert counts.history_record_count >= counts.source_update_count


def test_first_snapshot_is_all_new(spark):
    _, df = snapshots(spark)
    one = S.one_per_key(df, ["id", "partition_dt"])
    only = one.where(one.partition_dt == D[0])
    assert {r.change for r in S.classify_snapshots(only, ["id"]).collect()} == {"new"}
    summary = S.change_summary(S.classify_snapshots(one, ["id"]))
    assert summary.where(summary.partition_dt == D[0]).select("change").distinct().count() == 1
