import datetime as dt
import random
import uuid
from decimal import Decimal

import pytest

from tidemark.errors import DefinitionError, SourceError
from tidemark.operators import agg_states as S
from tidemark.operators.aggregates import Measure, measure

DAYS = [dt.date(2024, 3, d) for d in range(1, 8)]
MEASURES = [Measure("n"), Measure("big", where="v > 5"), Measure("hits", "count_if", condition="kind = 'a'"), Measure("total", "sum", "p", default=0),
            Measure("total_a", "sum_if", "v", condition="kind = 'a'"), Measure("low", "min", "v"), Measure("high", "max", "kind"), Measure("mean", "avg", "p"),
            Measure("mean_v", "avg", "v", where="kind = 'b'"), Measure("users", "count_distinct", "u"), Measure("users_a", "count_distinct", "u", where="kind = 'a'"),
            Measure("kinds", "count_distinct", "kind"), Measure("none", "sum", "p", where="v > 100", default=0), Measure("no_max", "max", "v", where="v > 100")]


def events(spark, seed=3, days=DAYS):
    rng = random.Random(seed)
    rows = [(rng.choice(days), rng.choice(["a", "b", None]), rng.choice([None, *range(12)]), rng.choice([None, Decimal("1.25"), Decimal("-7.10")]), rng.randrange(60))
            for _ in range(700)]
    return spark.createDataFrame(rows, "day date, kind string, v int, p decimal(12,2), u int").coalesce(1).cache()


@pytest.fixture(params=["folder", "table"])
def place(request, spark, tmp_path):
    if request.param == "folder":
        yield str(tmp_path / "states")
    else:
        name = f"states_{uuid.uuid4().hex}"
        yield name
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_merged_states_equal_the_full_scan(spark, place):
    df = events(spark)
    assert S.pending(spark, place, df, "day") == DAYS
    S.load_states(spark, place, df, MEASURES, "day", DAYS[:4])
    assert S.pending(spark, place, df, "day") == DAYS[4:]
    some = S.merge_states(spark, place, MEASURES)
    assert some.collect() == measure(df.where("day <= '2024-03-04'"), MEASURES).collect()
    S.load_states(spark, place, df, MEASURES, "day", S.pending(spark, place, df, "day"))
    full = measure(df, MEASURES)
    merged = S.merge_states(spark, place, MEASURES)
    assert merged.collect() == full.collect() and merged.dtypes == full.dtypes and S.pending(spark, place, df, "day") == []
    part = S.merge_states(spark, place, MEASURES, where="day > '2024-03-05'")
    assert part.collect() == measure(df.where("day > '2024-03-05'"), MEASURES).collect()


def test_changed_and_emptied_partitions_are_replaced(spark, place):
    S.load_states(spark, place, events(spark), MEASURES, "day", DAYS)
    changed = events(spark, seed=9, days=[*DAYS[:2], *DAYS[3:], None])
    S.load_states(spark, place, changed, MEASURES, "day", [None, *DAYS])
    S.load_states(spark, place, changed, MEASURES, "day", [None, DAYS[0], DAYS[0]])
    S.load_states(spark, place, changed, MEASURES, "day", [])
    assert S.merge_states(spark, place, MEASURES).collect() == measure(changed, MEASURES).collect()
    assert S.pending(spark, place, changed, "day") == []


def test_states_of_nothing(spark, tmp_path):
    place = str(tmp_path / "states")
    nothing = events(spark).where("false")
    S.load_states(spark, place, nothing, MEASURES, "day", DAYS[:1])
    assert S.merge_states(spark, place, MEASURES).collect() == measure(nothing, MEASURES).collect()


def test_only_the_given_partitions_are_read(spark, tmp_path, capsys):
    source = str(tmp_path / "events")
    events(spark).write.partitionBy("day").parquet(source)
    S.partition_states(spark.read.parquet(source).where("day = DATE '2024-03-02'"), MEASURES, "day").explain()
    scans = [line for line in capsys.readouterr().out.splitlines() if "FileScan" in line]
    assert scans and all("day" in line.split("PartitionFilters: [")[1].split("]")[0] for line in scans)
    states = str(tmp_path / "states")
    S.load_states(spark, states, spark.read.parquet(source), MEASURES, "day", DAYS)
    S.merge_states(spark, states, MEASURES, where="day > '2024-03-05'").explain()
    scans = [line for line in capsys.readouterr().out.splitlines() if "FileScan" in line]
    assert scans and all("day" in line.split("PartitionFilters: [")[1].split("]")[0] and "state_set" in line for line in scans)


def test_sketches_merge(spark, tmp_path):
    place = str(tmp_path / "states")
    df = spark.range(40000).selectExpr("date_add(DATE '2024-03-01', cast(id % 7 as int)) AS day", "cast(id % 9000 as int) AS u", "cast(id % 500 as decimal(9,1)) AS p")
    wanted = [Measure("users", "count_distinct", "u"), Measure("low", "count_distinct", "u", where="u < 100"), Measure("prices", "count_distinct", "p"), Measure("n")]
    days = S.pending(spark, place, df, "day")
    for some in (days[:3], days[3:]):
        S.load_states(spark, place, df, wanted, "day", some, exact=False)
    row = S.merge_states(spark, place, wanted, exact=False).first()
    assert row.n == 40000 and abs(row.users / 9000 - 1) < 0.03 and abs(row.low - 100) < 3 and abs(row.prices / 500 - 1) < 0.03


def test_other_measures_and_names_are_refused(spark, tmp_path):
    place = str(tmp_path / "states")
    S.load_states(spark, place, events(spark), MEASURES, "day", DAYS)
    with pytest.raises(SourceError, match="other measures"):
        S.merge_states(spark, place, [Measure("n", where="v > 1"), *MEASURES[1:]])
    with pytest.raises(SourceError, match="other measures"):
        S.merge_states(spark, place, MEASURES, exact=False)
    for bad in ([Measure("Day")], [Measure("n"), Measure("n")]):
        with pytest.raises(DefinitionError):
            S.partition_states(events(spark), bad, "day")
