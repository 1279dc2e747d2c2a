"""Table references of definitions, latest partitions, and date bindings."""

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import DefinitionError
from ..functions.dates import strict_date
from ..schemas import PARTITION_INFO_COLUMNS
from .validate import PLACEHOLDER, RUN_DATE, TABLE_REF

_KEY = ["project_dataset", "table_name"]


def table_refs(defs: DataFrame) -> DataFrame:
    """Every backticked ``project.dataset.table`` of each SQL, with its position in order."""
    names = F.transform(F.regexp_extract_all("sql", F.lit(TABLE_REF), F.lit(0)), lambda t: F.btrim(t, F.lit("`")))
    refs = defs.select("metric_id", F.posexplode(names).alias("pos", "table_ref"))
    return refs.select("metric_id", "pos", "table_ref", *_split("table_ref"))


def _split(column: str) -> list:
    """Project, dataset and table of a reference; the table part may hold further dots."""
    part = lambda i: F.regexp_extract(column, r"^([^.]+)\.([^.]+)\.(.+)$", i)
    return [part(1).alias("project"), part(2).alias("dataset"), part(3).alias("table_name")]


def distinct_refs(defs: DataFrame) -> DataFrame:
    """Distinct tables over all definitions."""
    return table_refs(defs).select("project", "dataset", "table_name").distinct()


def source_columns() -> list:
    """``source_dataset`` and ``source_table_name`` of a definition's SQL, UNKNOWN without a reference."""
    ref = F.btrim(F.regexp_extract("sql", TABLE_REF, 0), F.lit("`"))
    part = lambda i: F.regexp_extract(ref, r"^([^.]+)\.([^.]+)\.(.+)$", i)
    known = lambda c: F.coalesce(F.nullif(c, F.lit("")), F.lit("UNKNOWN"))
    return [known(part(2)).alias("source_dataset"), known(part(3)).alias("source_table_name")]


def source_table(defs: DataFrame) -> DataFrame:
    """Dataset and table of the first reference of each metric, else UNKNOWN."""
    return defs.select("metric_id", *source_columns())


def _valid(info: DataFrame) -> DataFrame:
    """Rows with a usable date; a text date must be a real calendar day."""
    if dict(info.dtypes)["partition_dt"] == "string":
        info = info.withColumn("partition_dt", strict_date(F.col("partition_dt")))
    return info.where("partition_dt IS NOT NULL")


def latest_partition(info: DataFrame, keys: Sequence[str] = _KEY) -> DataFrame:
    """Latest partition date per table; tables with only NULL or invalid dates are absent."""
    return _valid(info).groupBy(*keys).agg(F.max("partition_dt").alias("partition_dt"))


def latest_partitions(info: DataFrame, refs: DataFrame, as_of: dt.date | None = None,
                      lookback_days: int | None = 30) -> DataFrame:
    """Latest date of all requested tables in one pass.

    ``refs`` has the key columns. With ``as_of``, only partitions of the last ``lookback_days``
    count; the date bound reaches the scan. A maximum per key does what ranking the rows would do,
    and hot keys are reduced before the shuffle.
    """
    info = _valid(info)
    if as_of is not None and lookback_days is not None:
        info = info.where(F.col("partition_dt") >= F.lit(as_of - dt.timedelta(days=lookback_days)))
    latest = latest_partition(info)
    return latest.join(refs.select(*_KEY).distinct(), _KEY, "left_semi")


def missing_partitions(refs: DataFrame, latest: DataFrame) -> DataFrame:
    """Requested tables without any partition information."""
    return refs.select(*_KEY).distinct().join(latest.select(*_KEY), _KEY, "left_anti")


def require_partition_columns(info: DataFrame) -> None:
    """A usable partition-info table has its columns; nothing is read."""
    missing = [c for c in PARTITION_INFO_COLUMNS if c not in info.columns]
    if missing:
        raise DefinitionError(f"partition info lacks the columns {missing}")


def validate_partition_info(info: DataFrame) -> int:
    """Row count of a usable partition-info table; missing columns are an error."""
    require_partition_columns(info)
    return info.count()


def _with_dates(requests: DataFrame, latest: DataFrame) -> DataFrame:
    """Add the latest date by ``project.dataset``, else by ``dataset`` alone."""
    keyed = latest.select(F.col("project_dataset").alias("k"), F.col("table_name").alias("t"),
                          F.col("partition_dt").alias("d"))
    long, short = keyed.alias("long"), keyed.alias("short")
    r = requests.alias("r")
    return (r.join(long, F.expr("long.k = concat(r.project, '.', r.dataset) AND long.t = r.table_name"), "left")
            .join(short, F.expr("short.k = r.dataset AND short.t = r.table_name"), "left")
            .select("r.*", F.coalesce("long.d", "short.d").alias("latest_dt")))


def bind_dates(defs: DataFrame, run_date: dt.date, latest: DataFrame) -> DataFrame:
    """The date of each placeholder, in order of appearance.

    ``{currently}`` is the run date. ``{partition_info}`` is the latest date of the nearest table
    reference before it. ``error`` says why a placeholder has no date.
    """
    tokens = F.regexp_extract_all("sql", F.lit(f"{TABLE_REF}|{PLACEHOLDER}"), F.lit(0))
    spots = F.filter(F.sequence(F.lit(1), F.size("tokens")), lambda i: F.element_at("tokens", i).startswith("{"))
    before = F.filter(F.slice("tokens", 1, F.col("spot")), lambda t: t.startswith("`"))
    requests = (
        defs.select("metric_id", tokens.alias("tokens")).where(F.size("tokens") > 0)
        .select("metric_id", "tokens", F.posexplode(spots).alias("ordinal", "spot"))
        .select("metric_id", "ordinal", F.btrim(F.element_at("tokens", F.col("spot")), F.lit("{}")).alias("placeholder"),
                F.btrim(F.get(before, F.size(before) - 1), F.lit("`")).alias("ref"))
        .select("metric_id", "ordinal", "placeholder", "ref", *_split("ref"))
    )
    dated = _with_dates(requests, latest)
    current = F.col("placeholder") == "currently"
    day = F.when(current, F.lit(run_date)).otherwise(F.col("latest_dt"))
    error = (F.when(current, None).when(F.col("ref").isNull(), "no table reference before the placeholder")
             .when(day.isNull(), F.concat(F.lit("no partition date for "), F.col("ref"))))
    return dated.select("metric_id", "ordinal", "placeholder", "ref", day.alias("bound_date"), error.alias("error"))


def bind_positional(defs: DataFrame, run_date: dt.date, latest: DataFrame) -> DataFrame:
    """Dates of ``{run_date}`` placeholders: the n-th takes the mode and the date of the n-th table."""
    modes = F.transform(F.split("partition_mode", r"\|"), lambda m: F.trim(m))
    tables = F.transform(F.regexp_extract_all("sql", F.lit(TABLE_REF), F.lit(0)), lambda t: F.btrim(t, F.lit("`")))
    n = F.regexp_count("sql", F.lit(RUN_DATE))
    requests = (
        defs.select("metric_id", F.posexplode(F.arrays_zip(modes.alias("mode"), tables.alias("ref"))).alias("ordinal", "z"),
                    (F.size(modes) != F.size(tables)).alias("uneven"), (n != F.size(modes)).alias("off"))
        .select("metric_id", "ordinal", "z.mode", "z.ref", "uneven", "off", *_split("z.ref"))
    )
    dated = _with_dates(requests, latest)
    current = F.col("mode") == "currently"
    day = F.when(current, F.lit(run_date)).otherwise(F.col("latest_dt"))
    error = (F.when(F.col("uneven"), "tables and partition modes differ in number")
             .when(F.col("off"), "date placeholders and partition modes differ in number")
             .when(day.isNull(), F.concat(F.lit("no partition date for "), F.col("ref"))))
    return dated.select("metric_id", "ordinal", "mode", "ref", day.alias("bound_date"), error.alias("error"))
