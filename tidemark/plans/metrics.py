"""Run metric definitions: bind dates, evaluate together, check, and give one row per metric.

Each definition is SQL text that returns one row. The bound queries become scalar subqueries of one
plan, so Spark merges those that read the same slice of a table into one scan and runs the rest in
parallel. Definitions and one result row per metric are configuration-sized; the tables they read
never pass through the driver.
"""

import datetime as dt
import re
import threading
import uuid
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import JOB_ERRORS, DefinitionError, MetricError, first_line
from ..functions.dates import strict_date
from ..functions.numbers import denominator_status, numeric_warning, to_metric_decimal
from ..operators.isolate import halves, run_apart
from ..operators.partitions import bind_dates, bind_positional
from ..schemas import DEFINITION_SCHEMA, NUMERIC_RESULTS, RESULT_SCHEMA, TEXT_RESULTS
from ..session import checkpoint
from .columns import NUMERIC, ColumnMap

QUERY_TIMEOUT_SECONDS = 180
ANALYSIS_THREADS = 8
_SPOT = re.compile(r"\{(currently|partition_info|run_date)\}")
# a text in either quotes, a quoted name, or a placeholder outside of them
_PIECE = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.|\"\")*\"|`[^`]*`|" + _SPOT.pattern, re.S)
_MORE = "__more"  # a raw column: there was a second result row
SECOND_ROW = "the query returned more than one row; the first was taken"

# Messages of the denominator and date checks.
ZERO_DENOMINATOR = ("Invalid denominator value: denominator_value is 0. "
                    "Cannot calculate metrics with zero denominator.")
NEGATIVE_DENOMINATOR = ("Invalid denominator value: denominator_value is negative. "
                        "Negative denominators are not allowed.")
NO_BUSINESS_DATE = "business_data_date is required but was not returned by the SQL query"


@contextmanager
def table_views(spark: SparkSession, tables: Mapping[str, DataFrame]):
    """Make each ``project.dataset.table`` readable under its backticked name while queries are built.

    A temporary view of the caller with such a name is put back afterwards.
    """
    own = {view.name for view in spark.catalog.listTables() if view.isTemporary}
    before = {name: spark.table(f"`{name}`") for name in tables if name in own}
    for name, df in tables.items():
        df.createOrReplaceTempView(f"`{name}`")
    try:
        yield
    finally:
        for name in tables:
            spark.catalog.dropTempView(name)
        for name, df in before.items():
            df.createOrReplaceTempView(f"`{name}`")


def parametrize(sql: str) -> str:
    """SQL with the n-th placeholder as the named parameter ``:d<n>``, quotes of either kind around it dropped.

    A placeholder inside a longer text cannot be a typed date; it is refused.
    """
    count = iter(range(sql.count("{") + 1))

    def piece(found: re.Match) -> str:
        text = found[0]
        spots = _SPOT.findall(text)
        if not spots:
            return text
        if text[0] == "{" or _SPOT.fullmatch(text[1:-1]) and text[0] != "`":
            return f":d{next(count)}"
        raise MetricError(f"placeholder inside a longer text: {text}; join the pieces with concat or ||")

    return _PIECE.sub(piece, sql)


def bound_query(spark: SparkSession, sql: str, dates: Sequence[dt.date]) -> DataFrame:
    """The query of a definition with typed dates in place of its placeholders; nothing runs yet."""
    text = parametrize(sql)
    return spark.sql(text, args={f"d{i}": day for i, day in enumerate(dates)} or None)


def raw_values(result: DataFrame, columns: ColumnMap | None = None) -> DataFrame:
    """First row of a metric's result, every value as text, NULL where the SQL does not return it.

    Text keeps every number exact and gives all metrics one row type. The projection is SQL text:
    a run builds it once per metric.
    """
    columns = columns or ColumnMap()
    returned = {f.name: f.dataType for f in result.schema}
    names = {name: columns.column(name) for name in columns.names}
    names |= {name: name for name in TEXT_RESULTS if name not in names}

    def text(column: str) -> str:
        if column not in returned:
            return "CAST(NULL AS STRING)"
        quoted = "`" + column.replace("`", "``") + "`"
        if isinstance(returned[column], (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return f"date_format({quoted}, 'yyyy-MM-dd')"
        return f"CAST({quoted} AS STRING)"

    shown = [f"{text(column)} AS `{name}`" for name, column in names.items()]
    if _one_row_at_most(result):
        return result.selectExpr(*shown, f"CAST(NULL AS STRING) AS {_MORE}")
    # the first row, and whether there is a second one
    two = result.limit(2).selectExpr("struct(" + ", ".join(shown) + ") AS v").groupBy().agg(F.first("v").alias("v"), F.count("v").alias("n"))
    return two.where("n > 0").selectExpr("v.*", f"IF(n > 1, 'yes', NULL) AS {_MORE}")


def _one_row_at_most(result: DataFrame) -> bool:
    """Whether the plan itself says so, as that of an aggregate without groups does."""
    most = result._jdf.queryExecution().analyzed().maxRows()
    return most.isDefined() and most.get() <= 1


def checked_values(raw: DataFrame, columns: ColumnMap | None = None) -> DataFrame:
    """Text values as typed ones, with the ``error`` of a bad denominator or date and a ``warning``."""
    columns = columns or ColumnMap()
    numeric = [n for n, kind in columns.kinds.items() if kind == NUMERIC and n in columns.names]
    given = F.col("business_data_date")
    status = denominator_status(F.col("denominator_value")) if "denominator_value" in raw.columns else F.lit("SKIP")
    error = (
        F.when(status == "ZERO", ZERO_DENOMINATOR)
        .when(status == "NEGATIVE", NEGATIVE_DENOMINATOR)
        .when(given.isNull(), NO_BUSINESS_DATE)
        .when(strict_date(given).isNull(), F.concat(
            F.lit("Invalid business_data_date: '"), given, F.lit("'. Expected YYYY-MM-DD format.")))
    )
    warnings = [numeric_warning(n, F.col(n)) for n in numeric]
    warnings.append(F.when(status == "TINY", "denominator_value: very small"))
    if _MORE in raw.columns:
        warnings.append(F.when(F.col(_MORE).isNotNull(), SECOND_ROW))
    return raw.select(
        *[to_metric_decimal(F.col(c)).alias(c) if c in numeric else F.col(f"`{c}`") for c in raw.columns if c != _MORE],
        error.alias("error"), F.nullif(F.concat_ws("; ", *warnings), F.lit("")).alias("warning"))


def run_metric(spark: SparkSession, definition: Mapping, dates: Sequence[dt.date] = (),
               columns: ColumnMap | None = None) -> DataFrame:
    """The checked values of one metric (lazy); an empty result gives no row."""
    return checked_values(_raw_metric(spark, definition, dates, columns), columns)


def _raw_metric(spark: SparkSession, definition: Mapping, dates: Sequence[dt.date],
                columns: ColumnMap | None = None) -> DataFrame:
    result = bound_query(spark, definition["sql"], dates)
    (columns or ColumnMap()).check(result)
    return raw_values(result, columns)


def evaluate(spark: SparkSession, raws: Mapping[str, DataFrame]) -> DataFrame:
    """``key``, ``empty`` and the raw values of each named metric, from one plan.

    A metric without a result row has NULL values.
    """
    if not raws:
        raise MetricError("no metric to evaluate")
    keys, names = list(raws), next(iter(raws.values())).columns
    packed = "struct(" + ", ".join(f"`{n}`" for n in names) + ") AS v"
    one = spark.range(1).select(*[raw.selectExpr(packed).scalar().alias(f"m{i}") for i, raw in enumerate(raws.values())])
    rows = one.selectExpr("posexplode(array(" + ", ".join(f"m{i}" for i in range(len(keys))) + ")) AS (pos, v)")
    return rows.select(F.get(F.lit(keys), F.col("pos")).alias("key"), F.col("v").isNull().alias("empty"), "v.*")


@contextmanager
def time_limit(spark: SparkSession, seconds: float | None):
    """Cancel the jobs started inside the block after ``seconds``; the caller sees them fail.

    Gives an event that is set once the time is over.
    """
    over = threading.Event()
    if not seconds:
        yield over
        return
    context, tag, done = spark.sparkContext, f"tidemark-{uuid.uuid4().hex}", threading.Event()

    def watch() -> None:
        late = not done.wait(seconds)
        if late:
            over.set()
        while late:  # again and again: a job may start after the limit
            context.cancelJobsWithTag(tag)
            late = not done.wait(0.5)

    context.addJobTag(tag)
    watcher = threading.Thread(target=watch, daemon=True)
    watcher.start()
    try:
        yield over
    finally:
        done.set()
        watcher.join()
        context.removeJobTag(tag)


def build_records(values: DataFrame, defs: DataFrame, partition_dt: dt.date, executed_at: dt.datetime,
                  columns: ColumnMap | None = None) -> DataFrame:
    """Result rows: a value the SQL returned wins over the definition's."""
    columns = columns or ColumnMap()
    d = defs.select(F.col("metric_id").alias("key"),
                    *[F.col(c).alias(f"def_{c}") for c in TEXT_RESULTS + ["target_table"]])
    joined = values.join(d, "key")
    extra = [n for n in columns.names if n not in NUMERIC_RESULTS + TEXT_RESULTS + ["business_data_date"]]
    return joined.select(
        F.trim("def_target_table").alias("target_table"),
        *[F.coalesce(F.col(c), F.col(f"def_{c}")).alias(c) for c in TEXT_RESULTS],
        *[F.col(c) for c in NUMERIC_RESULTS], *[F.col(c) for c in extra], F.col("business_data_date"),
        F.lit(partition_dt.isoformat()).alias("partition_dt"),
        F.lit(executed_at).cast("timestamp").alias("pipeline_execution_ts"),
    )


def run_metrics(spark: SparkSession, defs: DataFrame, run_date: dt.date, latest: DataFrame,
                tables: Mapping[str, DataFrame] | None = None, partition_dt: dt.date | None = None,
                executed_at: dt.datetime | None = None, columns: ColumnMap | None = None,
                positional: bool = False, strict: bool = False, fail_fast: bool = False,
                timeout: float | None = QUERY_TIMEOUT_SECONDS) -> tuple[DataFrame, DataFrame]:
    """Run all definitions; give the result rows (with ``target_table``) and the failures.

    A failure has ``metric_id``, ``error_message`` and ``stage``: bind (a placeholder has no date), run
    (the SQL failed) or check (a value failed).

    A definition that does not bind or analyse fails alone. The others run as one plan, which has ``timeout``
    seconds for each of them. If that time is over every query runs once more by itself with its own ``timeout``, so
    a slow one fails alone, none is computed more than twice and finished ones are kept. A plan that
    fails is halved, down to the culprit. Values are checkpointed, so nothing is computed twice downstream. ``strict`` fails a metric whose
    number has no decimal form. ``fail_fast`` raises on the first failure. A repeated ``metric_id`` is an error.
    """
    columns = columns or ColumnMap()
    fields = [f.name for f in DEFINITION_SCHEMA if f.name in defs.columns]
    records = [row.asDict() for row in defs.select(*fields).collect()]
    for name in DEFINITION_SCHEMA.fieldNames():
        for record in records:
            record.setdefault(name, None)
    ids = [r["metric_id"] for r in records]
    repeated = sorted({str(i) for i in ids if ids.count(i) > 1}) if len(set(ids)) < len(ids) else []
    if repeated:
        raise DefinitionError(f"repeated metric_id: {repeated}")
    bind = bind_positional if positional else bind_dates
    bound: dict[str, list[Row]] = {}
    for row in bind(defs, run_date, latest).orderBy("metric_id", "ordinal").collect():
        bound.setdefault(row.metric_id, []).append(row)

    failures: dict[str, tuple[str, str]] = {}

    def fail(metric_id: str, text: str, stage: str = "run") -> None:
        failures[metric_id] = (text, stage)
        if fail_fast:
            raise MetricError(f"Metric '{metric_id}': {text}")

    def build(record: Mapping) -> DataFrame | str:
        spots = bound.get(record["metric_id"], [])
        try:
            return _raw_metric(spark, record, [s.bound_date for s in spots], columns)
        except (*JOB_ERRORS, MetricError) as error:
            return first_line(error)

    unbound = {key: error for key, spots in bound.items() if (error := next((s.error for s in spots if s.error), None))}
    for key, error in unbound.items():
        fail(key, error, "bind")
    ready = [r for r in records if r["metric_id"] not in unbound]
    queries: dict[str, DataFrame] = {}
    # analysis only, no job: the driver resolves several definitions at a time
    with table_views(spark, tables or {}), ThreadPoolExecutor(ANALYSIS_THREADS) as pool:
        for record, built in zip(ready, pool.map(build, ready)):
            if isinstance(built, str):
                fail(record["metric_id"], built)
            else:
                queries[record["metric_id"]] = built

    limits: list[threading.Event] = []

    def values_of(keys: Sequence[str]) -> DataFrame:
        # a plan that does the work of several queries may take as long as all of them
        with time_limit(spark, timeout and timeout * len(keys)) as over:
            limits.append(over)
            return checkpoint(evaluate(spark, {key: queries[key] for key in keys}))

    def split(keys: Sequence[str]) -> list[Sequence[str]]:
        return [[key] for key in keys] if limits[-1].is_set() else halves(keys)

    parts = run_apart(list(queries), values_of, fail, split)
    values = reduce(DataFrame.unionByName, parts) if parts else None
    good = failed = None
    if values is not None:
        text = F.when(F.col("empty"), NO_BUSINESS_DATE).otherwise(F.col("error"))
        if strict:
            text = F.coalesce(text, F.when(F.col("warning").contains("not a DECIMAL"), F.col("warning")))
        checked = checked_values(values, columns).withColumn("error", text)
        failed = checked.where("error IS NOT NULL").select(F.col("key").alias("metric_id"), F.col("error").alias("error_message"), F.lit("check").alias("stage"))
        if fail_fast:
            first = failed.first()
            if first is not None:
                raise MetricError(f"Metric '{first.metric_id}': {first.error_message}")
        good = build_records(checked.where("error IS NULL"), spark.createDataFrame(records, DEFINITION_SCHEMA),
                             partition_dt or run_date, executed_at or dt.datetime.now(dt.timezone.utc), columns)
    early = spark.createDataFrame([(key, *reason) for key, reason in failures.items()],
                                  "metric_id string, error_message string, stage string")
    failed = early if failed is None else failed.unionByName(early)
    if good is None:
        schema = T.StructType([T.StructField("target_table", T.StringType())] + RESULT_SCHEMA.fields)
        good = spark.createDataFrame([], schema)
    return good, failed


def by_target(records: DataFrame, targets: Iterable[str]) -> dict[str, DataFrame]:
    """Result rows of each target table."""
    return {t: records.where(F.col("target_table") == t).drop("target_table") for t in targets}
