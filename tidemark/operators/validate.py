"""Checks of metric definitions, as a job that reports every problem.

The result has one row per problem: ``record_index``, ``metric_id``, ``severity`` (error or
warning), ``code`` and ``message``. ``raise_on_error`` turns the first error into an exception.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import DefinitionError
from ..functions.dates import strict_date_text
from ..schemas import REQUIRED_FIELDS

# Placeholders, partition modes, and the parts of a table name.
PLACEHOLDERS = ["currently", "partition_info"]
PARTITION_MODES = ["currently", "partition_info"]
TABLE_PARTS = ["project", "dataset", "table"]
MAX_ID_LENGTH, MAX_NAME_LENGTH = 100, 255
ID_PATTERN = "^[A-Za-z0-9_]+$"

PLACEHOLDER = r"\{(?:currently|partition_info)\}"
RUN_DATE = r"\{run_date\}"
TABLE_REF = r"`[^`.]+\.[^`.]+\.[^`]+`"

_INDEX, _ID = "record_index", "metric_id"


def _problem(failed: Column, code: str, message: Column | str, severity: str = "error") -> Column:
    text = F.lit(message) if isinstance(message, str) else message
    return F.when(failed, F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("code"),
                                   text.alias("message")))


def _report(defs: DataFrame, problems: Sequence[Column]) -> DataFrame:
    found = F.filter(F.array(*problems), lambda p: p.isNotNull())
    return (defs.select(_INDEX, _ID, F.explode(found).alias("p"))
            .select(_INDEX, _ID, "p.severity", "p.code", "p.message"))


def _blank(c: Column) -> Column:
    return F.trim(c) == ""


def _required(fields: Sequence[str]) -> list[Column]:
    return [_problem(F.col(f).isNull(), "MISSING_FIELD", f"Missing required field '{f}'") for f in fields]


def _blanks(fields: Sequence[str]) -> list[Column]:
    return [_problem(_blank(F.col(f)), "BLANK_FIELD", f"Field '{f}' is empty or only whitespace") for f in fields]


def _target_table() -> list[Column]:
    name = F.trim("target_table")
    parts = F.split(name, r"\.")
    given = F.length(name) > 0
    return [
        _problem(given & (F.size(parts) != 3), "TARGET_TABLE_FORMAT",
                 F.concat(F.lit("target_table '"), name, F.lit("' must be project.dataset.table"))),
    ] + [
        _problem(given & (F.size(parts) == 3) & _blank(F.get(parts, i)), "TARGET_TABLE_PART",
                 F.concat(F.lit("target_table '"), name, F.lit(f"' has an empty {part} part")))
        for i, part in enumerate(TABLE_PARTS)
    ]


def _placeholders() -> list[Column]:
    none = F.regexp_count("sql", F.lit(PLACEHOLDER)) == 0
    return [_problem(none & ~_blank(F.col("sql")), "NO_PLACEHOLDER",
                     "SQL has no date placeholder", "warning")]


def _modes() -> Column:
    return F.transform(F.split("partition_mode", r"\|"), lambda m: F.trim(m))


def _partition_mode() -> list[Column]:
    known = F.forall(_modes(), lambda m: m.isin(PARTITION_MODES))
    return [_problem(~known, "PARTITION_MODE",
                     F.concat(F.lit("Unknown partition_mode '"), F.col("partition_mode"), F.lit("'")))]


def _mode_count() -> list[Column]:
    tables, modes = F.regexp_count("sql", F.lit(TABLE_REF)), F.size(_modes())
    dates = F.regexp_count("sql", F.lit(RUN_DATE))
    def text(what: str, n: Column) -> Column:
        return F.concat(n.cast("string"), F.lit(f" {what} for "), modes.cast("string"), F.lit(" partition modes"))
    return [
        _problem(tables != modes, "MODE_COUNT", text("tables", tables)),
        _problem(dates != modes, "DATE_COUNT", text("date placeholders", dates)),
    ]


def _limits() -> list[Column]:
    return [
        _problem(~F.col(_ID).rlike(ID_PATTERN), "ID_PATTERN",
                 "metric_id holds other characters than letters, digits and underscores", "warning"),
        _problem(F.length(_ID) > MAX_ID_LENGTH, "ID_LENGTH",
                 f"metric_id is longer than {MAX_ID_LENGTH}", "warning"),
        _problem(F.length("metric_name") > MAX_NAME_LENGTH, "NAME_LENGTH",
                 f"metric_name is longer than {MAX_NAME_LENGTH}", "warning"),
    ]


def check_required(defs: DataFrame, fields: Sequence[str] = REQUIRED_FIELDS) -> DataFrame:
    """Required fields that are absent or null."""
    return _report(defs, _required(fields))


def check_blank(defs: DataFrame, fields: Sequence[str] = REQUIRED_FIELDS) -> DataFrame:
    """Required fields that are empty or only whitespace."""
    return _report(defs, _blanks(fields))


def check_duplicates(defs: DataFrame, field: str = _ID) -> DataFrame:
    """Every record after the first with the same trimmed id.

    The first index per id comes from an aggregate, so a very frequent id never fills one task.
    """
    key = F.trim(field).alias("__key")
    repeated = (defs.groupBy(key).agg(F.min(_INDEX).alias("__first"), F.count(F.lit(1)).alias("__n"))
                .where("__n > 1 AND __key <> ''").drop("__n"))
    marked = defs.select(_INDEX, _ID, key).join(repeated, "__key")
    return _report(marked, [_problem(F.col(_INDEX) > F.col("__first"), "DUPLICATE_ID", F.concat(
        F.lit(f"Duplicate {field} '"), F.col("__key"), F.lit("'")))])


def check_target_table(defs: DataFrame) -> DataFrame:
    """Target tables that are not three non-empty parts."""
    return _report(defs, _target_table())


def check_placeholders(defs: DataFrame) -> DataFrame:
    """Warning for SQL without any date placeholder."""
    return _report(defs, _placeholders())


def check_partition_mode(defs: DataFrame) -> DataFrame:
    """Partition modes outside the known list; an absent mode is fine."""
    return _report(defs, _partition_mode())


def check_mode_count(defs: DataFrame) -> DataFrame:
    """Positional definitions need as many modes as tables and as many date placeholders."""
    return _report(defs.where("partition_mode IS NOT NULL"), _mode_count())


def check_limits(defs: DataFrame) -> DataFrame:
    """Warnings for long or oddly written ids and names."""
    return _report(defs, _limits())


def validate(defs: DataFrame, positional: bool = False) -> DataFrame:
    """All problems of all records: the per-record checks in one pass, then the duplicates."""
    checks = (_required(REQUIRED_FIELDS) + _blanks(REQUIRED_FIELDS) + _target_table()
              + _partition_mode() + _limits())
    checks += _mode_count() if positional else _placeholders()
    return _report(defs, checks).unionByName(check_duplicates(defs))


def raise_on_error(problems: DataFrame) -> None:
    """Raise the first error by record; warnings pass."""
    first = problems.where("severity = 'error'").orderBy(_INDEX, "code", "message").first()
    if first is not None:
        raise DefinitionError(f"Record {first.record_index}: {first.message}")


def check_dependencies(defs: DataFrame, dependencies: Sequence[str]) -> DataFrame:
    """Requested dependencies that no definition has; empty when all exist."""
    wanted = defs.sparkSession.createDataFrame([(d,) for d in sorted(set(dependencies))], "dependency string")
    return wanted.join(defs.select("dependency").distinct(), "dependency", "left_anti")


def require_dependencies(defs: DataFrame, dependencies: Sequence[str]) -> None:
    """Raise when a requested dependency does not exist, naming the missing and the available."""
    missing = [r.dependency for r in check_dependencies(defs, dependencies).orderBy("dependency").collect()]
    if missing:
        have = [r.dependency for r in defs.select("dependency").distinct().orderBy("dependency").collect()]
        raise DefinitionError(f"Missing dependencies: {missing}. Available: {have}")


def filter_dependencies(defs: DataFrame, dependencies: Sequence[str], required: bool = False) -> DataFrame:
    """Definitions whose dependency is requested; with ``required``, none at all is an error."""
    kept = defs.where(F.col("dependency").isin(list(dependencies)))
    if required and kept.isEmpty():
        raise DefinitionError(f"No definitions for dependencies {list(dependencies)}")
    return kept


def check_run_date(text: str):
    """The run date of a call, or a DefinitionError."""
    try:
        return strict_date_text(text)
    except ValueError as error:
        raise DefinitionError(f"Invalid date {text!r}. Expected YYYY-MM-DD") from error


def parse_dependencies(text: str) -> list[str]:
    """Names of a comma-separated list, trimmed, empty ones dropped; none left is an error."""
    names = [name for name in (part.strip() for part in text.split(",")) if name]
    if not names:
        raise DefinitionError("no dependency given")
    return names
