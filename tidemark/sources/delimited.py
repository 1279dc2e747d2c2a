"""Delimited files: typed reads, folders mapped to tables, exports."""

from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import DefinitionError, SourceError
from .ddl import schema_from_ddl

# The cell forms that make a typed value.
_WHOLE = r"^-?[0-9]+$"
_FRACTION = r"^-?[0-9]{1,29}(\.[0-9]{1,9})?$"  # what a DECIMAL(38,9) holds exactly
_BOOLEAN = r"^(?i)(true|false)$"

# Environments a load may go to; production is left out on purpose.
ALLOWED_ENVS = ("bld", "int", "pre")


_RECORD = "__record"  # a line whose number of cells is not that of the header
_SURPLUS = "__surplus"
_READERS = 8


def _cells(spark: SparkSession, path: str | list[str], sep: str, multiline: bool) -> DataFrame:
    """Every cell as trimmed text, empty cells NULL, short rows filled with NULL.

    ``__surplus`` is the first cell beyond the header, where a line has one.
    """
    def reader():
        return (spark.read.option("header", True).option("sep", sep).option("escape", '"').option("multiLine", multiline)
                .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).option("enforceSchema", False))

    names = reader().csv(path).columns
    if not names:
        raise SourceError(f"{path!r} is empty")
    fields = [T.StructField(n, T.StringType()) for n in names]
    # without pruning: the number of cells is counted whatever columns are used
    raw = reader().option("columnPruning", False).option("columnNameOfCorruptRecord", _RECORD).schema(T.StructType([*fields, T.StructField(_RECORD, T.StringType())])).csv(path)
    more = F.from_csv(F.col(_RECORD), ", ".join(f"c{i} string" for i in range(len(names) + 1)), {"sep": sep, "escape": '"', "multiLine": "true"})
    return raw.select(*[
        F.nullif(F.trim(F.col(f"`{name}`")), F.lit("")).alias(name.strip().lstrip("\ufeff")) for name in names
    ], F.when(F.col(_RECORD).isNotNull(), more[f"c{len(names)}"]).alias(_SURPLUS))


def _seen(df: DataFrame) -> Row:
    """How many cells of each text column have each form, from one aggregate; a single row for the driver."""
    flags = []
    for name in (c for c in df.columns if c != _SURPLUS):
        cell = F.col(f"`{name}`")
        flags += [F.struct(
            F.count(cell).alias("n"),
            F.count_if(cell.rlike(_WHOLE) & cell.try_cast("bigint").isNotNull()).alias("long"),
            F.count_if(cell.rlike(_FRACTION)).alias("fraction"),
            F.count_if(cell.rlike(_BOOLEAN)).alias("boolean"),
        ).alias(name)]
    surplus = F.count(_SURPLUS) if _SURPLUS in df.columns else F.lit(0)
    return df.agg(*flags, surplus.alias(_SURPLUS)).first()


def _types(seen: Sequence[Row]) -> dict[str, str]:
    """Type per column over all given files: it has one only when it holds all their cells exactly."""
    types = {}
    for name in dict.fromkeys(n for row in seen for n in row.asDict() if n != _SURPLUS):
        n, long, fraction, boolean = (sum(row[name][i] for row in seen if name in row.asDict()) for i in range(4))
        types[name] = ("string" if n == 0 else "bigint" if long == n else "decimal(38,9)" if fraction == n
                       else "boolean" if boolean == n else "string")
    return types


def infer_cell_types(df: DataFrame) -> dict[str, str]:
    """Type per text column: it has one only when all its non-null cells match the form and keep their value."""
    return _types([_seen(df)])


def _refuse_surplus(path: object, n: int) -> None:
    if n:
        raise SourceError(f"{path!r}: {n} lines have more cells than the header")


def bad_cells(spark: SparkSession, path: str | list[str], ddl: Sequence[Mapping] | None = None, sep: str = ",",
              multiline: bool = False) -> DataFrame:
    """``first_cell, column_name, cell, data_type`` of every cell that its type cannot hold, and of the first
    cell beyond the header (``column_name`` NULL); ``first_cell`` is that of the line. Without a schema only
    surplus cells can be bad."""
    cells = _cells(spark, path, sep, multiline)
    schema = schema_from_ddl(ddl) if ddl is not None else T.StructType()
    report = lambda name, cell, kind: F.struct(F.lit(name).cast("string").alias("column_name"), cell.alias("cell"), F.lit(kind).alias("data_type"))
    each = [F.when(_is_bad(F.col(f"`{f.name}`"), f.dataType), report(f.name, F.col(f"`{f.name}`"), f.dataType.simpleString()))
            for f in schema if f.name in cells.columns]
    each.append(F.when(F.col(_SURPLUS).isNotNull(), report(None, F.col(_SURPLUS), "none")))
    first = F.col(f"`{cells.columns[0]}`").alias("first_cell")
    return cells.select(first, F.inline(F.filter(F.array(*each), lambda x: x.isNotNull())))


def _is_bad(cell: Column, data_type: T.DataType) -> Column:
    """Whether a cell has no value of the type, or only a rounded one."""
    value = typed_cell(cell, data_type)
    lost = value.isNull()
    if isinstance(data_type, T.DecimalType):
        plain = cell.rlike(r"^[+-]?[0-9]*\.?[0-9]*$")
        lost = lost | (plain & (F.length(F.regexp_extract(cell, r"\.([0-9]*?)0*$", 1)) > data_type.scale))
    return cell.isNotNull() & lost


def load_csv_typed(spark: SparkSession, path: str | list[str], ddl: Sequence[Mapping] | None = None,
                   sep: str = ",", multiline: bool = False, strict: bool = True) -> DataFrame:
    """CSV with a header as typed rows, by the given schema or by the form of the cells.

    No cell is lost without a word: a column gets a type only when that holds all its cells exactly, and
    cells the given schema cannot hold, or beyond the header, are an error. ``strict=False`` makes them
    NULL; ``bad_cells`` lists them. Files of one call have the same header. ``multiline`` makes each file
    one task: leave it off unless cells hold line breaks.
    """
    cells = _cells(spark, path, sep, multiline)
    if ddl is None:
        seen = _seen(cells)
        if strict:
            _refuse_surplus(path, seen[_SURPLUS])
        return cells.select([F.col(f"`{n}`").try_cast(t).alias(n) for n, t in _types([seen]).items()])
    schema = schema_from_ddl(ddl)
    missing = [f.name for f in schema if f.name not in cells.columns]
    if missing:
        raise SourceError(f"{path!r} lacks the columns {missing}")
    if strict:
        bad = F.count_if(reduce(Column.__or__, [_is_bad(F.col(f"`{f.name}`"), f.dataType) for f in schema]))
        found = cells.agg(bad.alias("bad"), F.count(_SURPLUS).alias("surplus")).first()
        _refuse_surplus(path, found.surplus)
        if found.bad:
            raise SourceError(f"{path!r}: {found.bad} lines have cells that the schema cannot hold; bad_cells lists them")
    return cells.select([typed_cell(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema])


def typed_cell(cell: Column, data_type: T.DataType) -> Column:
    """One text cell as a value of ``data_type``: JSON for nested types, base64 for bytes."""
    if isinstance(data_type, (T.ArrayType, T.StructType)):
        return F.from_json(cell, data_type)
    if isinstance(data_type, T.BinaryType):
        return F.unbase64(cell)
    return cell.try_cast(data_type)


def read_mapping(lines: Iterable[str]) -> dict[str, str]:
    """``file = table template`` lines; blank lines, comments and lines without '=' are skipped."""
    kept = (line.strip() for line in lines)
    pairs = (line.partition("=") for line in kept if line and not line.startswith("#") and "=" in line)
    return {name.strip(): template.strip() for name, _, template in pairs}


def resolve_table(template: str, env: str, project_codes: Mapping[str, str],
                  allowed: Sequence[str] = ALLOWED_ENVS) -> str:
    """The table a template names in ``env``: ``<env>`` and ``<project_code>`` filled in."""
    if env.lower() not in allowed:
        raise DefinitionError(f"env {env!r} is not one of {list(allowed)}")
    code = next((code for project, code in project_codes.items() if project in template), None)
    if code is None:
        raise DefinitionError(f"no known project in {template!r}")
    return template.replace("<env>", env.lower()).replace("<project_code>", code)


def load_csv_folder(spark: SparkSession, folder: str, mapping: Mapping[str, str], env: str,
                    project_codes: Mapping[str, str], ddls: Mapping[str, Sequence[Mapping]] | None = None,
                    allowed: Sequence[str] = ALLOWED_ENVS) -> tuple[dict[str, DataFrame], DataFrame]:
    """Typed rows per target table for the mapped files of a folder, and a report of all files.

    A name is a file ``x.csv`` or a folder ``x.csv`` of part files. The report has ``file_name`` and
    ``table_name``; a name without a mapping has none and is skipped. Names of one table are unioned.
    """
    lookup = spark.createDataFrame(
        [(name, resolve_table(template, env, project_codes, allowed)) for name, template in mapping.items()],
        "file_name string, table_name string")
    # only the listing is read here: the content column is pruned
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(folder)
    parts = F.split("path", "/")
    parent, last = F.element_at(parts, -2), F.element_at(parts, -1)
    in_folder = parent.endswith(".csv")  # part files of one named folder
    files = listed.select(
        F.when(in_folder, parent).otherwise(last).alias("file_name"),
        F.when(in_folder, F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/")).otherwise(F.col("path")).alias("path")).distinct()
    report = files.join(lookup, "file_name", "left")
    found = report.where("table_name IS NOT NULL").orderBy("file_name").collect()
    with ThreadPoolExecutor(_READERS) as pool:
        headers = list(pool.map(lambda row: tuple(spark.read.option("header", True).csv(row.path).columns), found))
    # one read per table, schema and header
    groups: dict[str, dict[tuple, list[str]]] = {}
    for row, header in zip(found, headers):
        key = (row.file_name if row.file_name in (ddls or {}) else None, header)
        groups.setdefault(row.table_name, {}).setdefault(key, []).append(row.path)
    tables: dict[str, DataFrame] = {}
    for name, parts in groups.items():
        free = {key: _cells(spark, paths, ",", False) for key, paths in parts.items() if key[0] is None}
        seen = {key: _seen(cells) for key, cells in free.items()}
        for key, row in seen.items():
            _refuse_surplus(parts[key], row[_SURPLUS])
        types = _types(list(seen.values()))  # over all files of the table
        loaded = [cells.select([F.col(f"`{n}`").try_cast(types[n]).alias(n) for n in cells.columns if n != _SURPLUS]) for cells in free.values()]
        loaded += [load_csv_typed(spark, paths, ddls[key[0]]) for key, paths in parts.items() if key[0] is not None]
        tables[name] = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), loaded)
    return tables, report.select("file_name", "table_name")


def _clock(value: Column) -> Column:
    """Date and time, with the fraction of a second where there is one."""
    whole = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
    return F.when(value == F.date_trunc("second", value), whole).otherwise(F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def export_columns(df: DataFrame) -> DataFrame:
    """Every column as the text that goes into the file."""
    def text(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            value = F.date_format(value, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.TimestampType):
            # the moment on the clock of UTC, whatever the session's zone is
            utc = F.timestamp_add("MICROSECOND", F.unix_micros(value), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
            value = F.concat(_clock(utc), F.lit(" UTC"))
        elif isinstance(field.dataType, T.TimestampNTZType):
            value = _clock(value)
        elif isinstance(field.dataType, T.BinaryType):
            value = F.base64(value)
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            value = F.to_json(value)
        return value.cast("string").alias(field.name)
    return df.select([text(field) for field in df.schema])


def export_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists") -> None:
    """Delimited files with a header: ISO dates, lower-case booleans, NULL as an empty cell."""
    (export_columns(df).write.mode(mode).option("header", True).option("sep", sep)
     .option("nullValue", "").option("emptyValue", "").option("escape", '"').csv(path))
