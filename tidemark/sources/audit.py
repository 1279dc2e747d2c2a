"""Load audit columns and row hashes."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names that mark a column as load audit, not business data.
AUDIT_COLUMNS = [
    "ingestion_timestamp", "load_ts", "load_date", "created_by", "created_ts", "updated_by",
    "updated_ts", "source_system", "source_file_name", "batch_id", "record_hash", "dml_type",
    "etl_run_id", "valid_flag", "_loaded_at",
]


def file_name(template: str, day: Column) -> Column:
    """File a row came in: ``YYYYMMDD`` of the template filled, or a ``_yyyymmdd.csv`` suffix."""
    stamp = F.date_format(day, "yyyyMMdd")
    if "YYYYMMDD" in template:
        return F.replace(F.lit(template), F.lit("YYYYMMDD"), stamp)
    return F.concat(F.lit(template + "_"), stamp, F.lit(".csv"))


def stamp_audit(df: DataFrame, consts: Mapping[str, object], file_template: str | None = None,
                day: str = "partition_dt", file_column: str = "source_file_name") -> DataFrame:
    """Add the audit columns of one batch after the business columns.

    ``consts`` holds the batch constants (load timestamp, source system, batch id). Rows of a
    source are inserts unless ``dml_type`` says otherwise.
    """
    values = {"dml_type": F.lit("I")} | {name: F.lit(value) for name, value in consts.items()}
    if file_template is not None:
        values[file_column] = file_name(file_template, F.col(day))
    business = [F.col(c) for c in df.columns if c not in values]
    return df.select(*business, *[value.alias(name) for name, value in values.items()])


def audit_last(df: DataFrame, audit: Sequence[str] = tuple(AUDIT_COLUMNS)) -> DataFrame:
    """The same columns with the audit ones moved to the end."""
    return df.select([c for c in df.columns if c not in audit] + [c for c in df.columns if c in audit])


def row_hash(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Hex SHA-256 of the row as JSON; NULL fields are kept, so they count."""
    row = F.struct(*[F.col(c) for c in columns or df.columns])
    return F.sha2(F.to_json(row, {"ignoreNullFields": "false"}), 256)
