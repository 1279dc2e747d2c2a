"""Error texts as they are stored in reconciliation rows."""

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_ERROR_LENGTH = 500

# Error codes and the descriptions stored with them.
ERROR_CATEGORIES = {
    "PARTITION_VALIDATION_ERROR": "Partition info table validation failed",
    "GCS_READ_ERROR": "Failed to read JSON from GCS",
    "JSON_VALIDATION_ERROR": "JSON data validation failed",
    "SQL_EXECUTION_ERROR": "SQL query execution failed",
    "BIGQUERY_WRITE_ERROR": "BigQuery write operation failed",
    "RECON_CREATION_ERROR": "Recon record creation failed",
    "PIPELINE_EXECUTION_ERROR": "General pipeline execution error",
    "PIPELINE_VALIDATION_ERROR": "Pipeline validation error",
    "UNKNOWN_ERROR": "Unknown error occurred",
}

_EDGE_SPACE = r"^[\s\x0B\p{Z}]+|[\s\x0B\p{Z}]+$"


def clean_error(text: Column) -> Column:
    """One line, trimmed, and at most 500 characters (497 and an ellipsis when longer)."""
    line = F.regexp_replace(F.translate(text, "\r\n", "  "), _EDGE_SPACE, "")
    return F.when(
        F.length(line) > MAX_ERROR_LENGTH,
        F.concat(F.substring(line, 1, MAX_ERROR_LENGTH - 3), F.lit("...")),
    ).otherwise(line)


def format_error(text: Column, code: Column) -> Column:
    """``[CODE] description: text``; an unknown code describes itself."""
    pairs = [F.lit(part) for item in ERROR_CATEGORIES.items() for part in item]
    description = F.coalesce(F.element_at(F.create_map(*pairs), code), code)
    return F.concat(F.lit("["), code, F.lit("] "), description, F.lit(": "), clean_error(text))
