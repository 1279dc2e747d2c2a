"""Metric definitions from JSON files."""

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import JOB_ERRORS, SourceError
from ..schemas import DEFINITION_SCHEMA

_PATH = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://(?P<bucket>[^/]*)/(?P<object>.+)$")


def check_path(spark: SparkSession, path: str, require_scheme: bool = True) -> str:
    """Return ``path`` when it names scheme, bucket and object and can be read; else raise.

    ``file:///x`` has no bucket by nature and passes.
    """
    found = _PATH.match(path)
    if require_scheme and not found:
        raise SourceError(f"{path!r} is not scheme://bucket/object")
    if found and not found["bucket"] and not path.startswith("file:"):
        raise SourceError(f"{path!r} names no bucket")
    try:
        spark.read.text(path).limit(1).count()
    except JOB_ERRORS as error:
        raise SourceError(f"cannot read {path!r}: {error}") from error
    return path


def read_metric_defs(spark: SparkSession, path: str) -> DataFrame:
    """Definitions of a JSON array (or one object), with ``record_index`` in file order.

    Every field is nullable text, so incomplete records reach validation. A file that is no JSON,
    or that holds no record with any known field, is an error.
    """
    corrupt = "_corrupt_record"
    schema = T.StructType(DEFINITION_SCHEMA.fields + [T.StructField(corrupt, T.StringType())])
    raw = (spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", corrupt).json(path))
    # one row of counters decides; definitions are configuration, read again when they are used
    known = F.coalesce(*[F.col(f.name) for f in DEFINITION_SCHEMA]).isNotNull()
    seen = raw.agg(F.count_if(F.col(corrupt).isNotNull()).alias("bad"),
                   F.count_if(known).alias("known")).first()
    if seen.bad:
        raise SourceError(f"{path!r} is not valid JSON")
    if not seen.known:
        raise SourceError(f"{path!r} holds no definition")
    # gapless over all files; definitions are configuration, so one task may number them
    place = F.row_number().over(Window.orderBy(F.monotonically_increasing_id()))
    return raw.drop(corrupt).withColumn("record_index", place.cast("bigint") - 1)
