"""Validation of definitions, table references, latest partitions and date bindings."""

import uuid

from pyspark.sql import functions as F

from ..functions import partition_calendar, reference_date, strict_date
from ..operators import partitions as P
from ..operators import validate as V
from ..plans.metrics import bound_query, table_views
from ..session import checkpoint
from ..sources.partition_listing import partition_info
from .base import AS_OF, DEFS_SQL, RUN_DATE, derived_defs, query, scratch, table


def _found(check: str, condition: str, code: str, message: str, severity: str = "error") -> str:
    return (f"SELECT record_index, metric_id, '{severity}' AS severity, '{code}' AS code, {message} AS message "
            f"FROM defs WHERE {condition}")


def _sql(*parts: str) -> str:
    return f"WITH {DEFS_SQL} " + " UNION ALL ".join(parts)


_REQUIRED = ["metric_id", "metric_name", "metric_type", "sql", "dependency", "target_table"]
_MISSING = [_found("", f"{f} IS NULL", "MISSING_FIELD", f"'Missing required field ''{f}'''") for f in _REQUIRED]
_BLANK = [_found("", f"trim({f}) = ''", "BLANK_FIELD", f"'Field ''{f}'' is empty or only whitespace'") for f in _REQUIRED]
_T = "trim(target_table)"
_N_PARTS = f"len(string_split({_T}, '.'))"
_TARGET = [_found("", f"{_T} <> '' AND {_N_PARTS} <> 3", "TARGET_TABLE_FORMAT",
                  f"'target_table ''' || {_T} || ''' must be project.dataset.table'")] + [
    _found("", f"{_T} <> '' AND {_N_PARTS} = 3 AND trim(split_part({_T}, '.', {i})) = ''", "TARGET_TABLE_PART",
           f"'target_table ''' || {_T} || ''' has an empty {part} part'")
    for i, part in enumerate(["project", "dataset", "table"], start=1)]
_NO_SPOT = [_found("", "NOT regexp_matches(sql, '\\{(currently|partition_info)\\}') AND trim(sql) <> ''",
                   "NO_PLACEHOLDER", "'SQL has no date placeholder'", "warning")]
_MODE = [_found("", "partition_mode IS NOT NULL AND len(list_filter(string_split(partition_mode, '|'), "
                "lambda m: trim(m) NOT IN ('currently', 'partition_info'))) > 0", "PARTITION_MODE",
                "'Unknown partition_mode ''' || partition_mode || ''''")]
_N_TABLES = "len(regexp_extract_all(sql, '`[^`.]+\\.[^`.]+\\.[^`]+`'))"
_N_DATES = "len(regexp_extract_all(sql, '\\{run_date\\}'))"
_N_MODES = "len(string_split(partition_mode, '|'))"
_COUNT = [
    _found("", f"{_N_TABLES} <> {_N_MODES}", "MODE_COUNT",
           f"{_N_TABLES} || ' tables for ' || {_N_MODES} || ' partition modes'"),
    _found("", f"{_N_DATES} <> {_N_MODES}", "DATE_COUNT",
           f"{_N_DATES} || ' date placeholders for ' || {_N_MODES} || ' partition modes'"),
]
_LIMITS = [
    _found("", "NOT regexp_full_match(metric_id, '[A-Za-z0-9_]+')", "ID_PATTERN",
           "'metric_id holds other characters than letters, digits and underscores'", "warning"),
    _found("", "length(metric_id) > 100", "ID_LENGTH", "'metric_id is longer than 100'", "warning"),
    _found("", "length(metric_name) > 255", "NAME_LENGTH", "'metric_name is longer than 255'", "warning"),
]
_DUPLICATE = ("SELECT record_index, metric_id, 'error' AS severity, 'DUPLICATE_ID' AS code, "
              "'Duplicate metric_id ''' || trim(metric_id) || '''' AS message FROM (SELECT *, row_number() OVER "
              "(PARTITION BY trim(metric_id) ORDER BY record_index) AS rn FROM defs) WHERE rn > 1 AND trim(metric_id) <> ''")


@query("vd01_required_fields", _sql(*_MISSING))
def _(spark, sf):
    return V.check_required(derived_defs(spark, sf))


@query("vd02_blank_fields", _sql(*_BLANK))
def _(spark, sf):
    return V.check_blank(derived_defs(spark, sf))


@query("vd03_duplicate_ids", _sql(_DUPLICATE))
def _(spark, sf):
    return V.check_duplicates(derived_defs(spark, sf))


@query("vd04_target_table", _sql(*_TARGET))
def _(spark, sf):
    return V.check_target_table(derived_defs(spark, sf))


@query("vd05_placeholders", _sql(*_NO_SPOT))
def _(spark, sf):
    return V.check_placeholders(derived_defs(spark, sf))


@query("vd06_partition_mode", _sql(*_MODE))
def _(spark, sf):
    return V.check_partition_mode(derived_defs(spark, sf))


@query("vd07_mode_count", _sql(*_COUNT))
def _(spark, sf):
    return V.check_mode_count(derived_defs(spark, sf))


@query("vd08_missing_dependencies",
       f"WITH {DEFS_SQL} SELECT d AS dependency FROM (VALUES ('SMALL'), ('HUGE'), ('PROMO'), ('TINY')) w(d) "
       "WHERE d NOT IN (SELECT dependency FROM defs WHERE dependency IS NOT NULL)")
def _(spark, sf):
    return V.check_dependencies(derived_defs(spark, sf), ["SMALL", "HUGE", "PROMO", "TINY"])


@query("vd09_dependency_filter",
       f"WITH {DEFS_SQL} SELECT record_index, metric_id, dependency FROM defs WHERE dependency IN ('SMALL', 'PROMO')")
def _(spark, sf):
    kept = V.filter_dependencies(derived_defs(spark, sf), V.parse_dependencies(" SMALL,, PROMO "))
    return kept.select("record_index", "metric_id", "dependency")


# text dates with flaws: a short day, a 13th month, slashes, and good ones
_TEXT_DATE = ("CASE o_orderpriority WHEN '1-URGENT' THEN '2024-1-5' WHEN '2-HIGH' THEN '2024-13-01' "
              "WHEN '3-MEDIUM' THEN '2024/01/05' WHEN '5-LOW' THEN NULL ELSE substr(CAST(o_orderdate AS VARCHAR(30)), 1, 10) END")


@query("vd10_run_date_format",
       f"SELECT o_orderkey, day_text, strftime(CASE WHEN regexp_full_match(day_text, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
       f"THEN TRY_CAST(day_text AS DATE) END, '%Y-%m-%d') AS day FROM (SELECT o_orderkey, {_TEXT_DATE} AS day_text FROM orders)")
def _(spark, sf):
    texts = table(spark, sf, "orders").selectExpr("o_orderkey", f"{_TEXT_DATE} AS day_text")
    return texts.select("o_orderkey", "day_text", F.date_format(strict_date(F.col("day_text")), "yyyy-MM-dd").alias("day"))


@query("vd12_limits", _sql(*_LIMITS))
def _(spark, sf):
    return V.check_limits(derived_defs(spark, sf))


@query("vd_all_problems", _sql(*_MISSING, *_BLANK, *_TARGET, *_MODE, *_LIMITS, *_NO_SPOT, _DUPLICATE))
def _(spark, sf):
    return V.validate(derived_defs(spark, sf))


_REFS = (f"WITH {DEFS_SQL}, found AS (SELECT metric_id, regexp_extract_all(sql, '`[^`.]+\\.[^`.]+\\.[^`]+`') AS t FROM defs), "
         "refs AS (SELECT metric_id, pos - 1 AS pos, trim(t[pos], '`') AS table_ref FROM "
         "(SELECT metric_id, t, unnest(range(1, len(t) + 1)) AS pos FROM found)) ")
_PARTS = ("split_part(table_ref, '.', 1) AS project, split_part(table_ref, '.', 2) AS dataset, "
          "split_part(table_ref, '.', 3) AS table_name")


@query("pt01_table_refs", f"{_REFS} SELECT metric_id, CAST(pos AS INTEGER) AS pos, table_ref, {_PARTS} FROM refs")
def _(spark, sf):
    return P.table_refs(derived_defs(spark, sf))


@query("pt02_distinct_refs", f"{_REFS} SELECT DISTINCT {_PARTS} FROM refs")
def _(spark, sf):
    return P.distinct_refs(derived_defs(spark, sf))


@query("pt03_source_table",
       f"WITH {DEFS_SQL}, f AS (SELECT metric_id, trim(regexp_extract(sql, '`[^`.]+\\.[^`.]+\\.[^`]+`'), '`') AS r FROM defs) "
       "SELECT metric_id, coalesce(nullif(split_part(r, '.', 2), ''), 'UNKNOWN') AS source_dataset, "
       "coalesce(nullif(split_part(r, '.', 3), ''), 'UNKNOWN') AS source_table_name FROM f")
def _(spark, sf):
    return P.source_table(derived_defs(spark, sf))


def _shipments(spark, sf):
    """Partition information as lineitem tells it: one table per supplier, some dates unusable."""
    return table(spark, sf, "lineitem").select(
        F.lit("w.supply").alias("project_dataset"),
        F.concat(F.lit("supplier_"), F.col("l_suppkey").cast("string")).alias("table_name"),
        F.when(F.col("l_returnflag") == "R", None).otherwise(F.to_date("l_shipdate")).alias("partition_dt"))


_SHIPMENTS = ("SELECT 'w.supply' AS project_dataset, 'supplier_' || l_suppkey AS table_name, "
              "CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(l_shipdate AS DATE) END AS partition_dt FROM lineitem")


@query("pt04_latest_partition",
       "SELECT project_dataset, table_name, strftime(max(partition_dt), '%Y-%m-%d') AS partition_dt "
       f"FROM ({_SHIPMENTS}) WHERE partition_dt IS NOT NULL GROUP BY 1, 2")
def _(spark, sf):
    return P.latest_partition(_shipments(spark, sf)).withColumn("partition_dt", F.col("partition_dt").cast("string"))


_MONTHS = "SELECT '{}' AS project_dataset, 'lineitem' AS table_name, strftime(max(l_shipdate), '%Y-%m-01') AS partition_dt FROM lineitem"


@query("pt05_latest_from_listing", _MONTHS.format("w.catalog") + " UNION ALL " + _MONTHS.format("w.folder"))
def _(spark, sf):
    # a copy partitioned by month, once in the catalog and once as a folder
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", F.trunc("l_shipdate", "MM").alias("partition_dt")).repartition("partition_dt")
    name, folder = f"monthly_{uuid.uuid4().hex}", scratch(spark, "monthly")
    lines.write.partitionBy("partition_dt").format("parquet").option("path", folder).saveAsTable(name)
    try:
        info = partition_info(spark, {"w.catalog.lineitem": name, "w.folder.lineitem": spark.read.parquet(folder)})
        latest = checkpoint(P.latest_partitions(info, info, lookback_days=None))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return latest.withColumn("partition_dt", F.col("partition_dt").cast("string"))


_SUPPLIERS = "SELECT 'w.supply' AS project_dataset, 'supplier_' || s_suppkey AS table_name FROM supplier WHERE s_acctbal > 0"


def _wanted(spark, sf):
    return table(spark, sf, "supplier").where("s_acctbal > 0").select(
        F.lit("w.supply").alias("project_dataset"), F.concat(F.lit("supplier_"), F.col("s_suppkey").cast("string")).alias("table_name"))


@query("pt05_latest_partitions_batched",
       "SELECT project_dataset, table_name, strftime(partition_dt, '%Y-%m-%d') AS partition_dt FROM (SELECT *, row_number() OVER "
       f"(PARTITION BY project_dataset, table_name ORDER BY partition_dt DESC) AS rn FROM ({_SHIPMENTS}) "
       f"WHERE partition_dt IS NOT NULL) WHERE rn = 1 AND (project_dataset, table_name) IN ({_SUPPLIERS})")
def _(spark, sf):
    latest = P.latest_partitions(_shipments(spark, sf), _wanted(spark, sf), lookback_days=None)
    return latest.withColumn("partition_dt", F.col("partition_dt").cast("string"))


def _event_days(spark, sf):
    return table(spark, sf, "events").select(F.lit("w.web").alias("project_dataset"),
                                             F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("table_name"),
                                             F.to_date("ts").alias("partition_dt"))


@query("pt06_lookback",
       "SELECT 'w.web' AS project_dataset, 'user_' || user_id AS table_name, strftime(max(CAST(ts AS DATE)), '%Y-%m-%d') AS partition_dt "
       "FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-30' - 5 GROUP BY user_id")
def _(spark, sf):
    days = _event_days(spark, sf)
    latest = P.latest_partitions(days, days.select("project_dataset", "table_name"), AS_OF, 5)
    return latest.withColumn("partition_dt", F.col("partition_dt").cast("string"))


@query("pt07_missing_partitions",
       "SELECT 'w.sales' AS project_dataset, 'customer_' || c_custkey AS table_name FROM customer "
       "WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def _(spark, sf):
    name = lambda c: [F.lit("w.sales").alias("project_dataset"), F.concat(F.lit("customer_"), F.col(c).cast("string")).alias("table_name")]
    refs = table(spark, sf, "customer").select(*name("c_custkey"))
    info = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(*name("o_custkey"), F.to_date("o_orderdate").alias("partition_dt"))
    return P.missing_partitions(refs, P.latest_partition(info))


@query("pt08_partition_info", f"SELECT count(*) AS n FROM ({_SHIPMENTS})")
def _(spark, sf):
    return spark.range(1).select(F.lit(P.validate_partition_info(_shipments(spark, sf))).cast("bigint").alias("n"))


@query("pt09_current_date", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_shipdate = DATE '1998-06-01'")
def _(spark, sf):
    with table_views(spark, {"w.retail.lineitem": table(spark, sf, "lineitem")}):
        return bound_query(spark, "SELECT l_orderkey, l_linenumber FROM `w.retail.lineitem` WHERE l_shipdate = '{currently}'", [RUN_DATE])


def _known_dates(spark, sf):
    """Latest dates of the tables the derived definitions name."""
    o = table(spark, sf, "orders")
    brands = table(spark, sf, "part").select(F.lit("retail").alias("project_dataset"),
                                             F.replace("p_brand", F.lit("Brand#"), F.lit("b")).alias("table_name"),
                                             F.when(F.col("p_size") > 5, F.date_add(F.lit(RUN_DATE), F.col("p_size"))).alias("partition_dt"))
    orders = o.select(F.lit("w.retail").alias("project_dataset"), F.lit("orders").alias("table_name"), F.to_date("o_orderdate").alias("partition_dt"))
    parts = o.where("o_orderstatus = 'F'").select(F.lit("stock").alias("project_dataset"), F.lit("part").alias("table_name"), F.to_date("o_orderdate").alias("partition_dt"))
    return P.latest_partition(brands.unionByName(orders).unionByName(parts))


_DATES_SQL = (
    "latest AS (SELECT 'w.retail.' || replace(p_brand, 'Brand#', 'b') AS ref, max(CASE WHEN p_size > 5 THEN DATE '1998-06-01' + p_size END) AS d FROM part GROUP BY 1 "
    "UNION ALL SELECT 'w.retail.orders', max(CAST(o_orderdate AS DATE)) FROM orders "
    "UNION ALL SELECT 'w.stock.part', max(CAST(o_orderdate AS DATE)) FROM orders WHERE o_orderstatus = 'F')")


@query("pt10_bind_dates",
       f"WITH {DEFS_SQL}, {_DATES_SQL}, tokens AS (SELECT metric_id, regexp_extract_all(sql, '`[^`.]+\\.[^`.]+\\.[^`]+`|\\{{(?:currently|partition_info)\\}}') AS t FROM defs), "
       "spots AS (SELECT metric_id, t, unnest(range(1, len(t) + 1)) AS i FROM tokens), "
       "asked AS (SELECT metric_id, i, t, trim(t[i], '{}') AS placeholder, "
       "trim(list_filter(t[1:i], lambda x: x LIKE '`%')[-1], '`') AS ref FROM spots WHERE t[i] LIKE '{%'), "
       "numbered AS (SELECT metric_id, placeholder, ref, CAST(len(list_filter(t[1:i], lambda x: x LIKE '{%')) - 1 AS INTEGER) AS ordinal FROM asked) "
       "SELECT metric_id, ordinal, placeholder, n.ref, strftime(CASE WHEN placeholder = 'currently' THEN DATE '1998-06-01' ELSE d END, '%Y-%m-%d') AS bound_date, "
       "CASE WHEN placeholder = 'currently' THEN NULL WHEN n.ref IS NULL THEN 'no table reference before the placeholder' "
       "WHEN d IS NULL THEN 'no partition date for ' || n.ref END AS error FROM numbered n LEFT JOIN latest l ON l.ref = n.ref")
def _(spark, sf):
    bound = P.bind_dates(derived_defs(spark, sf), RUN_DATE, _known_dates(spark, sf))
    return bound.withColumn("bound_date", F.col("bound_date").cast("string"))


@query("pt11_bind_positional",
       f"WITH {DEFS_SQL}, {_DATES_SQL}, p AS (SELECT metric_id, string_split(partition_mode, '|') AS m, {_N_DATES} AS n, "
       "regexp_extract_all(sql, '`[^`.]+\\.[^`.]+\\.[^`]+`') AS t FROM defs WHERE partition_mode IS NOT NULL), "
       "x AS (SELECT *, unnest(range(1, greatest(len(m), len(t)) + 1)) AS i FROM p), "
       "y AS (SELECT metric_id, CAST(i - 1 AS INTEGER) AS ordinal, m[i] AS mode, trim(t[i], '`') AS ref, len(m) <> len(t) AS uneven, n <> len(m) AS off FROM x) "
       "SELECT metric_id, ordinal, mode, y.ref, strftime(CASE WHEN mode = 'currently' THEN DATE '1998-06-01' ELSE d END, '%Y-%m-%d') AS bound_date, "
       "CASE WHEN uneven THEN 'tables and partition modes differ in number' WHEN off THEN 'date placeholders and partition modes differ in number' "
       "WHEN mode <> 'currently' AND d IS NULL THEN 'no partition date for ' || y.ref END AS error FROM y LEFT JOIN latest l ON l.ref = y.ref")
def _(spark, sf):
    defs = derived_defs(spark, sf).where("partition_mode IS NOT NULL")
    bound = P.bind_positional(defs, RUN_DATE, _known_dates(spark, sf))
    return bound.withColumn("bound_date", F.col("bound_date").cast("string"))


@query("pt12_reference_date",
       "SELECT strftime(CAST(ts AS DATE) - 1, '%Y-%m-%d') AS business_date, count(*) AS n FROM events GROUP BY 1")
def _(spark, sf):
    day = reference_date(F.to_date("ts")).cast("string").alias("business_date")
    return table(spark, sf, "events").groupBy(day).agg(F.count(F.lit(1)).alias("n"))


@query("pt13_partition_calendar",
       "WITH c AS (SELECT d FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '2023-12-01', TIMESTAMP '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS d) "
       "WHERE isodow(d) <= 5 ORDER BY d DESC LIMIT 12) "
       "SELECT strftime(d, '%Y-%m-%d') AS partition_dt, count(ts) AS n FROM c LEFT JOIN events ON CAST(ts AS DATE) = d GROUP BY 1")
def _(spark, sf):
    days = partition_calendar(spark, 12, "weekdays", AS_OF.replace(day=31))
    per_day = table(spark, sf, "events").groupBy(F.to_date("ts").alias("partition_dt")).agg(F.count(F.lit(1)).alias("n"))
    return days.join(per_day, "partition_dt", "left").select(
        F.col("partition_dt").cast("string"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
