"""Fixed row layouts of the tables the library reads and writes."""

from pyspark.sql import types as T

METRIC_DECIMAL = T.DecimalType(38, 9)

# Field names and order of a metric definition.
REQUIRED_FIELDS = ["metric_id", "metric_name", "metric_type", "sql", "dependency", "target_table"]
OPTIONAL_FIELDS = ["metric_description", "frequency", "modified_date", "partition_mode"]

# All nullable, so that an incomplete definition is reported by validation and not lost in the read.
DEFINITION_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in REQUIRED_FIELDS + OPTIONAL_FIELDS]
)

# Layout of a metric result row.
RESULT_SCHEMA = T.StructType([
    T.StructField("metric_id", T.StringType(), False),
    T.StructField("metric_name", T.StringType(), False),
    T.StructField("metric_type", T.StringType(), False),
    T.StructField("metric_description", T.StringType()),
    T.StructField("frequency", T.StringType()),
    T.StructField("numerator_value", METRIC_DECIMAL),
    T.StructField("denominator_value", METRIC_DECIMAL),
    T.StructField("metric_output", METRIC_DECIMAL),
    T.StructField("business_data_date", T.StringType(), False),
    T.StructField("partition_dt", T.StringType(), False),
    T.StructField("pipeline_execution_ts", T.TimestampType(), False),
])

NUMERIC_RESULTS = ["numerator_value", "denominator_value", "metric_output"]
TEXT_RESULTS = ["metric_id", "metric_name", "metric_type", "metric_description", "frequency"]

# The 29 columns of a reconciliation row; counts stay text.
RECON_COLUMNS = [
    "module_id", "module_type_nm",
    "source_databs_nm", "source_table_nm", "source_column_nm", "source_file_nm",
    "source_contrl_file_nm", "source_server_nm",
    "target_databs_nm", "target_table_nm", "target_column_nm", "target_file_nm",
    "target_contrl_file_nm", "target_server_nm",
    "source_vl", "target_vl", "clcltn_ds", "excldd_vl", "excldd_reason_tx", "tolrnc_pc",
    "rcncln_exact_pass_in", "rcncln_tolrnc_pass_in",
    "latest_source_parttn_dt", "latest_target_parttn_dt", "load_ts", "schdld_dt",
    "source_system_id", "schdld_yr", "Job_Name",
]
RECON_REQUIRED = {
    "module_id", "module_type_nm", "source_server_nm", "target_server_nm", "source_vl", "target_vl",
    "rcncln_exact_pass_in", "latest_source_parttn_dt", "latest_target_parttn_dt", "load_ts",
    "schdld_dt", "source_system_id", "schdld_yr", "Job_Name",
}
_RECON_TYPES = {"schdld_dt": T.DateType(), "schdld_yr": T.IntegerType()}
RECON_SCHEMA = T.StructType([
    T.StructField(name, _RECON_TYPES.get(name, T.StringType()), name not in RECON_REQUIRED)
    for name in RECON_COLUMNS
])

PARTITION_INFO_COLUMNS = ["project_dataset", "table_name", "partition_dt"]

# The 20 columns of a data-quality summary row.
DQ_SUMMARY_SCHEMA = T.StructType([
    T.StructField("invocation_id", T.StringType()),
    T.StructField("execution_ts", T.TimestampType()),
    T.StructField("rule_binding_id", T.StringType()),
    T.StructField("rule_id", T.StringType()),
    T.StructField("table_id", T.StringType()),
    T.StructField("column_id", T.StringType()),
    T.StructField("dimension", T.StringType()),
    T.StructField("rows_validated", T.LongType()),
    T.StructField("success_count", T.LongType()),
    T.StructField("failed_count", T.LongType()),
    T.StructField("null_count", T.LongType()),
    T.StructField("success_percentage", T.DoubleType()),
    T.StructField("failed_percentage", T.DoubleType()),
    T.StructField("null_percentage", T.DoubleType()),
    T.StructField("last_modified", T.TimestampType()),
    T.StructField("metadata_json_string", T.StringType()),
    T.StructField("dataplex_lake", T.StringType()),
    T.StructField("dataplex_zone", T.StringType()),
    T.StructField("dataplex_asset_id", T.StringType()),
    T.StructField("dq_run_id", T.StringType()),
])
