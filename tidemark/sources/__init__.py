from .audit import audit_last, row_hash, stamp_audit
from .ddl import schema_from_ddl, spark_type
from .definitions import check_path, read_metric_defs
from .delimited import bad_cells, export_csv, load_csv_folder, load_csv_typed, read_mapping, resolve_table
from .partition_listing import partition_info
from .tables import append, read_partition, write_targets, write_targets_staged

__all__ = [
    "append", "audit_last", "bad_cells", "check_path", "export_csv", "load_csv_folder", "load_csv_typed",
    "partition_info", "read_mapping", "read_metric_defs", "read_partition", "resolve_table", "row_hash",
    "schema_from_ddl", "spark_type", "stamp_audit", "write_targets", "write_targets_staged",
]
