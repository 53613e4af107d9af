"""Readers and write modes."""

from martwright.sources.connectors import (
    kafka_options,
    read_jdbc,
    read_kafka_stream,
    write_jdbc,
    write_jdbc_batch,
    write_kafka,
)
from martwright.sources.files import (
    landed_offset,
    mart_path,
    read_csv_by_header,
    read_csv_typed,
    read_events,
    read_geo_csv,
    read_landed_json,
    read_order_log_csv,
    stream_new_files,
    table_view,
)
from martwright.sources.writers import (
    append,
    append_batch,
    compact,
    copy_partitions,
    current_rows,
    full_refresh,
    read_batches,
    replace_period,
    write_mart,
    write_partitioned,
)

__all__ = [
    "append",
    "append_batch",
    "compact",
    "copy_partitions",
    "current_rows",
    "full_refresh",
    "kafka_options",
    "landed_offset",
    "mart_path",
    "read_batches",
    "read_csv_by_header",
    "read_csv_typed",
    "read_events",
    "read_geo_csv",
    "read_jdbc",
    "read_kafka_stream",
    "read_landed_json",
    "read_order_log_csv",
    "replace_period",
    "stream_new_files",
    "table_view",
    "write_jdbc",
    "write_jdbc_batch",
    "write_kafka",
    "write_mart",
    "write_partitioned",
]
