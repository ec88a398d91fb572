from clasp.sources.specs import TableSpec, StreamSpec
from clasp.sources.tables import (
    read_table, read_csv, read_csv_inferred, first_row, load_model,
)
from clasp.sources.sinks import (
    write_table, write_csv, save_model, truncate_table, require_rows,
    write_counted, publish_json,
)

__all__ = [
    "TableSpec", "StreamSpec", "read_table", "read_csv", "read_csv_inferred",
    "first_row", "load_model", "write_table", "write_csv", "save_model",
    "truncate_table", "require_rows", "write_counted", "publish_json",
]
