from canton.sources.delimited import (
    file_order, read_delimited, read_wide_votes, restore_cp1252, sniff_delimiter,
)
from canton.sources.literal import literal_table
from canton.sources.sinks import (
    export_csv, export_json, read_table, with_audit, write_table,
)
from canton.sources.workbooks import read_workbooks, workbook_cells, workbook_table

__all__ = [
    "export_csv", "export_json", "file_order", "literal_table",
    "read_delimited", "read_table",
    "read_wide_votes", "read_workbooks", "restore_cp1252", "sniff_delimiter",
    "with_audit", "workbook_cells", "workbook_table", "write_table",
]
