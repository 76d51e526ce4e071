"""cellar: spreadsheet workbooks as Spark DataFrames.

Read many workbooks in parallel with type inference and the usual spreadsheet rules,
write DataFrames to workbooks (split over sheets by capacity), and apply addressed cell
updates as a distributed merge. Public entry points:

* ``read_excel``, ``list_sheets``, ``sheets_table``, ``inventory`` (sources)
* ``write_excel``, ``write_excel_by_key`` (sinks)
* ``cellar.functions`` -- scalar Column functions
* ``cellar.operators`` -- row ids, sheet layout, table combination, cell patches, profiles
* ``cellar.streaming`` -- workbook streams in and out
"""

from .sinks.excel import write_cells, write_excel, write_excel_by_key
from .sinks.update import update_workbook
from .sources.excel import (
    ReadOptions,
    inventory,
    list_files,
    list_sheets,
    read_excel,
    read_rows,
    rejects,
    sheets_table,
)

__all__ = [
    "ReadOptions",
    "inventory",
    "list_files",
    "list_sheets",
    "read_excel",
    "read_rows",
    "rejects",
    "sheets_table",
    "update_workbook",
    "write_cells",
    "write_excel",
    "write_excel_by_key",
]
