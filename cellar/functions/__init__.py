"""Scalar functions returning Spark Columns."""

from .address import (
    XLS_MAX_COLS,
    XLS_MAX_ROWS,
    XLSX_MAX_COLS,
    XLSX_MAX_ROWS,
    a1,
    col_index,
    col_label,
    parse_address,
    parse_col,
    parse_row,
)
from .dates import (
    datetime_kind,
    datetime_to_serial,
    legacy_time_as_datetime,
    render_datetime,
    render_time,
    serial_datable,
    serial_to_datetime,
)
from .display import displayed, number_text
from .numbers import narrow_bit, narrow_type, round15, round15_value
from .text import (
    ERROR_PATTERN,
    blank_to_null,
    continuation_sheet_name,
    default_sheet_name,
    file_name,
    is_blank,
    java_trim,
    legacy_sheet_name,
    lenient,
    missing_as,
    nullif_pattern,
    path_extension,
    render_bool,
    render_number,
    sheet_name_problem,
    unique_names,
    valid_sheet_name,
)

__all__ = [name for name in dir() if not name.startswith("_")]
