"""File sources and sinks."""

from catchframe.sources.delimited import (
    header_name,
    read_clean_table,
    read_dataset,
    read_historical,
    read_preliminary,
    read_quota,
    scan_text_table,
    scan_with_files,
)
from catchframe.sources.lines import (
    cells_of,
    file_splits,
    first_lines,
    header_and_body,
    quoted_records,
    read_length_table,
    scan_lines,
    scan_skip_lines,
)
from catchframe.sources.overview import read_overview, read_sampled_numbers
from catchframe.sources.sectioned import read_catch_report, scan_section
from catchframe.sources.sinks import read_parts, write_csv, write_parts, write_table

__all__ = [
    "cells_of", "file_splits", "first_lines", "header_and_body", "header_name", "quoted_records", "read_catch_report",
    "read_clean_table", "read_dataset", "read_historical", "read_length_table", "read_overview", "read_parts",
    "read_preliminary", "read_quota", "read_sampled_numbers", "scan_lines", "scan_section", "scan_skip_lines",
    "scan_text_table", "scan_with_files", "write_csv", "write_parts", "write_table",
]
