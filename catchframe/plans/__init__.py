"""Whole runs: from files to catch tables, model input and report tables.

A run is a dictionary of lazy tables: they are computed when they are written.  What they share of parsed text is stored first.
"""

from catchframe.plans.assessment import assessment_tables, model_tables, scenario_tables, summary_table
from catchframe.plans.catch import CatchFiles, catch_tables
from catchframe.plans.index import IndexFiles, index_tables
from catchframe.plans.refresh import refresh_preliminary
from catchframe.plans.report import report_tables
from catchframe.plans.write import write_tables

__all__ = [
    "CatchFiles", "IndexFiles", "assessment_tables", "catch_tables", "index_tables", "model_tables", "refresh_preliminary",
    "report_tables", "scenario_tables", "summary_table", "write_tables",
]
