"""Inputs: CSV extracts, the complaint fixture from benchmark tables, the calendar spine, check files."""
from grievance.sources.csv import (  # noqa: F401
    discover_complaint_files,
    read_complaints_csv,
    scan_complaints,
    write_complaints_csv,
)
from grievance.sources.fixture import fixture_complaints, fixture_text, read_table  # noqa: F401
from grievance.sources.spine import date_spine  # noqa: F401
