from verbum.sources.coefficients import (
    coefficient_list_line,
    coefficient_report_lines,
    load_coefficients,
    split_list_line,
    write_coefficient_report,
)
from verbum.sources.corpus import (
    ALL,
    TEST,
    TRAIN,
    documents_as_lines,
    fixture_corpus,
    range_source,
    read_table,
    scan_corpus,
)
from verbum.sources.report import write_report

__all__ = [
    "ALL", "TEST", "TRAIN", "coefficient_list_line", "coefficient_report_lines",
    "documents_as_lines", "fixture_corpus", "load_coefficients", "range_source",
    "read_table", "scan_corpus", "split_list_line", "write_coefficient_report", "write_report",
]
