"""File sources and sinks, and the catalogue tables."""

from probity.sources.catalogue import Catalogue, Dataset
from probity.sources.files import (
    INPUT_POSITION,
    conform,
    read_csv,
    read_document,
    read_parquet,
    read_summary,
    with_input_position,
    write_document,
    write_table,
)

__all__ = [
    "Catalogue",
    "Dataset",
    "INPUT_POSITION",
    "conform",
    "read_csv",
    "read_document",
    "read_parquet",
    "read_summary",
    "with_input_position",
    "write_document",
    "write_table",
]
