"""Readers and the driver tables."""

from quarry.sources.readers import (
    good_rows, parse_strict, quarantined, read_delimited, read_dimension, read_lines,
    read_numbered_lines, read_quoted_dimension,
)
from quarry.sources.tables import load_table, TABLES

__all__ = ["read_delimited", "read_lines", "read_numbered_lines", "read_dimension",
           "read_quoted_dimension", "parse_strict", "good_rows", "quarantined", "load_table", "TABLES"]
