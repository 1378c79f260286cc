"""Readers."""

from tablework.sources.delimited import read_delimited, read_first, read_union
from tablework.sources.records import read_lines, read_records

__all__ = ["read_delimited", "read_first", "read_lines", "read_records", "read_union"]
