"""Writers."""

from tablework.sinks.files import (
    write_adjacency,
    write_delimited,
    write_matrix,
    write_popularity,
    write_report,
    write_report_text,
    write_vectors,
)

__all__ = [
    "write_adjacency",
    "write_delimited",
    "write_matrix",
    "write_popularity",
    "write_report",
    "write_report_text",
    "write_vectors",
]
