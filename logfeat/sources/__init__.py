"""Files in and out."""

from .files import (  # noqa: F401
    read_exceptions,
    read_labels,
    read_log,
    read_matrix,
    read_table,
    run_label,
    write_matrix,
    write_table,
)
