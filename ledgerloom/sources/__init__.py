"""Reading and writing files."""

from ledgerloom.sources.files import scan, scan_changes, scan_stream
from ledgerloom.sources.listing import list_files, new_files
from ledgerloom.sources.scratch import scratch_path
from ledgerloom.sources.sinks import read_quarantine, write_quarantine, write_table

__all__ = [
    "list_files",
    "new_files",
    "read_quarantine",
    "scan",
    "scan_changes",
    "scan_stream",
    "scratch_path",
    "write_quarantine",
    "write_table",
]
