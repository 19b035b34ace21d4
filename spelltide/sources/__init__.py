"""Table, view and file scans, and sinks."""
