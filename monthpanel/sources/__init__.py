"""Scans, cell tables, table profiling and sinks."""
