"""Sources and sinks: table scans, derived fixture views, writers."""
