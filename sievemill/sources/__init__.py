"""Sources and sinks: capped searches, logs, captured pages, files."""
