"""Sources and sinks: file folders, JSON-line exports and the usage lake."""
