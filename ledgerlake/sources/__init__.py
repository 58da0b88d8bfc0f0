"""Sources and sinks: raw tables, file reads, table writes."""
