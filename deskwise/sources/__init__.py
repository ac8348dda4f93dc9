"""Landing, tables and sinks."""
