"""Sources and sinks: files, collections, tables and topics."""
