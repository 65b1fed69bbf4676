"""Sources and sinks: lines, generators, files, Kafka, JDBC, console, tables."""
