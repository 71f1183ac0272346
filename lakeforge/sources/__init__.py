"""Sources and sinks: parquet tables, source-shaped fixtures, CSV, JDBC,
versioned snapshot tables and namespaces."""
