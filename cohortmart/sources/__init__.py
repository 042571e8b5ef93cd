"""Sources and sinks: CSV batches, merged outputs, flat CSV exports, JDBC."""
