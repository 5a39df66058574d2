"""Sources and sinks: test-table fixtures, raw JSON landing/scanning, file listings."""
