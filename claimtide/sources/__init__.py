"""Sources and sinks: raw history, seeds, the test-data adapter, demo data,
written tables and CSV export."""
