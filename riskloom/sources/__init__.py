"""Table sources and sinks: the raw-table registry, stage tables and the
test-table mapping used by the registered queries."""
