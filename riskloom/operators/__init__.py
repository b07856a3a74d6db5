"""Table-level operators: aggregation specs, one-hot encoding, profiling,
correlation, ranking, splitting, evaluation, model jobs and the run log."""
