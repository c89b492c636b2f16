"""The incremental pull as a file stream."""
