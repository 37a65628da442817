"""History table, current-state table and published views."""
