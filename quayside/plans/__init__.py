"""Run shapes (history ingest, current-state build) and dataset contracts."""
