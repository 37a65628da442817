"""DataFrame -> DataFrame steps of the landing -> history -> current-state flow."""
