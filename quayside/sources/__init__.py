"""Landing discovery, the enveloped JSON scan and the history-table scan."""
