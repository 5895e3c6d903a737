"""postflow.sources."""
