"""postflow.streaming."""
