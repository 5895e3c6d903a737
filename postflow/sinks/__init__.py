"""postflow.sinks."""
