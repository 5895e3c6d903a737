"""postflow.functions."""
