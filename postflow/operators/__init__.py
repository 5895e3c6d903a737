"""postflow.operators."""
