"""postflow.plans."""
