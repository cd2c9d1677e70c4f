"""Sources, sinks and shared storage."""
