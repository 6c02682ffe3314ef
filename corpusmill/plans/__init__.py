"""Sessions, shared storage and the end-to-end phases."""
