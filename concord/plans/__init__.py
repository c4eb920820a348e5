"""The reporting jobs."""
