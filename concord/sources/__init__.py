"""Header contracts, folder scans and sinks."""
