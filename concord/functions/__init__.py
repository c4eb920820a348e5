"""Column functions: text keys, numbers, identifiers and dates."""
