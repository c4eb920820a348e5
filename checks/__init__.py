"""The library's jobs over the provided tables, with the SQL they are checked against."""
