"""Joins, ordered de-duplication and audit operators shared by the jobs."""
