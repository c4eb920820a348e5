"""Catalog reconciliation and reporting jobs on PySpark DataFrames."""
