"""Operators for preparing training data: each module holds one, `registry` holds their queries."""
